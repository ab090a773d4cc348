"""Text, listing and configuration sources."""

from __future__ import annotations

import io
import pickle
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import SchemaMismatch, StateConflict, TidewellError
from ..functions.scalars import etag_norm
from ..schemas import columns, schema


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_number, line) with lines numbered within their file, blank ones included.

    Files are read in blocks, by many tasks; a line's number is the lines of
    the blocks before its own (one small row a block) and its place in it.
    """
    block = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    rows = spark.read.text(path).select(*block, F.col("value").alias("line"), F.monotonically_increasing_id().alias("id"))
    counts = rows.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("path", "block", "first", before.alias("before"))
    return rows.join(offsets, ["path", "block"]).select("path", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_number"), "line")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Inventory JSON lines, read in blocks.  A blank or malformed line is refused with its number; only then are lines numbered."""

    def parsed(lines: DataFrame) -> DataFrame:
        return lines.withColumn("r", F.from_json("line", schema("inventory")))

    bad = F.col("r").isNull() | ~F.trim("line").startswith("{") | F.col("r.blob_path").isNull()
    rows = parsed(spark.read.text(path).select(F.col("value").alias("line")))
    if not rows.where(bad).isEmpty():
        first = parsed(numbered_lines(spark, path)).where(bad).orderBy("path", "line_number").first()
        raise SchemaMismatch(f"{first['path']}:{first['line_number']}: not an inventory record")
    return rows.select("r.*")


def read_group_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(log_name, group): names below ``File group: N`` headers, each name once."""
    lines = numbered_lines(spark, path).withColumn("line", F.trim("line")).where("line <> ''")
    headed = lines.withColumn("mark", F.when(F.col("line").startswith("File group:"), F.trim(F.substring("line", 12, 1 << 20))))
    grouped = headed.withColumn("group", F.last("mark", ignorenulls=True).over(W.partitionBy("path").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)))
    out = grouped.where("mark is null").select(F.col("line").alias("log_name"), F.expr("try_cast(group AS bigint)").alias("group"))
    wrong = out.where("group is null or group < 0 or not log_name rlike '^[A-Za-z0-9._-]+$'").unionByName(out.join(out.groupBy("log_name").count().where("count > 1"), "log_name", "left_semi")).limit(3).collect()
    if wrong or out.isEmpty():
        raise SchemaMismatch(f"{path}: bad group manifest: {[r['log_name'] for r in wrong]}")
    return out


def parse_listing(pages: DataFrame) -> DataFrame:
    """(archive_key, listed_size, etag) of object-store listing pages (column ``page``, XML)."""
    kind = "STRUCT<Contents: ARRAY<STRUCT<Key: STRING, Size: BIGINT, ETag: STRING>>, IsTruncated: BOOLEAN, NextContinuationToken: STRING>"
    bare = F.regexp_replace("page", r'\sxmlns="[^"]*"', "")
    return pages.select(F.explode(F.from_xml(bare, kind)["Contents"]).alias("c")).select(F.col("c.Key").alias("archive_key"), F.col("c.Size").alias("listed_size"), etag_norm("c.ETag").alias("etag"))


def list_pages(fetch: Callable[[str | None], tuple[str, str | None]], most: int = 10_000) -> Iterator[str]:
    """Pages of a listing by continuation token; a token seen before ends in an error, not in a loop."""
    seen: set[str] = set()
    token = None
    for _ in range(most):
        page, token = fetch(token)
        yield page
        if token is None:
            return
        if token in seen:
            raise TidewellError("the listing repeats a continuation token")
        seen.add(token)
    raise TidewellError("the listing has too many pages")


class _Plain(pickle.Unpickler):
    def find_class(self, module, name):
        raise pickle.UnpicklingError(f"{module}.{name} is not plain data")


def load_plain_pickle(data: bytes) -> list[dict]:
    """A pickled list of mappings of plain values; anything that would run code is refused."""
    rows = _Plain(io.BytesIO(data)).load()
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise SchemaMismatch("an anchor log is a list of mappings")
    return rows


def read_anchor_logs(spark: SparkSession, path: str) -> DataFrame:
    """Anchor rows of pickled logs (``<log>.pkl``), a task per file; position in the list is the row index."""

    def rows(batches):
        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                log = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                hexed = lambda v: v.hex() if isinstance(v, bytes) else "" if v is None else str(v).lower()
                yield pd.DataFrame([
                    (log, k, hexed(r.get("token")), int(r["timestamp"]), r.get("log_name"), hexed(r.get("log_token")), hexed(r.get("scene_token")), r.get("lidar_path"),
                     {c: {"data_path": v.get("data_path")} for c, v in (r.get("cams") or {}).items()})
                    for k, r in enumerate(load_plain_pickle(bytes(content)))
                ], columns=columns("anchor_row"))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, schema("anchor_row"))


def read_native_logs(spark: SparkSession, paths: list[str], immutable: bool = False):
    """Native tables from SQLite log databases, one task a file, opened read-only; ``immutable`` (for audits) also promises that nobody writes them."""
    from ..plans.planner import NativeLogs

    queries = {
        "log": ("SELECT token, logfile FROM log", "token binary, logfile string"), "lidar": ("SELECT token, timestamp, scene_token, filename FROM lidar_pc", "token binary, ts_us bigint, scene_token binary, filename string"),
        "camera": ("SELECT token, channel FROM camera", "token binary, channel string"), "image": ("SELECT token, timestamp, filename_jpg, camera_token FROM image", "token binary, ts_us bigint, filename string, camera_token binary"),
    }
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def scan(sql: str, names: list[str]):
        def rows(batches):
            import sqlite3

            import pandas as pd

            for batch in batches:
                for path in batch["path"]:
                    db = sqlite3.connect(f"file:{path}?mode=ro{'&immutable=1' if immutable else ''}", uri=True)
                    cursor = db.execute(sql)
                    while part := cursor.fetchmany(10_000):
                        out = pd.DataFrame(part, columns=names)
                        out.insert(0, "log_name", path.rsplit("/", 1)[-1].rsplit(".", 1)[0])
                        yield out
                    db.close()

        return rows

    tables = {}
    for name, (sql, kinds) in queries.items():
        names = [c.split()[0] for c in kinds.split(", ")]
        tables[name] = files.mapInPandas(scan(sql, names), "log_name string, " + kinds)
    return NativeLogs(**tables)


def load_scene_filter(spark: SparkSession, path: str, history: int, future: int) -> dict:
    """Scene filter (YAML): row bounds, log names, tokens; with the hash of its bytes."""
    import hashlib

    import yaml

    data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    spec = yaml.safe_load(data)
    if spec.get("num_history_frames") != history or spec.get("num_future_frames") != future:
        raise SchemaMismatch("the scene filter has other row bounds")
    logs, tokens = spec.get("log_names") or [], spec.get("tokens") or []
    if len(set(logs)) != len(logs) or len(set(tokens)) != len(tokens):
        raise SchemaMismatch("the scene filter repeats a name")
    return {
        "sha256": hashlib.sha256(data).hexdigest(), "logs": spark.createDataFrame([(x,) for x in logs], "log_name string"),
        "tokens": spark.createDataFrame([(str(x).lower(),) for x in tokens], "token string"),
    }


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of files, by their path below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    at = F.regexp_replace(files["path"], "^[a-z]+:/*", "/")
    root = "/" + path.split(":", 1)[-1].strip("/") if ":" in path else path.rstrip("/")
    return files.select(F.substring(at, F.lit(len(root) + 2), F.length(at)).alias("path"), "length", F.col("modificationTime").alias("modified"))


def file_hashes(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """(path, length, sha256) of whole files.

    With ``listed`` (path, length, modified of an earlier listing, paths as
    Spark gives them) files that have changed since are an error, and none of
    them is hashed.
    """
    files = spark.read.format("binaryFile").load(path)
    if listed is not None:
        now = files.select("path", F.col("length").alias("length_now"), F.col("modificationTime").alias("modified_now"))
        both = listed.select("path", "length", "modified").join(now, "path", "left")
        changed = both.where(~(F.col("length").eqNullSafe(F.col("length_now")) & F.col("modified").eqNullSafe(F.col("modified_now")))).orderBy("path").limit(3).collect()
        if changed:
            raise StateConflict(f"changed since they were listed: {[r['path'] for r in changed]}")
        files = files.join(listed.select("path"), "path", "left_semi")
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_log_names(spark: SparkSession, path: str, sha256: str | None = None) -> DataFrame:
    """(log_name) of a scene filter's ``log_names`` list, read line by line without a YAML parser; ``sha256`` pins the file's bytes.

    The list ends at the next key of its level; a line in it that is no plain
    or quoted name is refused.
    """
    import hashlib
    import re

    data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    if sha256 is not None and hashlib.sha256(data).hexdigest() != sha256:
        raise SchemaMismatch(f"{path}: the file is not the pinned one")
    names, inside = [], False
    for number, line in enumerate(data.decode("utf-8").splitlines(), 1):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if re.match(r"[A-Za-z_]\w*\s*:", line):
            inside = line.split(":")[0].strip() == "log_names"
        elif inside:
            item = re.fullmatch(r"\s*-\s+(['\"]?)([A-Za-z0-9._-]+)\1\s*", line)
            if not item:
                raise SchemaMismatch(f"{path}:{number}: not a log name")
            names.append(item[2])
    if not names or len(set(names)) != len(names):
        raise SchemaMismatch(f"{path}: no log names, or repeated ones")
    return spark.createDataFrame([(n,) for n in names], "log_name string")


def fetch_listing(fetch: Callable[[str], tuple[int, str]], base_url: str, prefix: str = "") -> Iterator[str]:
    """Pages of an object store's listing over HTTPS (status 200 only), followed by their continuation tokens."""
    import re
    from html import unescape
    from urllib.parse import quote

    if not base_url.startswith("https://"):
        raise TidewellError(f"{base_url!r} is not an https address")

    def page(token: str | None) -> tuple[str, str | None]:
        status, text = fetch(f"{base_url}?list-type=2&prefix={quote(prefix, safe='')}" + (f"&continuation-token={quote(token, safe='')}" if token else ""))
        if status != 200:
            raise TidewellError(f"listing: status {status}")
        more = re.search(r"<IsTruncated>\s*true\s*</IsTruncated>", text)
        after = re.search(r"<NextContinuationToken>(.*?)</NextContinuationToken>", text, re.S)
        if more and not after:
            raise TidewellError("the listing goes on without a continuation token")
        return text, unescape(after[1]) if more else None

    return list_pages(page)


#: Headers that carry credentials (fixed values).
CREDENTIALS = frozenset({"authorization", "proxy-authorization", "cookie", "x-api-key", "private-token"})


def safe_headers(headers: dict[str, str], url: str, allowed_hosts: Sequence[str], redirected: bool = False) -> dict[str, str]:
    """Headers for a request: credentials only over https, to allowed hosts, and never after a redirect."""
    from urllib.parse import urlsplit

    parts = urlsplit(url)
    trusted = parts.scheme == "https" and (parts.hostname or "").lower() in {h.lower() for h in allowed_hosts} and not redirected
    return {k: v for k, v in headers.items() if trusted or k.lower() not in CREDENTIALS}
