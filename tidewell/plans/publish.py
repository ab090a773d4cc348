"""All-or-nothing publication of tables.

Tables are written below a staging folder, read back, and checked by the rules
on what was read; then a manifest is put in and the folder renamed.  A product
appears at its path whole or not at all; what a crash leaves is a staging
folder, which the next publication to the path removes.
Paths go through Hadoop's file systems, so the store may be any that Spark can
write.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StateConflict, TidewellError
from ..schemas import FORMATS

MANIFEST = "_MANIFEST.json"


class Store:
    """The few file operations that publication needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.path = spark.sparkContext._jvm, spark.sparkContext._gateway, path
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, a: str, b: str) -> None:
        if self.exists(b) or not self.fs.rename(self._path(a), self._path(b)):
            raise StateConflict(f"cannot rename {a} to {b}")

    def write_text(self, path: str, text: str | Iterable[str], overwrite: bool = False) -> None:
        """Flushed to the store before it is closed; without ``overwrite`` the file must be new (the store decides, so of two writers one fails).

        A text may come in parts; about a megabyte of them is held at a time.
        """
        out = self.fs.create(self._path(path), overwrite)
        try:
            held = bytearray()
            for part in [text] if isinstance(text, str) else text:
                held += part.encode("utf-8")
                if len(held) >= 1 << 20:
                    out.write(held)
                    held = bytearray()
            out.write(held)
            out.hsync()
        finally:
            out.close()

    def replace_text(self, path: str, text: str | Iterable[str]) -> None:
        """Write beside and rename, so that a reader sees the old document or the new one."""
        partial = f"{path}.{uuid.uuid4().hex}.partial"
        self.write_text(partial, text)
        try:
            kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
            options = self.gateway.new_array(kind, 1)
            options[0] = kind.valueOf("OVERWRITE")
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf())
            context.rename(self._path(partial), self._path(path), options)
        finally:
            if self.exists(partial):
                self.delete(partial)

    def list(self, path: str) -> list[str]:
        """Names of what lies in a folder; none if there is no such folder."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path))) if self.exists(path) else []

    def free_bytes(self, path: str) -> int:
        return self.fs.getStatus(self._path(path)).getRemaining()

    def read_text(self, path: str) -> str:
        source = self.fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode("utf-8")
        finally:
            source.close()


def row_digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a table, whatever its order and files: sums of two row hashes."""
    cols = [F.coalesce(F.to_json(F.struct(c)), F.lit("null")) for c in sorted(df.columns)]
    total = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)"))).first()
    return total[0], hashlib.sha256(f"{total[0]}:{total[1]}:{total[2]}".encode()).hexdigest()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediates, ``spark.checkpoint.dir``; only a local session may fall back on a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise TidewellError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get("spark.tidewell.local.scratch", None) or tempfile.mkdtemp(prefix="tidewell-")
    spark.conf.set("spark.tidewell.local.scratch", own)
    return own


class Scratch:
    """Intermediate tables of one run below a folder that all executors share; give ``keep`` to a planner."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/scratch-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self) -> None:
        Store(self.spark, self.path).delete(self.path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, product: str, rules: Callable[[dict[str, DataFrame]], object] | None = None, facts: dict | None = None) -> dict:
    """Write, check, rename; returns the manifest.  ``rules`` makes Rules of the tables as read back.  An existing product is never replaced."""
    path = path.rstrip("/")
    store = Store(spark, path)
    if store.exists(path):
        raise StateConflict(f"{path} is there already")
    folder, _, name = path.rpartition("/")
    for left in store.list(folder or "/"):
        if left.startswith(f"{name}._staging-"):
            store.delete(f"{folder}/{left}")
    staging = f"{path}._staging-{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"{staging}/{name}")
        staged = {name: spark.read.schema(df.schema).parquet(f"{staging}/{name}") for name, df in tables.items()}
        if rules is not None:
            rules(staged).enforce(product)
        manifest = {"format": FORMATS[product], "tables": {}, **(facts or {})}
        for name, df in staged.items():
            rows, digest = row_digest(df)
            manifest["tables"][name] = {"rows": rows, "digest": digest}
        store.write_text(f"{staging}/{MANIFEST}", json.dumps(manifest, sort_keys=True, indent=2))
        store.rename(staging, path)
        return manifest
    finally:
        if store.exists(staging):
            store.delete(staging)


def open_product(spark: SparkSession, path: str, product: str, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of a published product; without a manifest, or with another tag, it is refused."""
    store = Store(spark, path)
    if not store.exists(f"{path}/{MANIFEST}"):
        raise TidewellError(f"{path} is not published")
    manifest = json.loads(store.read_text(f"{path}/{MANIFEST}"))
    if manifest.get("format") != FORMATS[product]:
        raise TidewellError(f"{path}: format {manifest.get('format')!r}")
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in manifest["tables"]}
    for name, df in tables.items() if verify else ():
        if row_digest(df) != (manifest["tables"][name]["rows"], manifest["tables"][name]["digest"]):
            raise TidewellError(f"{path}/{name} differs from its manifest")
    return tables


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object a row, keys sorted, as text lines; null fields are written."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def export_shards(df: DataFrame, path: str, key: str) -> None:
    """Gzip JSON-lines shards, one folder an archive; the output must not exist."""
    lines = df.select(key, F.to_json(F.struct(*sorted(c for c in df.columns if c != key)), {"ignoreNullFields": "false"}).alias("value"), "path")
    lines.repartition(key).sortWithinPartitions(key, "path").drop("path").write.partitionBy(key).option("compression", "gzip").mode("errorifexists").text(path)


def publish_shards(spark: SparkSession, rows: DataFrame, path: str, facts: DataFrame) -> dict:
    """Write the direct index: a gzip JSON-lines shard an archive, and ``latest.json`` with each shard's hash and rows.

    ``facts`` has (archive_key, source_url, source_size, etag), one row an
    archive.  The manifest is put in last, so a reader never sees half an index.
    """
    path = path.rstrip("/")
    export_shards(rows.select("archive_key", "path", "offset", "size", "sha256"), path, "archive_key")
    store = Store(spark, path)
    counts = {r["archive_key"]: r["count"] for r in rows.groupBy("archive_key").count().collect()}
    sources = {r["archive_key"]: r.asDict() for r in facts.collect()}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt.gz").load(path)
    key = F.url_decode(F.regexp_extract("path", "archive_key=([^/]*)/", 1))
    shards = []
    for r in files.select(key.alias("key"), F.sha2("content", 256).alias("sha256"), F.element_at(F.split("path", "/"), -2).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("file")).orderBy("key").collect():
        shards.append({"asset": f"{r['folder']}/{r['file']}", "sha256": r["sha256"], "rows": counts[r["key"]], "archive_key": r["key"], **{k: sources[r["key"]][k] for k in ("source_url", "source_size", "etag")}})
    if [s["archive_key"] for s in shards] != sorted(counts):
        raise TidewellError(f"{path}: {len(shards)} shards for {len(counts)} archives")
    manifest = {"format": FORMATS["direct"], "shards": shards, "rows": sum(counts.values())}
    store.replace_text(f"{path}/latest.json", json.dumps(manifest, sort_keys=True, indent=2))
    return manifest


def read_shards(spark: SparkSession, path: str, numbers: list[int] | None = None) -> DataFrame:
    """Rows of a direct index (path, offset, size, sha256, archive_key, source_url, source_size, etag); ``numbers`` picks shards, counted from 1.

    A shard whose bytes have another hash, or another number of rows, is refused before any row is given out.
    """
    path = path.rstrip("/")
    manifest = json.loads(Store(spark, path).read_text(f"{path}/latest.json"))
    if manifest.get("format") != FORMATS["direct"] or manifest["rows"] != sum(s["rows"] for s in manifest["shards"]):
        raise TidewellError(f"{path}: not a direct index")
    wrong = [n for n in numbers or [] if not 1 <= n <= len(manifest["shards"])]
    if wrong or numbers is not None and len(set(numbers)) != len(numbers):
        raise TidewellError(f"{path}: no shards {wrong or numbers}")
    shards = [manifest["shards"][n - 1] for n in numbers] if numbers else manifest["shards"]
    held = spark.read.format("binaryFile").load([f"{path}/{s['asset']}" for s in shards])
    name = F.concat_ws("/", F.url_decode(F.element_at(F.split("path", "/"), -2)), F.element_at(F.split("path", "/"), -1))
    hashes = {r["name"]: r["sha256"] for r in held.select(name.alias("name"), F.sha2("content", 256).alias("sha256")).collect()}
    from urllib.parse import unquote

    bad = [s["asset"] for s in shards if hashes.get(unquote(s["asset"])) != s["sha256"]]
    if bad:
        raise TidewellError(f"{path}: shards with other bytes {bad[:3]}")
    facts = spark.createDataFrame([(s["archive_key"], s["source_url"], s["source_size"], s["etag"], s["rows"]) for s in shards], "archive_key string, source_url string, source_size bigint, etag string, rows bigint")
    lines = spark.read.option("basePath", path).text([f"{path}/{s['asset'].rpartition('/')[0]}" for s in shards])
    out = lines.select("archive_key", F.from_json("value", "path string, offset bigint, size bigint, sha256 string").alias("r")).select("archive_key", "r.*")
    counted = out.groupBy("archive_key").agg(F.count("path").alias("n")).join(facts, "archive_key", "full").where("not (n <=> rows)").limit(3).collect()
    if counted:
        raise TidewellError(f"{path}: shards with other rows {[r['archive_key'] for r in counted]}")
    return out.join(facts.drop("rows"), "archive_key")


#: Lines that are digested together.
DIGEST_BLOCK = 1 << 16


def ordered_digest(df: DataFrame, order: str, line: str, group: str | None = None, block: int = DIGEST_BLOCK) -> DataFrame:
    """(group, lines, digest): SHA-256 of lines in the order of a whole-number key that is unique in its group.

    Lines go in blocks of ``block`` key values.  A block's digest is that of its
    lines, each followed by a line feed; the group's is that of its blocks'
    digests (64 hex digits and a line feed each) in order, empty blocks left
    out.  So a task holds one block, and the order still counts.
    """
    keys = [F.col(group).alias("group")] if group else [F.lit("").alias("group")]
    rows = df.select(*keys, F.floor(F.col(order) / block).cast("bigint").alias("block"), F.struct(F.col(order), F.concat(F.col(line), F.lit("\n")).alias("line")).alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "")
    blocks = rows.groupBy("group", "block").agg(F.count(F.lit(1)).alias("n"), F.sha2(text.cast("binary"), 256).alias("digest"))
    chain = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "digest"))), lambda x: F.concat(x["digest"], F.lit("\n"))), "")
    return blocks.groupBy("group").agg(F.sum("n").alias("lines"), F.sha2(chain.cast("binary"), 256).alias("digest"))


def streamed_digest(df: DataFrame, order: list[str], line: str) -> str:
    """SHA-256 of all lines in order, each followed by a line feed, as of one file.  Lines stream through the driver one partition at a time: for exports of a bounded size."""
    digest = hashlib.sha256()
    for r in df.orderBy(*order).select(line).toLocalIterator():
        digest.update(r[0].encode("utf-8") + b"\n")
    return digest.hexdigest()
