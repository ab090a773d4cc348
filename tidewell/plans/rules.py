"""Validation rules: each is a DataFrame of violations (rule, key, detail) that must be empty.

Rules are collected and evaluated together, so a report names all kinds of
faults, and nothing is published while any row is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import RuleViolation
from ..functions import scalars as S
from ..operators import joins, ranking, streams
from ..schemas import CHANNELS, KEYS, MAX_IMAGE_BYTES, NOMINAL_INTERVAL_US, TAR_BLOCK, TOLERANCE_US

VIOLATION = "rule string, key string, detail string"


class Rules:
    def __init__(self, spark: SparkSession):
        self.spark, self.parts = spark, []

    def add(self, rule: str, bad: DataFrame, key: Column | str, detail: Column | str = "") -> Rules:
        key = F.col(key) if isinstance(key, str) else key
        detail = F.lit(detail) if isinstance(detail, str) else detail
        self.parts.append(bad.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")))
        return self

    def extend(self, other: Rules) -> Rules:
        self.parts += other.parts
        return self

    def violations(self) -> DataFrame:
        out = self.spark.createDataFrame([], VIOLATION)
        for part in self.parts:
            out = out.unionByName(part)
        return out

    def summary(self) -> DataFrame:
        """(rule, violations, shown): counts by rule with the first keys."""
        found = self.violations()
        shown = ranking.first_offenders(found.where("key is not null"), "rule", "key", 8)
        return found.groupBy("rule").agg(F.count(F.lit(1)).alias("violations")).join(shown, "rule", "left")

    def enforce(self, what: str, most: int = 1000) -> None:
        """Raises RuleViolation with offenders of each rule if any row is left.  One evaluation; at most ``most`` rows come to the driver."""
        found: dict[str, list] = {}
        for r in self.violations().limit(most).collect():
            found.setdefault(r["rule"], []).append(r["key"])
        if found:
            text = "; ".join(f"{rule}: {len(keys)} ({', '.join(sorted(k or '' for k in keys)[:8])})" for rule, keys in sorted(found.items()))
            raise RuleViolation(f"{what}: {text}", found.items())


def text_key(*columns: str) -> Column:
    return F.concat_ws("/", *(F.col(c).cast("string") for c in columns))


def unique(rules: Rules, name: str, df: DataFrame, keys: Sequence[str] | None = None) -> Rules:
    keys = list(keys or KEYS[name])
    return rules.add(f"{name}.unique", df.groupBy(*keys).count().where("count > 1"), text_key(*keys), F.col("count"))


def anchor_log_rules(spark, rows: DataFrame, logs: DataFrame, requested: DataFrame, history: int, future: int, partial: bool = False) -> Rules:
    """Of anchor rows (one row per log position) and requested tokens: tokens found once, in their log, with their history and future, in time order."""
    rules = Rules(spark)
    w = W.partitionBy("log_name").orderBy("row_index")
    framed = rows.withColumns({
        "n_rows": F.count(F.lit(1)).over(W.partitionBy("log_name")), "delta": F.col("ts_us") - F.lag("ts_us").over(w),
        "back": F.count_if(F.lit(True)).over(w.rowsBetween(-(history - 1), 0)),
        "least": F.min(F.col("ts_us") - F.lit(0)).over(w.rowsBetween(-(history - 1), 0)), "start": F.lag("ts_us", history - 1).over(w),
    })
    wide = framed.withColumn("steps", F.min("delta").over(w.rowsBetween(-(history - 2), 0)))
    chosen = wide.join(requested.select(F.lower("token").alias("want")).distinct(), F.lower("token") == F.col("want"), "left_semi")
    unique(rules, "anchor", chosen.select(F.col("token").alias("anchor_token")))
    rules.add("anchor.log", chosen.where(~F.col("row_log_name").eqNullSafe(F.col("log_name"))), "token", F.col("row_log_name"))
    rules.add("anchor.history", chosen.where(F.col("back") < history), "token", F.col("row_index"))
    rules.add("anchor.future", chosen.where(F.col("row_index") + future >= F.col("n_rows")), "token", F.col("row_index"))
    rules.add("anchor.order", chosen.where((F.col("back") == history) & (F.col("steps") <= 0)), "token", F.col("steps"))
    if not partial:
        rules.add("anchor.found", requested.join(rows.select(F.lower("token").alias("t")), F.lower("token") == F.col("t"), "left_anti"), "token")
    identity = rows.select("log_name", "log_token").distinct().join(logs.select("log_name", S.hex_token("token").alias("native_token"), "logfile"), "log_name", "left")
    rules.add("log.identity", identity.where((F.lower("log_token") != F.col("native_token")) | ~F.col("logfile").eqNullSafe(F.col("log_name"))), "log_name", F.col("native_token"))
    rules.add("log.one", rows.select("log_name").distinct().join(logs.groupBy("log_name").count(), "log_name", "left").where("coalesce(count, 0) <> 1"), "log_name", F.col("count"))
    return rules


def lidar_rules(spark, anchors: DataFrame) -> Rules:
    """Exactly one LiDAR record, which agrees in time, scene and file name."""
    rules = Rules(spark)
    rules.add("lidar.one", anchors.where("lidar_candidates <> 1"), "anchor_token", F.col("lidar_candidates"))
    one = anchors.where("lidar_candidates = 1")
    differs = (F.col("lidar_ts_us") != F.col("anchor_ts_us")) | (F.col("lidar_scene_token") != F.lower("scene_token")) | (S.basename("lidar_filename") != S.basename("lidar_path"))
    rules.add("lidar.agrees", one.where(differs | ((F.col("mapping_method") == "native_lidar_token") & (F.col("lidar_token") != F.lower("anchor_token")))), "anchor_token")
    return rules


def stream_rules(spark, stream: DataFrame, nominal: int = NOMINAL_INTERVAL_US, tolerance: int = TOLERANCE_US) -> Rules:
    """Native streams: positive steps, none much shorter than nominal, safe file names."""
    rules = Rules(spark)
    rules.add("stream.cadence", streams.short_intervals(stream, nominal, tolerance), text_key("log_name", "channel", "image_token"), F.col("delta_us"))
    rules.add("stream.path", stream.where("blob_path is null"), text_key("log_name", "channel", "filename"))
    return rules


def range_rules(spark, ranges: DataFrame, matches: DataFrame, history: int) -> Rules:
    """Ranges: every retained row matched once, start before end, retained images inside, positions without a hole."""
    rules = Rules(spark)
    rules.add("retained.one", matches.where("candidates <> 1"), text_key("log_name", "channel", "row_index"), F.col("candidates"))
    rules.add("range.order", ranges.where("start_image_ts_us > end_image_ts_us"), text_key("anchor_token", "channel"))
    rules.add("range.contiguous", ranges.where("last_stream_index - first_stream_index + 1 <> frame_count"), text_key("anchor_token", "channel"), F.col("frame_count"))
    rules.add("range.retained", ranges.where(F.col("retained_inside") != history), text_key("anchor_token", "channel"), F.col("retained_inside"))
    return rules


def reconciliation_rules(spark, anchors: DataFrame, ranges: DataFrame, images: DataFrame, inventory: DataFrame, channels: int) -> Rules:
    """Totals agree: ranges per anchor, references by ranges and by images, images and inventory."""
    one = lambda df, e: df.agg(e.alias("v")).select(F.coalesce("v", F.lit(0)).cast("bigint").alias("v"))
    n = F.count(F.lit(1))
    pairs = [
        ("totals.ranges", one(anchors, n * channels), one(ranges, n)), ("totals.references", one(ranges, F.sum("frame_count")), one(images, F.sum("anchor_reference_count"))),
        ("totals.inventory", one(images, F.sum("anchor_reference_count")), one(inventory, F.sum("anchor_reference_count"))), ("totals.images", one(images, n), one(inventory, n)),
    ]
    rules = Rules(spark)
    for name, a, b in pairs:
        both = a.withColumn("k", F.lit(1)).join(b.select(F.col("v").alias("w"), F.lit(1).alias("k")), "k")
        rules.add(name, both.where("v <> w"), F.lit(name), F.concat_ws(" vs ", "v", "w"))
    return rules


def history_rules(spark, histories: DataFrame, tolerance: int, expected_frames: int | None = None) -> Rules:
    """What a reader checks of each (anchor, channel): ``frames`` is the ordered array of its images (stream_index, image_token, image_ts_us)."""
    ts = lambda i: F.element_at("frames", i)["image_ts_us"]
    n = F.size("frames")
    # steps between neighbours, for the rules on order and cadence
    steps = F.zip_with(F.slice("frames", 1, n - 1), F.slice("frames", 2, n - 1), lambda a, b: b["image_ts_us"] - a["image_ts_us"])
    checks = {
        "channel": ~F.col("channel").startswith("CAM_"), "range": (F.col("first_stream_index") < 0) | (F.col("last_stream_index") < F.col("first_stream_index")),
        "frame_count": F.col("frame_count") != F.col("last_stream_index") - F.col("first_stream_index") + 1, "rows": n != F.col("frame_count"),
        "order": F.col("history_start_ts_us") > F.col("history_end_ts_us"),
        "near": (F.abs(F.col("history_end_ts_us") - F.col("anchor_ts_us")) > tolerance) | (F.abs(F.col("history_start_ts_us") - F.col("anchor_start_ts_us")) > tolerance),
        "ends": (F.col("start_image_ts_us") != F.col("history_start_ts_us")) | (F.col("end_image_ts_us") != F.col("history_end_ts_us")),
        "contiguous": (F.element_at("frames", 1)["stream_index"] != F.col("first_stream_index")) | (F.element_at("frames", -1)["stream_index"] != F.col("last_stream_index")),
        "window": (ts(1) < F.col("history_start_ts_us")) | (ts(-1) > F.col("history_end_ts_us")), "monotone": F.exists(steps, lambda d: d <= 0),
        "cadence": F.exists(steps, lambda d: d < NOMINAL_INTERVAL_US - tolerance),
        "end_images": (F.element_at("frames", 1)["image_token"] != F.col("start_image_token")) | (F.element_at("frames", -1)["image_token"] != F.col("end_image_token")),
    }
    if expected_frames is not None:
        checks["fixed_length"] = F.col("frame_count") != expected_frames
    safe = histories.withColumn("_some", n > 0)
    failed = F.filter(F.array(*(F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in checks.items())), lambda x: x.isNotNull())
    found = safe.withColumn("_failed", F.when(F.col("_some"), failed).otherwise(F.array(F.lit("rows")))).where(F.size("_failed") > 0)
    rules = Rules(spark)
    return rules.add("history", found, text_key("anchor_token", "channel"), F.array_join("_failed", ","))


def inventory_rules(spark, inventory: DataFrame, train: DataFrame, val: DataFrame) -> Rules:
    """One filter hash of 64 hex digits; canonical paths; each log in exactly one split; no repeats."""
    rules = Rules(spark)
    rules.add("inventory.filter", inventory.groupBy().agg(F.countDistinct("scene_filter_sha256").alias("n"), F.min("scene_filter_sha256").alias("h")).where((F.col("n") > 1) | ((F.col("n") == 1) & ~S.is_sha256("h"))), F.lit("filter"), F.col("n"))
    rules.add("inventory.path", inventory.where(~F.coalesce(F.col("blob_path").eqNullSafe(S.blob_path("log_name", "channel", "filename")), F.lit(False)) | F.col("blob_path").isNull()), "blob_path")
    rules.add("inventory.split", joins.exactly_one_side(inventory.select("log_name").distinct(), train, val, "log_name").where("not exactly_one"), "log_name")
    rules.add("inventory.unique", inventory.groupBy("blob_path").count().where("count > 1"), "blob_path", F.col("count"))
    return rules


def listing_rules(spark, archives: DataFrame, listing: DataFrame) -> Rules:
    """Archives are listed with a size, and size and normalised ETag are as before."""
    now = listing.select("archive_key", F.col("listed_size").alias("size_now"), S.etag_norm("etag").alias("etag_now"))
    both = archives.join(now, "archive_key", "left")
    rules = Rules(spark)
    rules.add("archive.listed", both.where("size_now is null or size_now <= 0"), "archive_key")
    rules.add("archive.unchanged", both.where("size_now is not null").where((F.col("listed_size") != F.col("size_now")) | ~S.etag_norm("etag").eqNullSafe(F.col("etag_now"))), "archive_key")
    return rules


def image_rules(spark, members: DataFrame, content: str = "content") -> Rules:
    """Payloads: a size up to the maximum, ``.jpg``, start and end markers, and the hash if one is promised."""
    rules = Rules(spark)
    size = F.length(content)
    rules.add("image.size", members.where((size <= 0) | (size > MAX_IMAGE_BYTES)), "member_name", size)
    rules.add("image.name", members.where(~S.has_suffix("member_name", ".jpg") | ~S.is_safe_path("member_name")), "member_name")
    rules.add("image.markers", members.where(~S.is_jpeg(content)), "member_name")
    rules.add("image.sha256", members.where(F.col("sha256").isNotNull() & (S.sha256(content) != F.col("sha256"))), "member_name")
    return rules


def storage_rules(spark, target: DataFrame, storage: DataFrame, progress: DataFrame, root: str) -> Rules:
    """Pack state: targets covered one to one, rows sound, kinds as they must be, packs tiled from 0 to their size, counts as stated."""
    rules = Rules(spark)
    covered = joins.coverage(target.select("archive_key", "member_name", "destination"), storage.select("archive_key", "member_name", "destination"), ["archive_key", "member_name"], ["destination"])
    rules.add("pack.coverage", covered.where("class <> 'both'"), text_key("archive_key", "member_name"), F.col("class"))
    sound = (F.col("payload_size") > 0) & S.is_sha256("sha256") & (F.col("header_offset") >= 0) & (F.col("header_offset") % TAR_BLOCK == 0) & (F.col("data_offset") == F.col("header_offset") + TAR_BLOCK)
    rules.add("pack.row", storage.where(~F.coalesce(sound, F.lit(False))), text_key("archive_key", "member_name"))
    own = storage.join(progress.select("archive_key", "pack_path", "pack_bytes"), "archive_key", "left")
    packed = (F.col("storage_kind") == "pack") & (F.col("storage_path") == F.col("pack_path")) & F.col("pack_offset").isNotNull()
    existing = (F.col("storage_kind") == "existing") & F.col("pack_offset").isNull() & S.is_safe_path("storage_path") & (F.size(S.parts("storage_path")) == 3) & S.has_suffix("storage_path", ".jpg")
    rules.add("pack.kind", own.where(~F.coalesce(packed | existing, F.lit(False))), text_key("archive_key", "member_name"), F.col("storage_kind"))
    rules.add("pack.path", progress.where(~S.is_pack_path("pack_path", root)), "archive_key", F.col("pack_path"))
    tiled = ranking.tiling(storage.where("storage_kind = 'pack'"), ["archive_key"], "pack_offset", "payload_size")
    ends = progress.join(tiled, "archive_key", "left")
    rules.add("pack.tiling", ends.where((F.coalesce("misplaced", F.lit(0)) > 0) | (F.coalesce("end", F.lit(0)) != F.col("pack_bytes"))), "archive_key", F.col("end"))
    whole = (F.col("packed_count") + F.col("existing_count") == F.col("target_done")) & (F.col("target_done") == F.col("target_total")) & (F.col("target_total") > 0) & (F.col("status") == "complete")
    rules.add("pack.complete", progress.where(~F.coalesce(whole, F.lit(False))), "archive_key", F.col("status"))
    return rules


def storage_index_rules(spark, index: DataFrame, progress: DataFrame, pack_sizes: DataFrame, archives: int, verification: DataFrame | None) -> Rules:
    """Storage index: all archives once and complete, kinds known, slices inside their pack, and a native check of reused rows unless they are trusted."""
    rules = Rules(spark)
    unique(rules, "image_storage", index)
    unique(rules, "archive_progress", progress)
    rules.add("index.archives", progress.agg(F.countDistinct("archive_key").alias("n"), F.bool_and(F.col("status") == "complete").alias("done")).where((F.col("n") != archives) | ~F.coalesce("done", F.lit(False))), F.lit("archives"), F.col("n"))
    rules.add("index.kind", index.where(~F.col("storage_kind").isin("existing", "pack", "supplemental_pack")), "destination", F.col("storage_kind"))
    bounds = index.where("storage_kind <> 'existing'").join(pack_sizes.select(F.col("path").alias("storage_path"), F.col("length").alias("size")), "storage_path", "left")
    rules.add("index.bounds", bounds.where(F.coalesce((F.col("pack_offset") + F.col("payload_size") > F.col("size")) | (F.col("pack_offset") < 0), F.lit(True))), "destination")
    if verification is not None:
        rules.add("index.verified", progress.join(verification, "archive_key", "left").where(F.coalesce((F.col("v_status") != "complete") | (F.col("checked_count") != F.col("existing_count")), F.lit(True))), "archive_key")
    return rules


def export_rules(spark, rows: DataFrame) -> Rules:
    """Direct index: distinct destinations, data behind its header, aligned, inside the archive, hashes of 64 hex digits or none."""
    rules = Rules(spark)
    rules.add("export.unique", rows.groupBy("path").count().where("count > 1"), "path", F.col("count"))
    bad = (F.col("offset") != F.col("header_offset") + TAR_BLOCK) | (F.col("header_offset") % TAR_BLOCK != 0) | (F.col("offset") + F.col("size") > F.col("source_size"))
    rules.add("export.bounds", rows.where(F.coalesce(bad, F.lit(True))), "path")
    rules.add("export.sha256", rows.where(F.col("sha256").isNotNull() & ~S.is_sha256("sha256")), "path")
    return rules


def audit_rules(spark, index_tokens: DataFrame, official: DataFrame, requested: DataFrame, anchors: DataFrame, raw: DataFrame, full: bool) -> Rules:
    """Index within the official tokens, requests within the index (equal on a full run), and the index's anchors as in the raw rows."""
    rules = Rules(spark)
    rules.add("audit.official", joins.difference(index_tokens, official, "token"), "token")
    rules.add("audit.requested", joins.difference(requested, index_tokens, "token"), "token")
    if full:
        rules.add("audit.full", joins.difference(official, index_tokens, "token"), "token")
    both = anchors.alias("a").join(raw.alias("r"), F.col("a.anchor_token") == F.lower("r.token"))
    differs = ~(
        F.col("a.log_name").eqNullSafe(F.col("r.log_name")) & F.col("a.log_token").eqNullSafe(F.lower("r.log_token")) & F.col("a.scene_token").eqNullSafe(F.lower("r.scene_token"))
        & F.col("a.anchor_ts_us").eqNullSafe(F.col("r.ts_us")) & F.col("a.row_index").eqNullSafe(F.col("r.row_index"))
    )
    return rules.add("audit.provenance", both.where(differs), "anchor_token")


def missing_files(spark, wanted: DataFrame, listing: DataFrame, rule: str = "file.missing") -> Rules:
    """Paths without a file of that path."""
    return Rules(spark).add(rule, wanted.select("path").distinct().join(listing.select("path"), "path", "left_anti"), "path")


def parse_channels(text: str) -> list[str]:
    """Comma-separated channels: known, distinct, at least one; upper-cased."""
    names = [x.strip().upper() for x in text.split(",") if x.strip()]
    if not names or len(set(names)) != len(names) or any(x not in CHANNELS for x in names):
        raise ValueError(f"bad channel list {text!r}")
    return names


def reject_held_out(paths: Sequence[str], markers: Sequence[str] = ("private_test", "heldout", "hidden")) -> None:
    """Refuses paths that name held-out data; ``test`` counts only as a whole part of a path."""
    for path in paths:
        low = str(path).lower()
        if any(m in low for m in markers) or "test" in low.split("/"):
            raise ValueError(f"held-out data: {path}")


def require_https(url: str) -> str:
    """A base address without a trailing slash; anything but https is refused."""
    from urllib.parse import urlsplit

    parts = urlsplit(url)
    if parts.scheme != "https" or not parts.hostname or parts.query or parts.fragment or parts.username:
        raise ValueError(f"{url!r} is not a plain https address")
    return url.rstrip("/")


def check_arguments(tolerances: dict[str, int] | None = None, suffixes: dict[str, tuple[str | None, str]] | None = None, counts: dict[str, tuple[int | None, int, int]] | None = None) -> None:
    """Of a tool's arguments: tolerances are not negative, (path, suffix) fit, (number, least, most) lie within; all faults are named together."""
    faults = [f"{name} is negative" for name, v in (tolerances or {}).items() if v < 0]
    faults += [f"{name} must end in {end}" for name, (path, end) in (suffixes or {}).items() if path and not path.lower().endswith(end)]
    faults += [f"{name} must be {least} to {most}" for name, (n, least, most) in (counts or {}).items() if n is not None and not least <= n <= most]
    if faults:
        raise ValueError("; ".join(faults))


def archive_list_rules(spark, archives: DataFrame, allowed: Sequence[str]) -> Rules:
    """Archives (archive_key, listed_size) by base name: one of the allowed ones, no base name twice, sizes above zero."""
    named = archives.withColumn("name", S.basename("archive_key"))
    rules = Rules(spark)
    rules.add("archives.known", named.where(~F.col("name").isin(list(allowed))), "archive_key")
    rules.add("archives.unique", named.groupBy("name").count().where("count > 1"), "name", F.col("count"))
    return rules.add("archives.size", named.where("listed_size is null or listed_size <= 0"), "archive_key", F.col("listed_size"))
