"""Anchors and their histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import basename, hex_token
def anchor_frames(rows: DataFrame, keys: Sequence[str], order: str, ts: str, history: int, future: int) -> DataFrame:
    """Adds to retained rows their 4-row style history: ``history_start_index/ts``, whether enough earlier and later rows exist."""
    w = W.partitionBy(*keys).orderBy(order)
    return rows.withColumns({
        "history_start_index": F.lag(order, history - 1).over(w), "history_start_ts": F.lag(ts, history - 1).over(w),
        "has_history": F.lag(order, history - 1).over(w).isNotNull(), "has_future": F.lead(order, future).over(w).isNotNull() if future else F.lit(True),
    })


def cadence_exceptions(rows: DataFrame, keys: Sequence[str], order: str, ts: str, nominal_us: int, tolerance_us: int) -> DataFrame:
    """Steps between retained rows that differ from nominal by more than the tolerance; counted by step, not by anchor."""
    w = W.partitionBy(*keys).orderBy(order)
    step = rows.withColumn("retained_delta_us", F.col(ts) - F.lag(ts).over(w))
    return step.where(F.abs(F.col("retained_delta_us") - nominal_us) > tolerance_us)


def retained_match(rows: DataFrame, images: DataFrame, tolerance_us: int) -> DataFrame:
    """For each retained row and channel its native image: same log, channel and file name, time within the tolerance.

    The file name is an equality key, so this is a hash join with a residual
    band, not a nearest match.  ``candidates`` counts the images found; the
    rule is that it is one.
    """
    left = rows.select("log_name", "channel", "row_index", F.col("ts_us").alias("row_ts_us"), basename("data_path").alias("file"))
    right = images.select("log_name", "channel", basename("filename").alias("file"), "image_token", "image_ts_us", "stream_index")
    found = left.join(right, ["log_name", "channel", "file"], "left").where(F.col("image_ts_us").isNull() | (F.abs(F.col("image_ts_us") - F.col("row_ts_us")) <= tolerance_us))
    hits = found.groupBy("log_name", "channel", "row_index", "row_ts_us").agg(
        F.count("image_token").alias("candidates"), F.min("image_token").alias("image_token"), F.min("image_ts_us").alias("image_ts_us"), F.min("stream_index").alias("stream_index")
    )
    # rows whose only namesakes are out of the band have no candidate
    return left.select("log_name", "channel", "row_index", "row_ts_us").distinct().join(hits.drop("row_ts_us"), ["log_name", "channel", "row_index"], "left").withColumn(
        "candidates", F.coalesce("candidates", F.lit(0).cast("bigint"))
    )


def resolve_lidar(anchors: DataFrame, lidar: DataFrame) -> DataFrame:
    """LiDAR record of each anchor: by token, and only where no token fits by time and file name.

    Both ways are one join, on keys tagged with the way; which counts is
    decided when an anchor's hits are folded.  ``lidar_candidates`` must be
    one; ``mapping_method`` names the way.
    """
    fields = ["lidar_token", "lidar_ts_us", "lidar_scene_token", "lidar_filename"]
    points = lidar.select(
        "log_name", hex_token("token").alias("lidar_token"), F.col("ts_us").alias("lidar_ts_us"), hex_token("scene_token").alias("lidar_scene_token"), F.col("filename").alias("lidar_filename"),
    )

    def keyed(rows: DataFrame, keep: list, token: Column, ts: str, file: str) -> DataFrame:
        by_file = F.concat(F.lit("f"), F.col(ts).cast("string"), F.lit("/"), basename(file))
        return rows.select("log_name", *keep, F.explode(F.array(F.concat(F.lit("t"), token), by_file)).alias("_key")).where("_key is not null")

    left = keyed(anchors, ["anchor_token"], F.lower("anchor_token"), "anchor_ts_us", "lidar_path")
    right = keyed(points, [F.struct(*fields).alias("_hit")], F.col("lidar_token"), "lidar_ts_us", "lidar_filename")
    by_token = F.col("_key").startswith("t")
    hits = left.join(right, ["log_name", "_key"]).groupBy("log_name", "anchor_token").agg(
        F.min(F.when(by_token, F.col("_hit"))).alias("_by_token"), F.count_if(by_token).alias("_tokens"), F.min(F.when(~by_token, F.col("_hit"))).alias("_by_file"), F.count_if(~by_token).alias("_files")
    )
    out, token = anchors.join(hits, ["log_name", "anchor_token"], "left"), F.col("_tokens") > 0
    hit = F.when(token, F.col("_by_token")).otherwise(F.col("_by_file"))
    method = F.when(token, "native_lidar_token").when(F.col("_files") > 0, "native_lidar_timestamp_and_filename")
    return out.select(*anchors.columns, *(hit[f].alias(f) for f in fields), F.coalesce(F.when(token, F.col("_tokens")).otherwise(F.col("_files")), F.lit(0).cast("bigint")).alias("lidar_candidates"), method.alias("mapping_method"))


def history_ranges(anchors: DataFrame, images: DataFrame, keys: Sequence[str], start_ts: str, end_ts: str, ts: str) -> DataFrame:
    """Each anchor's images by time, both ends included, folded to one range: first and last index and time, and count.

    Anchors' ends are merged into the stream as rows of their own: the images
    before an end are a running count over one partitioning of the stream, so
    there is no join and a window of any length costs two rows.  Anchors
    without an image in their window are left out.
    """
    names = list(anchors.columns)
    null = F.lit(None)
    image = images.select(*keys, F.col(ts).alias("_at"), F.lit(1).alias("_kind"), null.cast(anchors.select(F.struct(*names)).schema[0].dataType).alias("_anchor"), F.struct(F.col("stream_index").alias("i"), F.col(ts).alias("t")).alias("_image"))
    kind = image.schema["_image"].dataType
    end = lambda at, n: anchors.select(*keys, F.col(at).alias("_at"), F.lit(n).alias("_kind"), F.struct(*names).alias("_anchor"), null.cast(kind).alias("_image"))
    rows = image.unionByName(end(start_ts, 0)).unionByName(end(end_ts, 2))  # at one time: starts, images, ends
    before = W.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    behind = W.partitionBy(*keys).orderBy(F.desc("_at"), F.desc("_kind"), F.desc("_image.i")).rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumns({"_n": F.count("_image").over(before), "_last": F.max("_image").over(before), "_next": F.last("_image", ignorenulls=True).over(behind)})
    start, stop = F.col("_kind") == 0, F.col("_kind") == 2
    both = placed.where("_kind <> 1").groupBy(*keys, "_anchor").agg(
        F.max(F.when(start, F.col("_next"))).alias("_first"), F.max(F.when(stop, F.col("_last"))).alias("_end"), (F.max(F.when(stop, F.col("_n"))) - F.max(F.when(start, F.col("_n")))).alias("frame_count")
    )
    return both.where("frame_count > 0").select(
        *(F.col(f"_anchor.{c}").alias(c) for c in names), F.col("_first.i").alias("first_stream_index"), F.col("_end.i").alias("last_stream_index"), "frame_count", F.col("_first.t").alias("first_ts_us"), F.col("_end.t").alias("last_ts_us")
    )


def contiguous(first: str = "first_stream_index", last: str = "last_stream_index", count: str = "frame_count") -> Column:
    return F.col(last) - F.col(first) + 1 == F.col(count)


def expand_ranges(ranges: DataFrame, images: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges to (range, image) rows by position: exploded to exact indices, so the join is on equality and has no skewed band."""
    each = ranges.withColumn("stream_index", F.explode(F.sequence("first_stream_index", "last_stream_index")))
    return each.join(images, [*keys, "stream_index"])


def pad_histories(histories: DataFrame, group: str, values: str, size: int | None = None, pad: Column | None = None) -> DataFrame:
    """Pads each array to ``size`` (by default the longest of its group) with ``pad``, and adds ``valid``.

    A history is never cut: one longer than ``size`` is a violation and gives null arrays.
    """
    pad = F.lit(-1).cast("bigint") if pad is None else pad
    n = F.lit(size) if size is not None else F.max(F.size(values)).over(W.partitionBy(group))
    out = histories.withColumn("_n", n).withColumn("_m", F.size(values))
    fits = F.col("_m") <= F.col("_n")
    return out.withColumns({
        values: F.when(fits, F.concat(values, F.array_repeat(pad, F.col("_n") - F.col("_m")))),
        "valid": F.when(fits, F.concat(F.array_repeat(F.lit(True), F.col("_m")), F.array_repeat(F.lit(False), F.col("_n") - F.col("_m")))),
    }).drop("_n", "_m")
