"""From anchor logs and native logs to the history index.

The index keeps ranges, not exploded pairs: one row per anchor and channel
with the first and last position in the channel's stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import histories, ranking, streams
from ..schemas import CHANNELS, FORMATS, FUTURE_ROWS, HISTORY_ROWS, NOMINAL_INTERVAL_US, RETAINED_INTERVAL_US, TOLERANCE_US, columns, metadata_rows
from . import rules as R
from .publish import Scratch, shared_folder
from .reports import Histogram


@dataclass
class NativeLogs:
    """Native tables of all logs, each with its ``log_name``."""

    log: DataFrame
    lidar: DataFrame
    camera: DataFrame
    image: DataFrame

    def stream(self, channels: Sequence[str]) -> DataFrame:
        """Images of the channels with position, step and canonical path.  Cameras are few: that side is broadcast by its size."""
        cameras = self.camera.where(F.col("channel").isin(list(channels))).select("log_name", F.col("token").alias("camera_token"), "channel")
        images = self.image.select("log_name", S.hex_token("token").alias("image_token"), F.col("ts_us").alias("image_ts_us"), "filename", "camera_token")
        joined = images.join(cameras, ["log_name", "camera_token"]).withColumn("camera_token", S.hex_token("camera_token"))
        indexed = streams.index_stream(joined, ["log_name", "channel"], "image_ts_us", "image_token")
        return indexed.withColumn("blob_path", S.blob_path("log_name", "channel", "filename"))


@dataclass
class Plan:
    anchor: DataFrame
    anchor_camera: DataFrame
    native_image: DataFrame
    source_log: DataFrame
    metadata: DataFrame
    inventory: DataFrame
    rules: R.Rules
    facts: dict = field(default_factory=dict)
    scratch: Scratch | None = None

    def drop(self) -> None:
        """Delete the plan's intermediates; what has been published stays."""
        if self.scratch:
            self.scratch.drop()

    def tables(self) -> dict[str, DataFrame]:
        return {"metadata": self.metadata, "source_log": self.source_log, "anchor": self.anchor, "native_image": self.native_image, "anchor_camera": self.anchor_camera}


def plan_histories(
    spark: SparkSession, rows: DataFrame, native: NativeLogs, tokens: DataFrame, scene_filter_sha256: str, channels: Sequence[str] = CHANNELS,
    cadence_tolerance_us: int = TOLERANCE_US, retained_tolerance_us: int = TOLERANCE_US, two_hz_tolerance_us: int = TOLERANCE_US,
    max_anchors: int | None = None, history: int = HISTORY_ROWS, future: int = FUTURE_ROWS, keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Plan:
    """The plan of all requested anchors, with the rules that must hold before it is published.

    Streams, anchors, matches and ranges are each used by several tables and
    rules: ``keep`` writes them once and gives back what was written (by
    default a ``publish.Scratch`` in the shared folder), which also cuts their
    lineage.
    """
    scratch = None if keep else Scratch(spark, shared_folder(spark))
    keep = keep or scratch.keep
    partial = max_anchors is not None
    wanted = tokens.select(S.token_norm("token").alias("token")).distinct()
    picked = rows.withColumn("token", F.lower("token")).join(wanted, "token", "left_semi")
    # of repeated rows of a token the first counts
    first = picked.withColumn("_n", F.row_number().over(W.partitionBy("token").orderBy("log_name", "row_index"))).where("_n = 1").drop("_n")
    if partial:
        first = ranking.prefix(first, ["log_name", "row_index"], max_anchors)
        wanted = first.select("token")
    stream = keep(native.stream(channels), "stream")
    rules = R.anchor_log_rules(spark, rows, native.log, wanted, history, future, partial)
    rules.extend(R.stream_rules(spark, stream, tolerance=cadence_tolerance_us))

    w = W.partitionBy("log_name").orderBy("row_index")
    timed = rows.select("log_name", "row_index", "ts_us").withColumn("history_start_ts_us", F.lag("ts_us", history - 1).over(w)).select("log_name", "row_index", "history_start_ts_us")
    base = first.join(timed, ["log_name", "row_index"]).select(
        F.col("token").alias("anchor_token"), "log_name", F.lower("log_token").alias("log_token"), F.lower("scene_token").alias("scene_token"), F.col("ts_us").alias("anchor_ts_us"), "row_index", "history_start_ts_us", "lidar_path"
    )
    anchors = keep(histories.resolve_lidar(base, native.lidar), "anchors")
    base = anchors.select(*base.columns)
    rules.extend(R.lidar_rules(spark, anchors))

    # the rows that anchors retain, once each, by channel
    needed = base.select("log_name", "anchor_token", F.explode(F.sequence(F.col("row_index") - (history - 1), "row_index")).alias("row_index"))
    each = rows.join(needed.select("log_name", "row_index").distinct(), ["log_name", "row_index"], "left_semi")
    by_channel = each.select("log_name", "row_index", "ts_us", F.explode(F.array(*map(F.lit, channels))).alias("channel"), "cams").withColumn("data_path", S.cam_path("cams", "channel")).drop("cams")
    matches = keep(histories.retained_match(by_channel, stream, retained_tolerance_us), "matches")
    ends = needed.join(matches, ["log_name", "row_index"]).groupBy("anchor_token", "log_name", "channel").agg(
        F.min_by("image_token", "row_index").alias("start_image_token"), F.min_by("image_ts_us", "row_index").alias("start_image_ts_us"), F.min_by("stream_index", "row_index").alias("first_stream_index"),
        F.max_by("image_token", "row_index").alias("end_image_token"), F.max_by("image_ts_us", "row_index").alias("end_image_ts_us"), F.max_by("stream_index", "row_index").alias("last_stream_index"),
        F.collect_set("stream_index").alias("_kept"),
    )
    # times in a stream are strictly increasing (a rule), so the window by time is the range by position between its ends
    inside = F.size(F.filter("_kept", lambda i: i.between(F.col("first_stream_index"), F.col("last_stream_index"))))
    ranges = keep(ends.withColumns({"frame_count": F.col("last_stream_index") - F.col("first_stream_index") + 1, "retained_inside": inside, "history_start_ts_us": F.col("start_image_ts_us"), "history_end_ts_us": F.col("end_image_ts_us")}), "ranges")
    rules.extend(R.range_rules(spark, ranges, matches, history))

    counted = streams.reference_counts(stream, ranges.select("log_name", "channel", "first_stream_index", "last_stream_index"), ["log_name", "channel"])
    images = keep(counted.where("reference_count > 0").withColumnRenamed("reference_count", "anchor_reference_count").select(*columns("native_image")), "images")
    inventory = images.select(F.lit(FORMATS["inventory"]).alias("format"), F.lit(scene_filter_sha256).alias("scene_filter_sha256"), *columns("inventory")[2:])
    rules.extend(R.reconciliation_rules(spark, anchors, ranges, images, inventory, len(channels)))
    logs = base.select("log_name", "log_token").distinct().withColumn("native_db_relative_path", F.concat(F.col("log_name"), F.lit(".db")))
    metadata = metadata_rows(spark, {
        "format": FORMATS["history"], "scene_filter_sha256": scene_filter_sha256, "cadence_tolerance_us": cadence_tolerance_us, "retained_tolerance_us": retained_tolerance_us,
        "channels": ",".join(channels), "partial": partial, "source_capture_gaps_preserved": True, "native_jpegs_verified": False,
    })
    gaps = streams.capture_gaps(stream, NOMINAL_INTERVAL_US, cadence_tolerance_us)
    exceptions = histories.cadence_exceptions(rows.join(needed.select("log_name", "row_index").distinct(), ["log_name", "row_index"], "left_semi"), ["log_name"], "row_index", "ts_us", RETAINED_INTERVAL_US, two_hz_tolerance_us)
    return Plan(anchors.select(*columns("anchor")), ranges.select(*columns("anchor_camera")), images, logs, metadata, inventory, rules, {"gaps": gaps, "exceptions": exceptions, "ranges": ranges}, scratch)


def gap_lengths(plan: Plan) -> DataFrame:
    """(delta_us, count) of the plan's capture gaps.  There may be as many lengths as gaps, so they stay a table."""
    return plan.facts["gaps"].groupBy("delta_us").count()


def plan_counts(plan: Plan) -> dict:
    """What a plan comes to, in one number each; only these come to the driver."""
    ranges, gaps = plan.facts["ranges"], plan.facts["gaps"]
    hit = gaps.select("log_name", "channel", "stream_index", "delta_us")
    # a gap touches a range if the step into it lies inside, so not at its first image
    touched = ranges.join(hit, ["log_name", "channel"]).where("stream_index > first_stream_index and stream_index <= last_stream_index")
    one = ranges.agg(F.count(F.lit(1)).alias("anchor_channels"), F.countDistinct("anchor_token").alias("anchors"), F.coalesce(F.sum("frame_count"), F.lit(0)).alias("references")).first()
    gap = gaps.agg(F.count(F.lit(1)).alias("gaps"), F.countDistinct("log_name").alias("logs"), F.countDistinct("log_name", "channel").alias("streams")).first()
    seen = touched.agg(F.countDistinct("anchor_token").alias("anchors"), F.countDistinct("anchor_token", "channel").alias("anchor_channels")).first()
    image = plan.native_image.agg(F.count(F.lit(1)).alias("images"), F.max("anchor_reference_count").alias("most")).first()
    return {
        "anchors": one["anchors"], "anchor_channels": one["anchor_channels"], "image_references": one["references"], "distinct_images": image["images"],
        "max_reference_count": image["most"], "cadence_exceptions": plan.facts["exceptions"].count(),
        "capture_gaps": gap["gaps"], "gap_logs": gap["logs"], "gap_streams": gap["streams"], "gap_anchors": seen["anchors"], "gap_anchor_channels": seen["anchor_channels"],
    }


def plan_report(plan: Plan) -> dict:
    """Counts and histograms of a plan, as one document.  The gaps' histogram has as many entries as there are lengths: it lies in a file."""
    histogram: dict[str, dict[str, int]] = {}
    for r in plan.facts["ranges"].groupBy("channel", "frame_count").count().orderBy("channel", "frame_count").collect():
        histogram.setdefault(r["channel"], {})[str(r["frame_count"])] = r["count"]
    return {**plan_counts(plan), "history_frame_counts": histogram, "gap_histogram": Histogram(gap_lengths(plan))}
