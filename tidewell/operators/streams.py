"""Image streams: position, time steps, gaps, and what refers to them.

All of these are windows over one partitioning (the stream's keys), so they
share a single exchange; none joins a stream with itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import omitted_frames


def index_stream(images: DataFrame, keys: Sequence[str], ts: str, token: str) -> DataFrame:
    """Adds ``stream_index`` (0-based position by time, then token) and ``delta_us`` (null for the first)."""
    w = W.partitionBy(*keys).orderBy(ts, token)
    return images.withColumns({"stream_index": (F.row_number().over(w) - 1).cast("bigint"), "delta_us": F.col(ts) - F.lag(ts).over(w)})


def gap_condition(delta: str, nominal_us: int, tolerance_us: int) -> Column:
    return F.col(delta) > nominal_us + tolerance_us


def capture_gaps(stream: DataFrame, nominal_us: int, tolerance_us: int) -> DataFrame:
    """Steps longer than nominal by more than the tolerance, with the frames they skip.  Gaps are reported, never filled."""
    return stream.where(gap_condition("delta_us", nominal_us, tolerance_us)).withColumn("omitted", omitted_frames("delta_us", nominal_us))


def short_intervals(stream: DataFrame, nominal_us: int, tolerance_us: int) -> DataFrame:
    """Steps that are not positive or are shorter than nominal by more than the tolerance: violations."""
    return stream.where((F.col("delta_us") <= 0) | (F.col("delta_us") < nominal_us - tolerance_us))


def with_running_gaps(stream: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Adds ``gaps_so_far``: a range's gaps are then the difference at its ends, with no join."""
    w = W.partitionBy(*keys).orderBy("stream_index").rowsBetween(W.unboundedPreceding, 0)
    return stream.withColumn("gaps_so_far", F.sum(F.when(condition, 1).otherwise(0)).over(w))


def reference_counts(images: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Images with ``reference_count``: how many inclusive ranges (first_stream_index, last_stream_index) hold them.

    A range is a step up at its first index and a step down behind its last;
    the count is the running sum.  Rows stay ranges: nothing is exploded into
    one row per image and range.
    """
    up = ranges.select(*keys, F.col("first_stream_index").alias("i"), F.lit(1).alias("step"))
    down = ranges.select(*keys, (F.col("last_stream_index") + 1).alias("i"), F.lit(-1).alias("step"))
    steps = up.unionByName(down).groupBy(*keys, "i").agg(F.sum("step").alias("step"))
    rest = [c for c in images.columns if c not in keys and c != "stream_index"]
    both = images.select(*keys, F.col("stream_index").alias("i"), F.lit(0).cast("bigint").alias("step"), F.struct(*rest).alias("image")).unionByName(
        steps.withColumn("image", F.lit(None)), allowMissingColumns=True
    )
    w = W.partitionBy(*keys).orderBy("i", F.col("image").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    counted = both.withColumn("reference_count", F.sum("step").over(w)).where("image is not null")
    return counted.select(*keys, F.col("i").alias("stream_index"), *(F.col(f"image.{c}").alias(c) for c in rest), "reference_count")


def sessions(stream: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Adds ``segment``: the number of gaps so far, so that a stream falls into gap-free stretches."""
    w = W.partitionBy(*keys).orderBy("stream_index").rowsBetween(W.unboundedPreceding, 0)
    return stream.withColumn("segment", F.sum(F.when(condition, 1).otherwise(0)).over(w))
