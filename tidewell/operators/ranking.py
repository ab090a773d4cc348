"""Order, limits, samples and batches, deterministic whatever the partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import TidewellError


#: Blocks that are summed in one task.
FAN_OUT = 4096


def global_position(df: DataFrame, key: str, width: int) -> DataFrame:
    """Adds ``position`` (0-based) in the order of a unique whole-number key, without one task for all rows.

    Keys are counted by blocks of ``width``, blocks by groups of FAN_OUT; a
    block's offset is the sum of the groups before its own (one row for
    ``width * FAN_OUT`` keys) and of the blocks before it in its group, and
    ranks are taken in blocks.
    """
    block = F.floor(F.col(key) / width)
    counts = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_group", F.floor(F.col("_block") / FAN_OUT))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_n")).select("_group", earlier(W.orderBy("_group")).alias("_before"))
    offsets = counts.withColumn("_inside", earlier(W.partitionBy("_group").orderBy("_block"))).join(groups, "_group").select("_block", (F.col("_before") + F.col("_inside")).alias("_offset"))
    inside = W.partitionBy("_block").orderBy(key)
    placed = df.withColumn("_block", block).withColumn("_rank", F.row_number().over(inside) - 1).join(offsets, "_block")
    return placed.withColumn("position", (F.col("_offset") + F.col("_rank")).cast("bigint")).drop("_block", "_offset", "_rank")


def batches(df: DataFrame, key: str, size: int, width: int = 4096) -> DataFrame:
    """Adds ``batch``: blocks of ``size`` rows in key order."""
    return global_position(df, key, width).withColumn("batch", F.floor(F.col("position") / size).cast("bigint")).drop("position")


def prefix(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; the order must not tie."""
    return df.orderBy(*order).limit(n)


def first_at_or_after(df: DataFrame, key: str, probes: Sequence) -> DataFrame:
    """(probe, key) with the least key not below each probe (null if none): one aggregation for all probes."""
    picks = df.agg(*(F.min(F.when(F.col(key) >= F.lit(p), F.col(key))).alias(f"p{k}") for k, p in enumerate(probes)))
    rows = F.array(*(F.struct(F.lit(p).alias("probe"), F.col(f"p{k}").alias(key)) for k, p in enumerate(probes)))
    return picks.select(F.inline(rows))


def first_offenders(df: DataFrame, group: str, key: str, n: int = 8) -> DataFrame:
    """(group, shown): the first ``n`` distinct keys of each group; what is not shown is never gathered."""
    ranked = df.select(group, key).distinct().withColumn("_rank", F.row_number().over(W.partitionBy(group).orderBy(key))).where(F.col("_rank") <= n)
    return ranked.groupBy(group).agg(F.array_sort(F.collect_list(key)).alias("shown"))


def sample_logs(ranges: DataFrame, samples: int, seed: int, log: str = "log_name", token: str = "anchor_token") -> DataFrame:
    """A seeded sample of anchors with at least two frames, from distinct logs: the least keyed hash wins in each log and among logs."""
    keyed = ranges.where("frame_count >= 2").withColumn("_h", F.sha2(F.concat_ws("|", F.lit(str(seed)), token), 256))
    each = keyed.withColumn("_r", F.row_number().over(W.partitionBy(log).orderBy("_h", token))).where("_r = 1")
    picked = each.orderBy("_h", token).limit(samples)
    if picked.count() != samples:
        raise TidewellError(f"fewer than {samples} logs to sample from")
    return picked.drop("_h", "_r")


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the last value at or before each row that is not null."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def pack_offsets(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, name: str = "pack_offset") -> DataFrame:
    """Adds where each payload begins when payloads of a pack are laid end to end."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(size).over(w), F.lit(0)).cast("bigint"))


def tiling(df: DataFrame, keys: Sequence[str], offset: str, size: str) -> DataFrame:
    """(keys, payloads, misplaced, end): offsets in order must begin at 0 without gap or overlap."""
    w = W.partitionBy(*keys).orderBy(offset, size).rowsBetween(W.unboundedPreceding, -1)
    placed = df.withColumn("_want", F.coalesce(F.sum(size).over(w), F.lit(0)))
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("payloads"), F.count_if(F.col(offset) != F.col("_want")).alias("misplaced"), F.max(F.col(offset) + F.col(size)).alias("end"))
