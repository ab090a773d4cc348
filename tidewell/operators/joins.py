"""Joins of the engine, each with an equality key at its core."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(intervals: DataFrame, points: DataFrame, keys: Sequence[str], low: str, high: str, point: str, width: int) -> DataFrame:
    """Points inside inclusive intervals of the same keys.

    Time is cut into bins of ``width``: an interval goes to each bin it meets,
    a point to its own, and the bin is one more equality key.  So the join
    stays a hash or merge join whose groups are as small as the bins, however
    long a stream is.
    """
    left = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width).cast("bigint"), F.floor(F.col(high) / width).cast("bigint"))))
    right = points.withColumn("_bin", F.floor(F.col(point) / width).cast("bigint"))
    return left.join(right, [*keys, "_bin"]).where(F.col(point).between(F.col(low), F.col(high))).drop("_bin")


def coverage(expected: DataFrame, actual: DataFrame, keys: Sequence[str], compare: Sequence[str] = ()) -> DataFrame:
    """Full outer merge of two tables with ``class``: both, missing (only expected), extra (only actual) or differs."""
    mark = {c: F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}")) for c in compare}
    joined = expected.withColumn("_e", F.lit(True)).alias("e").join(actual.withColumn("_a", F.lit(True)).alias("a"), list(keys), "full_outer")
    same = F.lit(True)
    for test in mark.values():
        same = same & test
    kind = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(same, "both").otherwise("differs")
    return joined.select(*keys, kind.alias("class"))


def override(base: DataFrame, over: DataFrame, keys: Sequence[str], columns: dict[str, str], when: Column) -> DataFrame:
    """Left join that replaces ``columns`` (base name to override name) where ``when`` holds and the override has a value."""
    side = over.select(*keys, *(F.col(v).alias(f"_o_{k}") for k, v in columns.items()))
    joined = base.join(side, list(keys), "left")
    return joined.withColumns({k: F.when(when, F.coalesce(F.col(f"_o_{k}"), F.col(k))).otherwise(F.col(k)) for k in columns}).drop(*(f"_o_{k}" for k in columns))


def exactly_one_side(df: DataFrame, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Adds ``in_left``, ``in_right`` and ``exactly_one``; the two lists are reduced to distinct keys first."""
    out = df.join(left.select(key).distinct().withColumn("in_left", F.lit(True)), key, "left").join(right.select(key).distinct().withColumn("in_right", F.lit(True)), key, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("in_left", "in_right")})
    return out.withColumn("exactly_one", F.col("in_left") != F.col("in_right"))


def unique_match(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Left keys with the number of right rows of the same key and, where it is one, its value."""
    hits = right.groupBy(key).agg(F.count(F.lit(1)).alias("hits"), F.min(value).alias("match"))
    out = left.join(hits, key, "left")
    return out.withColumns({"hits": F.coalesce("hits", F.lit(0).cast("bigint")), "match": F.when(F.col("hits") == 1, F.col("match"))})


def to_fetch(wanted: DataFrame, receipts: DataFrame) -> DataFrame:
    """Wanted (path, identity, ...) without a receipt for the same identity."""
    return wanted.join(receipts.select("path", "identity"), ["path", "identity"], "left_anti")


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether both hold the same set of keys."""
    return difference(a, b, key).isEmpty() and difference(b, a, key).isEmpty()


def disjoint_union(parts: Sequence[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(union of the parts, keys that more than one row has)."""
    out = parts[0].withColumn("part", F.lit(0))
    for k, part in enumerate(parts[1:], 1):
        out = out.unionByName(part.withColumn("part", F.lit(k)))
    return out, out.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("part").alias("parts")).where("rows > 1")


def conflicts(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys with several rows, and how many different payloads they carry; more than one is a conflict, else a harmless repeat."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(F.struct(*payload)).alias("payloads")).where("rows > 1")


def fallback_match(left: DataFrame, key: str, right: DataFrame, value: str, first: Sequence[str], second: Sequence[str]) -> DataFrame:
    """(key, candidates, match, method): right rows on the ``first`` columns and, only for keys that find none, on the ``second``."""

    def hits(rows: DataFrame, on: Sequence[str], method: str) -> DataFrame:
        found = rows.join(right.select(*dict.fromkeys([*on, value])), list(on))
        return found.groupBy(key).agg(F.count(F.lit(1)).alias("candidates"), F.min(value).alias("match")).withColumn("method", F.lit(method))

    direct = hits(left, first, "first")
    rest = left.join(direct.select(key), key, "left_anti")
    found = direct.unionByName(hits(rest, second, "second"))
    out = left.select(key).join(found, key, "left")
    return out.withColumns({"candidates": F.coalesce("candidates", F.lit(0).cast("bigint")), "method": F.coalesce("method", F.lit("none"))})
