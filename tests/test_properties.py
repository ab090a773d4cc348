"""Laws that hold on any data: reconciliation, tiling, coverage, idempotent replay, order independence."""

import random

from pyspark.sql import functions as F

from tidewell.operators import joins, ranking, streams
from tidewell.plans.catalog import anchors, images
from tidewell.plans.publish import row_digest
from tidewell.streaming.incremental import Ledger


def test_references_reconcile(spark, data):
    """The sum of frame counts is the sum of reference counts."""
    ranges = anchors(spark, data).select("stream_id", F.col("s0").alias("first_stream_index"), F.col("stream_index").alias("last_stream_index"))
    frames = ranges.agg(F.sum(F.col("last_stream_index") - F.col("first_stream_index") + 1)).first()[0]
    counted = streams.reference_counts(images(spark, data).select("stream_id", "stream_index", "image_token"), ranges, ["stream_id"])
    assert counted.agg(F.sum("reference_count")).first()[0] == frames > 0
    assert counted.count() == images(spark, data).count()


def test_offsets_tile(spark):
    random.seed(0)
    rows = [(k % 3, k, random.randint(1, 50)) for k in range(60)]
    laid = ranking.pack_offsets(spark.createDataFrame(rows, "pack int, n int, size bigint"), ["pack"], ["n"], "size")
    for r in ranking.tiling(laid, ["pack"], "pack_offset", "size").collect():
        assert r["misplaced"] == 0 and r["end"] == sum(s for p, _, s in rows if p == r["pack"])
    assert ranking.tiling(laid.where("n <> 30"), ["pack"], "pack_offset", "size").where("misplaced > 0").count() == 1


def test_positions_do_not_depend_on_partitions(spark):
    keys = random.Random(1).sample(range(10_000), 200)
    got = {}
    for parts in (1, 7):
        df = spark.createDataFrame([(k,) for k in keys], "key bigint").repartition(parts)
        got[parts] = {r["key"]: r["position"] for r in ranking.global_position(df, "key", 512).collect()}
    assert got[1] == got[7] == {k: n for n, k in enumerate(sorted(keys))}


def test_interval_join_is_exact(spark):
    rng = random.Random(2)
    intervals = [(n, rng.randint(0, 2), (a := rng.randint(-50, 200)), a + rng.choice((0, 3, 90))) for n in range(40)]
    points = [(rng.randint(0, 2), rng.randint(-60, 300)) for _ in range(80)]
    for width in (1, 7, 1000):
        got = joins.interval_join(spark.createDataFrame(intervals, "n int, k int, lo bigint, hi bigint"), spark.createDataFrame(points, "k int, at bigint"), ["k"], "lo", "hi", "at", width)
        assert sorted((r["n"], r["at"]) for r in got.collect()) == sorted((n, t) for n, k, lo, hi in intervals for j, t in points if j == k and lo <= t <= hi)


def test_replay_counts_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), {"a": 1})
    rows = spark.range(5)
    ledger.write(rows, 0)
    ledger.write(spark.range(9), 0)  # the batch is committed: a replay changes nothing
    ledger.write(rows, 1)
    assert ledger.committed() == [0, 1] and ledger.rows().count() == 10


def test_digest_ignores_order(spark):
    df = spark.createDataFrame([(k, None if k % 3 else "x") for k in range(50)], "a int, b string")
    assert row_digest(df) == row_digest(df.orderBy(F.desc("a")).repartition(7)) != row_digest(df.where("a > 0"))
    assert row_digest(df) != row_digest(df.withColumn("b", F.coalesce("b", F.lit(""))))
