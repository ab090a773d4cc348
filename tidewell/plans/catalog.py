"""The query catalogue: each operator on the test tables, with equivalent SQL.

``events`` stands in for image streams: a user is a stream, an event an image.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import histories, joins, ranking, streams
from . import publish

GAP_US, SHORT_US, OMITTED_US = 100_000_000_000, 1_000_000_000, 20_000_000_000
HOUR_US = 3_600_000_000

CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CATALOG[name] = f, sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("stream_id"), F.col("event_id").alias("image_token"), micros("ts").alias("ts_us"), "event_type")
    return streams.index_stream(events, ["stream_id"], "ts_us", "image_token")


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth image is retained; a retained image with three before it is an anchor."""
    gaps = streams.with_running_gaps(images(spark, sf_dir), ["stream_id"], F.col("delta_us") > GAP_US)
    w = W.partitionBy("stream_id").orderBy("stream_index")
    kept = gaps.where("stream_index % 5 = 0")
    return kept.withColumns({"s0": F.lag("stream_index", 3).over(w), "h0": F.lag("ts_us", 3).over(w), "g0": F.lag("gaps_so_far", 3).over(w)}).where("s0 is not null")


IMG = """img AS (SELECT user_id AS stream_id, event_id AS image_token, epoch_us(ts) AS ts_us, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS stream_index,
    epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta_us FROM events)"""
ANC = IMG + """, anc AS (SELECT * FROM (SELECT *, lag(stream_index, 3) OVER w AS s0, lag(ts_us, 3) OVER w AS h0 FROM img WHERE stream_index % 5 = 0
    WINDOW w AS (PARTITION BY stream_id ORDER BY stream_index)) WHERE s0 IS NOT NULL)"""


@query("anchor_history", f"""WITH {ANC} SELECT a.stream_id, a.image_token AS anchor_token, a.ts_us AS anchor_ts_us, min(i.stream_index) AS first_stream_index,
    max(i.stream_index) AS last_stream_index, count(*) AS frame_count, min(i.ts_us) AS start_ts_us, max(i.ts_us) AS end_ts_us,
    count(*) FILTER (i.delta_us > {GAP_US} AND i.stream_index > a.s0) AS gaps
    FROM anc a JOIN img i ON a.stream_id = i.stream_id AND i.stream_index BETWEEN a.s0 AND a.stream_index GROUP BY 1, 2, 3""")  # fmt: skip
def anchor_history(spark, sf_dir):
    # index ranges and running gap counts make the history a difference at its ends: one exchange, no join
    return anchors(spark, sf_dir).select(
        "stream_id", F.col("image_token").alias("anchor_token"), F.col("ts_us").alias("anchor_ts_us"), F.col("s0").alias("first_stream_index"),
        F.col("stream_index").alias("last_stream_index"), (F.col("stream_index") - F.col("s0") + 1).alias("frame_count"), F.col("h0").alias("start_ts_us"),
        F.col("ts_us").alias("end_ts_us"), (F.col("gaps_so_far") - F.col("g0")).alias("gaps"),
    )


@query("history_time_window", f"""WITH {ANC} SELECT a.stream_id, a.image_token AS anchor_token, min(i.stream_index) AS first_stream_index, max(i.stream_index) AS last_stream_index, count(*) AS frame_count
    FROM anc a JOIN img i ON a.stream_id = i.stream_id AND i.ts_us BETWEEN a.h0 AND a.ts_us GROUP BY 1, 2""")
def history_time_window(spark, sf_dir):
    anc = anchors(spark, sf_dir).select("stream_id", F.col("image_token").alias("anchor_token"), "h0", F.col("ts_us").alias("anchor_ts_us"))
    out = histories.history_ranges(anc, images(spark, sf_dir), ["stream_id"], "h0", "anchor_ts_us", "ts_us")
    return out.select("stream_id", "anchor_token", "first_stream_index", "last_stream_index", "frame_count")


@query("image_refcount", f"""WITH {ANC} SELECT i.stream_id, i.image_token, count(*) AS reference_count
    FROM anc a JOIN img i ON a.stream_id = i.stream_id AND i.stream_index BETWEEN a.s0 AND a.stream_index GROUP BY 1, 2""")
def image_refcount(spark, sf_dir):
    ranges = anchors(spark, sf_dir).select("stream_id", F.col("s0").alias("first_stream_index"), F.col("stream_index").alias("last_stream_index"))
    counted = streams.reference_counts(images(spark, sf_dir).select("stream_id", "stream_index", "image_token"), ranges, ["stream_id"])
    return counted.where("reference_count > 0").select("stream_id", "image_token", "reference_count")


@query("interval_join", f"""WITH {IMG} SELECT p.stream_id, p.image_token, count(*) AS near FROM img p JOIN img i ON p.stream_id = i.stream_id AND i.ts_us BETWEEN p.ts_us - {HOUR_US} AND p.ts_us + {HOUR_US} WHERE p.event_type = 'purchase' GROUP BY 1, 2""")
def interval_join(spark, sf_dir):
    img = images(spark, sf_dir)
    rows = img.where("event_type = 'purchase'").select("stream_id", "image_token", (F.col("ts_us") - HOUR_US).alias("lo"), (F.col("ts_us") + HOUR_US).alias("hi"))
    near = joins.interval_join(rows, img.select("stream_id", F.col("ts_us").alias("at")), ["stream_id"], "lo", "hi", "at", 4 * HOUR_US)
    return near.groupBy("stream_id", "image_token").agg(F.count(F.lit(1)).alias("near"))


@query("fallback_match", """WITH c AS (SELECT c_custkey, c_custkey AS k1, c_nationkey::BIGINT AS k2, c_custkey % 10 AS k3 FROM customer WHERE c_mktsegment = 'BUILDING'), o AS (SELECT o_orderkey, o_custkey AS k1, o_orderkey % 25 AS k2, o_orderkey % 10 AS k3 FROM orders),
    d AS (SELECT o_orderkey, count(*) AS candidates, min(c_custkey) AS hit, 'first' AS method FROM o JOIN c USING (k1) GROUP BY 1),
    r AS (SELECT o_orderkey, count(*) AS candidates, min(c_custkey) AS hit, 'second' AS method FROM o JOIN c USING (k2, k3) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d) GROUP BY 1)
    SELECT coalesce(m.method, 'none') AS method, coalesce(m.candidates, 0) AS candidates, count(*) AS n, sum(m.hit)::BIGINT AS hits FROM orders LEFT JOIN (SELECT * FROM d UNION ALL SELECT * FROM r) m USING (o_orderkey) GROUP BY 1, 2""")
def fallback_match(spark, sf_dir):
    right = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", F.col("c_custkey").alias("k1"), F.col("c_nationkey").cast("bigint").alias("k2"), (F.col("c_custkey") % 10).alias("k3"))
    left = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k1"), (F.col("o_orderkey") % 25).alias("k2"), (F.col("o_orderkey") % 10).alias("k3"))
    found = joins.fallback_match(left, "o_orderkey", right, "c_custkey", ["k1"], ["k2", "k3"])
    return found.groupBy("method", "candidates").agg(F.count(F.lit(1)).alias("n"), F.sum("match").alias("hits"))


@query("range_expand", f"""WITH {ANC} SELECT a.stream_id, a.image_token AS anchor_token, i.image_token FROM anc a JOIN img i ON a.stream_id = i.stream_id AND i.stream_index BETWEEN a.s0 AND a.stream_index""")
def range_expand(spark, sf_dir):
    ranges = anchors(spark, sf_dir).select("stream_id", F.col("image_token").alias("anchor_token"), F.col("s0").alias("first_stream_index"), F.col("stream_index").alias("last_stream_index"))
    return histories.expand_ranges(ranges, images(spark, sf_dir).select("stream_id", "stream_index", "image_token"), ["stream_id"]).select("stream_id", "anchor_token", "image_token")


@query("stream_index", f"WITH {IMG} SELECT stream_id, image_token, ts_us, stream_index FROM img")
def stream_index(spark, sf_dir):
    return images(spark, sf_dir).select("stream_id", "image_token", "ts_us", "stream_index")


@query("delta_us", f"WITH {IMG} SELECT stream_id, image_token, delta_us FROM img WHERE delta_us IS NOT NULL")
def delta_us(spark, sf_dir):
    return images(spark, sf_dir).where("delta_us is not null").select("stream_id", "image_token", "delta_us")


@query("capture_gaps", f"WITH {IMG} SELECT stream_id, count(*) AS gaps, max(delta_us) AS longest_us FROM img WHERE delta_us > {GAP_US} GROUP BY 1")
def capture_gaps(spark, sf_dir):
    found = streams.capture_gaps(images(spark, sf_dir), GAP_US, 0)
    return found.groupBy("stream_id").agg(F.count(F.lit(1)).alias("gaps"), F.max("delta_us").alias("longest_us"))


@query("gap_histogram", f"WITH {IMG} SELECT (delta_us // 10000000000)::BIGINT AS bucket, count(*) AS n, count(DISTINCT stream_id) AS affected FROM img WHERE delta_us > {GAP_US} GROUP BY 1")
def gap_histogram(spark, sf_dir):
    found = streams.capture_gaps(images(spark, sf_dir), GAP_US, 0).withColumn("bucket", F.floor(F.col("delta_us") / 10_000_000_000).cast("bigint"))
    return found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("stream_id").alias("affected"))


@query("omitted_frames", f"WITH {IMG} SELECT stream_id, image_token, greatest(0, round_even(delta_us / {OMITTED_US}.0::DOUBLE, 0)::BIGINT - 1)::BIGINT AS omitted FROM img WHERE delta_us > {OMITTED_US}")
def omitted_frames(spark, sf_dir):
    return streams.capture_gaps(images(spark, sf_dir), OMITTED_US, 0).select("stream_id", "image_token", "omitted")


@query("short_interval_violations", f"WITH {IMG} SELECT stream_id, image_token, delta_us FROM img WHERE delta_us < {SHORT_US} OR delta_us <= 0")
def short_interval_violations(spark, sf_dir):
    return streams.short_intervals(images(spark, sf_dir), SHORT_US, 0).select("stream_id", "image_token", "delta_us")


@query("cadence_exceptions", f"""WITH {IMG}, kept AS (SELECT stream_id, image_token, ts_us - lag(ts_us) OVER (PARTITION BY stream_id ORDER BY stream_index) AS retained_delta_us FROM img WHERE stream_index % 5 = 0)
    SELECT stream_id, image_token, retained_delta_us FROM kept WHERE abs(retained_delta_us - 200000000000) > {GAP_US}""")
def cadence_exceptions(spark, sf_dir):
    kept = images(spark, sf_dir).where("stream_index % 5 = 0")
    return histories.cadence_exceptions(kept, ["stream_id"], "stream_index", "ts_us", 200_000_000_000, GAP_US).select("stream_id", "image_token", "retained_delta_us")


@query("history_bounds", f"""WITH {IMG}, k AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY stream_id) AS n FROM img WHERE stream_index % 5 = 0 WINDOW w AS (PARTITION BY stream_id ORDER BY stream_index))
    SELECT stream_id, image_token, r > 3 AS has_history, r + 10 <= n AS has_future FROM k WHERE r <= 3 OR r + 10 > n""")
def history_bounds(spark, sf_dir):
    kept = images(spark, sf_dir).where("stream_index % 5 = 0")
    framed = histories.anchor_frames(kept, ["stream_id"], "stream_index", "ts_us", 4, 10)
    return framed.where("not has_history or not has_future").select("stream_id", "image_token", "has_history", "has_future")


@query("batches", "SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // 8)::BIGINT AS batch FROM customer")
def batches(spark, sf_dir):
    return ranking.batches(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 8)


@query("group_carry_forward", """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header FROM conversations""")
def group_carry_forward(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("mark"))
    return ranking.carry_forward(rows, ["conv_id"], ["turn"], "mark", "header").select("conv_id", "turn", "header")


@query("pack_offsets", "SELECT source, doc_id, n_chars, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pack_offset FROM documents")
def pack_offsets(spark, sf_dir):
    return ranking.pack_offsets(read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], ["doc_id"], "n_chars")


@query("pack_tiling_check", """WITH p AS (SELECT source, doc_id, n_chars, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + CASE WHEN doc_id % 97 = 0 THEN 1 ELSE 0 END AS pack_offset FROM documents),
    q AS (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY pack_offset, n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS want FROM p)
    SELECT source, count(*) AS payloads, count(*) FILTER (pack_offset <> want) AS misplaced, max(pack_offset + n_chars)::BIGINT AS "end" FROM q GROUP BY 1""")
def pack_tiling_check(spark, sf_dir):
    laid = pack_offsets(spark, sf_dir).withColumn("pack_offset", F.col("pack_offset") + F.when(F.col("doc_id") % 97 == 0, 1).otherwise(0))
    return ranking.tiling(laid, ["source"], "pack_offset", "n_chars")


@query("coverage_full_outer", """SELECT CASE WHEN p.k IS NULL THEN 'extra' WHEN d.doc_id IS NULL THEN 'missing' ELSE 'both' END AS class, count(*) AS n
    FROM documents d FULL OUTER JOIN (SELECT 5 * page_id AS k FROM pages) p ON d.doc_id = p.k GROUP BY 1""")
def coverage_full_outer(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select((5 * F.col("page_id")).alias("doc_id"))
    return joins.coverage(pages, read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query("verification_override", "SELECT d.doc_id, CASE WHEN d.n_chars % 2 = 0 THEN coalesce(l.quality::BIGINT, d.n_chars) ELSE d.n_chars END AS value FROM documents d LEFT JOIN labels l USING (doc_id)")
def verification_override(spark, sf_dir):
    base = read(spark, sf_dir, "documents").select("doc_id", "n_chars", F.col("n_chars").alias("value"))
    return joins.override(base, read(spark, sf_dir, "labels").withColumn("quality", F.col("quality").cast("bigint")), ["doc_id"], {"value": "quality"}, F.col("n_chars") % 2 == 0).select("doc_id", "value")


@query("dual_group_xor", """SELECT n_nationkey, n_regionkey IN (0, 1) AS in_left, n_nationkey % 3 = 0 AS in_right, (n_regionkey IN (0, 1)) <> (n_nationkey % 3 = 0) AS exactly_one FROM nation""")
def dual_group_xor(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    return joins.exactly_one_side(nation, nation.where("n_regionkey in (0, 1)"), nation.where("n_nationkey % 3 = 0"), "n_nationkey").select("n_nationkey", "in_left", "in_right", "exactly_one")


@query("unique_match", """WITH p AS (SELECT page_id, regexp_extract(url, '[^/]*$') AS file FROM pages), h AS (SELECT file, count(*) AS hits, min(page_id) AS m FROM p GROUP BY 1)
    SELECT page_id, hits, CASE WHEN hits = 1 THEN m END AS match FROM p JOIN h USING (file)""")
def unique_match(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", S.basename("url").alias("file"))
    return joins.unique_match(pages, pages.select("file", F.col("page_id").alias("other")), "file", "other").select("page_id", "hits", "match")


@query("hash_probe", """SELECT p_brand, count(*) AS n, sum(l_quantity)::DOUBLE AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 10 GROUP BY 1""")
def hash_probe(spark, sf_dir):
    part = read(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity").join(part, "l_partkey").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("semi", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def semi(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left_semi").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("anti", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def anti(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left_anti").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("receipt_resume", """WITH w AS (SELECT doc_id::VARCHAR AS path, sha256(text) AS identity, doc_id FROM documents)
    SELECT path, identity FROM w WHERE NOT (doc_id % 3 = 0 OR doc_id % 3 = 1 AND doc_id % 2 = 0)""")
def receipt_resume(spark, sf_dir):
    wanted = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), S.sha256("text").alias("identity"), "doc_id")
    # a third are receipted as they are, some as they were not (and so are fetched again)
    receipts = wanted.where("doc_id % 3 = 0").unionByName(wanted.where("doc_id % 3 = 1").withColumn("identity", F.when(F.col("doc_id") % 2 == 0, F.col("identity")).otherwise("stale")))
    return joins.to_fetch(wanted, receipts).select("path", "identity")


@query("set_diff", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_diff(spark, sf_dir):
    return joins.difference(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id")


@query("set_intersect", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def set_intersect(spark, sf_dir):
    return joins.intersection(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id")


@query("set_union_disjoint", """WITH u AS (SELECT c_custkey AS id, 0 AS part FROM customer UNION ALL SELECT s_suppkey, 1 FROM supplier)
    SELECT id, count(*) AS rows, count(DISTINCT part) AS parts FROM u GROUP BY 1 HAVING count(*) > 1""")
def set_union_disjoint(spark, sf_dir):
    return joins.disjoint_union([read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))], "id")[1]


@query("conflict_dedup", """SELECT l_orderkey, l_linenumber, count(*) AS rows, count(DISTINCT (l_partkey, l_suppkey)) AS payloads FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def conflict_dedup(spark, sf_dir):
    return joins.conflicts(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("status_counts", "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("progress_sums", """SELECT count(*) AS archives, coalesce(sum(n_chars), 0)::BIGINT AS chars, coalesce(sum(doc_id % 7), 0)::BIGINT AS done, coalesce(sum(CASE WHEN lang = 'en' THEN n_chars END), 0)::BIGINT AS english,
    coalesce(sum(CASE WHEN lang = 'xx' THEN n_chars END), 0)::BIGINT AS none, max(n_chars) AS largest FROM documents""")
def progress_sums(spark, sf_dir):
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return read(spark, sf_dir, "documents").agg(
        F.count(F.lit(1)).alias("archives"), zero(F.sum("n_chars")).alias("chars"), zero(F.sum(F.col("doc_id") % 7)).alias("done"),
        zero(F.sum(F.when(F.col("lang") == "en", F.col("n_chars")))).alias("english"), zero(F.sum(F.when(F.col("lang") == "xx", F.col("n_chars")))).alias("none"), F.max("n_chars").alias("largest"),
    )


@query("conditional_sums", "SELECT user_id, count(*) FILTER (event_type = 'purchase') AS complete, count(*) FILTER (event_type <> 'purchase') AS other, bool_and(value > 1) AS all_large FROM events GROUP BY 1")
def conditional_sums(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("complete"), F.count_if(F.col("event_type") != "purchase").alias("other"), F.bool_and(F.col("value") > 1).alias("all_large"))


@query("distinct_keys", "SELECT lang, count(DISTINCT source) AS sources, count(*) AS n FROM documents GROUP BY 1")
def distinct_keys(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.countDistinct("source").alias("sources"), F.count(F.lit(1)).alias("n"))


@query("frame_histogram", f"""WITH {ANC} SELECT a.stream_id % 8 AS channel, string_agg(fc || ':' || n, ',' ORDER BY fc) AS histogram FROM
    (SELECT stream_id % 8 AS channel, stream_index - s0 + 1 AS fc, count(*) AS n FROM anc GROUP BY 1, 2) h JOIN (SELECT DISTINCT stream_id % 8 AS stream_id FROM anc) a ON h.channel = a.stream_id GROUP BY 1""")
def frame_histogram(spark, sf_dir):
    counts = anchors(spark, sf_dir).groupBy((F.col("stream_id") % 8).alias("channel"), (F.col("stream_index") - F.col("s0") + 1).alias("frame_count")).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("frame_count", "n")))
    return counts.groupBy("channel").agg(F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["frame_count"].cast("string"), x["n"].cast("string"))), ",").alias("histogram"))


@query("ordered_digest", """WITH b AS (SELECT source, doc_id // 100 AS block, count(*) AS n, sha256(string_agg(doc_id || ' ' || lang || chr(10), '' ORDER BY doc_id)) AS digest FROM documents GROUP BY 1, 2)
    SELECT source AS "group", sum(n)::BIGINT AS lines, sha256(string_agg(digest || chr(10), '' ORDER BY block)) AS digest FROM b GROUP BY 1""")
def ordered_digest(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("source", "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(" "), "lang").alias("line"))
    return publish.ordered_digest(rows, "doc_id", "line", "source", block=100)


@query("max_anchors_prefix", f"WITH {ANC} SELECT stream_id, image_token FROM anc ORDER BY stream_id, stream_index LIMIT 100")
def max_anchors_prefix(spark, sf_dir):
    return ranking.prefix(anchors(spark, sf_dir), ["stream_id", "stream_index"], 100).select("stream_id", "image_token")


@query("probe_sample", """WITH r AS (SELECT min(o_custkey) AS lo, max(o_custkey) AS hi FROM orders), p AS (SELECT lo + (hi + 50 - lo) * i // 19 AS probe FROM r, unnest(range(20)) AS u(i))
    SELECT probe, min(o_custkey) AS o_custkey FROM p LEFT JOIN orders ON o_custkey >= probe GROUP BY 1""")
def probe_sample(spark, sf_dir):
    """Twenty probes spread over the range of the keys and a little beyond."""
    orders = read(spark, sf_dir, "orders")
    lo, hi = orders.agg(F.min("o_custkey"), F.max("o_custkey")).first()
    return ranking.first_at_or_after(orders, "o_custkey", [lo + (hi + 50 - lo) * k // 19 for k in range(20)]).withColumn("probe", F.col("probe").cast("bigint"))


@query("top_offenders", """SELECT source, string_agg(doc_id, ',' ORDER BY doc_id) AS shown FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 8 GROUP BY 1""")
def top_offenders(spark, sf_dir):
    out = ranking.first_offenders(read(spark, sf_dir, "documents"), "source", "doc_id")
    return out.select("source", F.array_join(F.transform("shown", lambda x: x.cast("string")), ",").alias("shown"))


@query("pad_histories", """WITH h AS (SELECT conv_id, role, list(turn ORDER BY turn) AS a FROM conversations GROUP BY 1, 2), m AS (SELECT *, max(len(a)) OVER (PARTITION BY conv_id) AS n FROM h)
    SELECT conv_id, role, array_to_string(list_concat(a, list_transform(range(n - len(a)), lambda x: -1)), ',') AS turns, len(a) AS valid_count FROM m""")
def pad_histories(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    out = histories.pad_histories(rows, "conv_id", "turns")
    return out.select("conv_id", "role", F.array_join(F.transform("turns", lambda x: x.cast("string")), ",").alias("turns"), F.size(F.filter("valid", lambda x: x)).cast("bigint").alias("valid_count"))


@query("content_sha", "SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents")
def content_sha(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.sha256(F.coalesce("text", F.lit(""))).alias("sha"))


@query("content_crc", """SELECT c_custkey, xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(length(c_name)), lambda i: [ascii(substr(c_name, i + 1, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) AS crc FROM customer""")
def content_crc(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", S.crc32("c_name").alias("crc"))


@query("token_norm", "SELECT c_custkey, lower(trim(' ' || c_name || '  ')) AS token FROM customer")
def token_norm(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", S.token_norm(F.concat(F.lit(" "), "c_name", F.lit("  "))).alias("token"))


@query("basename", "SELECT page_id, regexp_extract(url, '[^/]*$') AS file FROM pages")
def basename(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", S.basename("url").alias("file"))


@query("safe_path", """SELECT page_id, x NOT LIKE '%\\%' AND NOT regexp_matches(x, '(^|/)(\\.{1,2})?(/|$)') AND length(x) > 0 AS safe FROM (SELECT page_id, regexp_extract(url, '://[^/]*/(.*)', 1) AS x FROM pages)""")
def safe_path(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", S.is_safe_path(F.regexp_extract("url", "://[^/]*/(.*)", 1)).alias("safe"))


@query("etag_norm", """WITH e AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'W/"' || p_brand || '"' WHEN 1 THEN '"' || p_brand || '"' WHEN 2 THEN '"' || p_brand ELSE p_brand END AS raw FROM part),
    b AS (SELECT p_partkey, regexp_replace(raw, '^W/', '') AS bare FROM e)
    SELECT p_partkey, CASE WHEN length(bare) >= 2 AND bare LIKE '"%"' THEN substr(bare, 2, length(bare) - 2) ELSE bare END AS etag FROM b""")
def etag_norm(spark, sf_dir):
    raw = F.expr("""CASE p_size % 4 WHEN 0 THEN concat('W/"', p_brand, '"') WHEN 1 THEN concat('"', p_brand, '"') WHEN 2 THEN concat('"', p_brand) ELSE p_brand END""")
    return read(spark, sf_dir, "part").select("p_partkey", S.etag_norm(raw).alias("etag"))


@query("key_parse", """SELECT p_partkey, CASE WHEN p_size % 3 < 2 THEN CASE WHEN p_size % 3 = 0 THEN 'train' ELSE 'val' END END AS split, CASE WHEN p_size % 3 < 2 THEN p_size::BIGINT END AS "group" FROM part""")
def key_parse(spark, sf_dir):
    split = F.expr("CASE p_size % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'other' END")
    keys = read(spark, sf_dir, "part").select("p_partkey", S.archive_key(split, F.col("p_size"), "public", "sensors").alias("key"))
    return keys.select("p_partkey", S.archive_split("key").alias("split"), S.archive_group("key").alias("group"))


@query("json_extract", "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def json_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("trigger_case", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 11 = 0 THEN 'force' WHEN o_totalprice >= 300000 THEN 'size_threshold' WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN 'packing_complete'
    WHEN o_totalprice < 50000 THEN 'relay_space_pressure' END AS reason FROM orders""")
def trigger_case(spark, sf_dir):
    reason = S.trigger_reason(F.expr("o_orderstatus = 'F' and o_orderkey % 11 = 0"), "o_totalprice", F.lit(300_000), F.expr("o_orderstatus = 'O' and o_orderkey % 5 = 0"), "o_totalprice", F.lit(50_000))
    return read(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"))


@query("octal_padding", "SELECT doc_id, n_chars AS size, (ceil(n_chars / 512.0) * 512)::BIGINT AS padded, (1024 + 512 + ceil(n_chars / 512.0) * 512)::BIGINT AS next_header FROM documents")
def octal_padding(spark, sf_dir):
    field = F.concat(F.lpad(F.conv(F.col("n_chars").cast("string"), 10, 8), 11, "0"), F.lit("\0")).cast("binary")
    sized = read(spark, sf_dir, "documents").select("doc_id", S.tar_number(field).alias("size"))
    return sized.select("doc_id", "size", S.padded_size("size").alias("padded"), S.next_header(F.lit(1024), "size").alias("next_header"))


@query("session_gap", f"WITH {IMG} SELECT stream_id, image_token, sum(CASE WHEN delta_us > {GAP_US} THEN 1 ELSE 0 END) OVER (PARTITION BY stream_id ORDER BY stream_index ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM img")
def session_gap(spark, sf_dir):
    return streams.sessions(images(spark, sf_dir), ["stream_id"], F.col("delta_us") > GAP_US).select("stream_id", "image_token", "segment")


@query("violation_report", f"""WITH {IMG} SELECT 'stream.cadence' AS rule, count(*) AS violations FROM img WHERE delta_us < {SHORT_US} OR delta_us <= 0 HAVING count(*) > 0
    UNION ALL SELECT 'lineitem.unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) HAVING count(*) > 0
    UNION ALL SELECT 'labels.document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) HAVING count(*) > 0""")
def violation_report(spark, sf_dir):
    from .rules import Rules, missing_files, text_key, unique

    rules = Rules(spark).add("stream.cadence", streams.short_intervals(images(spark, sf_dir), SHORT_US, 0), text_key("stream_id", "image_token"))
    unique(rules, "lineitem", read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    rules.extend(missing_files(spark, read(spark, sf_dir, "labels").select(F.col("doc_id").alias("path")), read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path")), "labels.document"))
    return rules.violations().groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))


@query("storage_plan", """WITH t AS (SELECT doc_id, source, n_chars, n_chars % 3 = 0 AS kept FROM documents)
    SELECT doc_id, CASE WHEN kept THEN 'existing' ELSE 'pack' END AS storage_kind,
    CASE WHEN NOT kept THEN coalesce(sum(n_chars) OVER (PARTITION BY source, kept ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT END AS pack_offset FROM t""")
def storage_plan(spark, sf_dir):
    from .ledger import plan_packs

    docs = read(spark, sf_dir, "documents")
    located = docs.select(
        F.concat(F.lit("public/train_set/sensors_train_camera_"), F.substring("source", 4, 9), F.lit(".zip")).alias("archive_key"), F.col("doc_id").cast("string").alias("member_name"),
        F.concat(F.lit("sensor_blobs/"), F.col("doc_id").cast("string")).alias("destination"), F.col("n_chars").alias("member_size"), (F.col("doc_id") * 512).alias("header_offset"), (F.col("doc_id") * 512 + 512).alias("data_offset"),
    )
    existing = docs.where("n_chars % 3 = 0").select(F.concat(F.lit("sensor_blobs/"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("length"))
    return plan_packs(located, existing).select(F.col("member_name").cast("bigint").alias("doc_id"), "storage_kind", "pack_offset")


@query("snapshot_choice", """SELECT max(lang) AS snapshot FROM (SELECT lang FROM documents GROUP BY lang HAVING count(DISTINCT source) = 20 AND count(*) > 0)""")
def snapshot_choice(spark, sf_dir):
    from .ledger import newest_complete

    states = read(spark, sf_dir, "documents").select(F.col("lang").alias("snapshot"), F.col("source").alias("archive_key"), F.lit("complete").alias("status"), F.lit(1).alias("target_total"), F.lit(1).alias("target_done")).distinct()
    return spark.createDataFrame([(newest_complete(states, 20),)], "snapshot string")


@query("tar_roundtrip", """WITH d AS (SELECT doc_id, doc_id % 64 AS archive, strlen(coalesce(text, ''))::BIGINT AS size FROM documents),
    o AS (SELECT *, coalesce(sum(512 + (size + 511) // 512 * 512) OVER (PARTITION BY archive ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS header_offset FROM d)
    SELECT doc_id, size, header_offset, header_offset + 512 AS data_offset, true AS same FROM o""")
def tar_roundtrip(spark, sf_dir):
    """Documents written to TAR archives in memory and walked again, an archive a task; every member must come back as it went in."""

    def walk(key, docs):
        import io
        import tarfile

        import pandas as pd

        from ..sources.ranges import MemoryClient
        from ..sources.tar import TarArchive

        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as tar:
            for r in docs.sort_values("doc_id").itertuples():
                info = tarfile.TarInfo(f"{r.doc_id}.txt")
                info.size = len(r.content)
                tar.addfile(info, io.BytesIO(r.content))
        archive, held = TarArchive(MemoryClient({"a": out.getvalue()}), "a"), {f"{r.doc_id}.txt": r.content for r in docs.itertuples()}
        rows = [(int(m.name[:-4]), m.size, m.header_offset, m.data_offset, archive.read(m) == held[m.name]) for m in archive.members()]
        return pd.DataFrame(rows, columns=["doc_id", "size", "header_offset", "data_offset", "same"])

    docs = read(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(64)).alias("archive"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return docs.groupBy("archive").applyInPandas(walk, "doc_id bigint, size bigint, header_offset bigint, data_offset bigint, same boolean")


@query("zip_directory", "SELECT page_id, 8::BIGINT AS method, strlen(html)::BIGINT AS size, true AS smaller, true AS crc_right, true AS whole FROM pages")
def zip_directory(spark, sf_dir):
    """Pages written to ZIP archives in memory; the central directory as rows."""

    def walk(key, pages):
        import io
        import zipfile
        import zlib

        import pandas as pd

        from ..sources.ranges import MemoryClient
        from ..sources.zips import ZipArchive

        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for r in pages.sort_values("page_id").itertuples():
                z.writestr(f"{r.page_id}.html", r.content)
        archive, held = ZipArchive(MemoryClient({"a": out.getvalue()}), "a"), {f"{r.page_id}.html": r.content for r in pages.itertuples()}
        rows = [(int(m.name[:-5]), m.method, m.size, m.compressed_size < m.size, m.crc32 == zlib.crc32(held[m.name]), archive.read(m) == held[m.name]) for m in archive.members()]
        return pd.DataFrame(rows, columns=["page_id", "method", "size", "smaller", "crc_right", "whole"])

    pages = read(spark, sf_dir, "pages").select("page_id", F.pmod(F.xxhash64("page_id"), F.lit(16)).alias("archive"), F.col("html").cast("binary").alias("content"))
    return pages.groupBy("archive").applyInPandas(walk, "page_id bigint, method bigint, size bigint, smaller boolean, crc_right boolean, whole boolean")


@query("incremental_equals_batch", "SELECT user_id, count(*) AS n, max(value) AS largest FROM events GROUP BY 1")
def incremental_equals_batch(spark, sf_dir):
    """Events taken in through a committed ledger by a stream that stops when all is read, then aggregated."""
    import uuid

    from ..streaming.incremental import Ledger, run_available

    # a streaming source lists files: tables that are one file are named by a pattern, and folders are taken as they are
    table = read(spark, sf_dir, "events")
    source = spark.readStream.schema(table.schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 64)
    stream = source.parquet(f"{sf_dir}/event[s].parquet")
    ledger = Ledger(spark, f"{publish.shared_folder(spark)}/incremental-{uuid.uuid4().hex}", {"source": f"{sf_dir}/events.parquet"})
    run_available(stream, ledger)
    return ledger.rows().groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("largest"))


from . import catalog_world  # noqa: E402, F401  (adds its queries)
