"""The operators on Spark: odd rows, brute force, and the driver's queries on the smallest tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_pure import shingles
from tidewell.llm import bpe, chat, components, decontaminate, exact_dedup, line_dedup, ngram_join, pii, quality, toxicity, url_filter
from tidewell.llm.common import Workspace

LINE = "A repeated line that is long enough to be taken for one."
ODD = [(1, None), (2, ""), (3, "same text"), (4, "same text"), (4, "same text"), (None, "same text"), (5, " \n\t "), (6, "x" * 200_000), (7, "é🙂 one two three four five six"), (None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and columns whose names the operators use themselves."""
    rows = [(i, t, "id", "source", k, "h1") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, source string, n long, h1 string").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_dedup(spark, odd, none):
    got = exact_dedup.exact_dedup(odd, bucket_keys=2).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(sha(t), []).append(i)
    for r in got:
        ids = groups[bytes(r["digest"]).hex()]
        assert r["n"] == len(ids) and r["winner"] == max((i for i in ids if i is not None), default=None)
    assert exact_dedup.exact_dedup(none).collect() == []


def test_history_grows_by_batches(spark):
    work = Workspace(spark, "test")
    rows = lambda ids: spark.createDataFrame([(i, f"t{i % 7}") for i in ids], "doc_id long, text string")
    group = lambda ids: exact_dedup.DigestHistory.group(exact_dedup.digest_rows(rows(ids)))
    history = exact_dedup.DigestHistory(spark, work, bucket_keys=2).build(group(range(5)))
    found = {bytes(r["digest"]).hex(): r for r in history.lookup(group(range(5, 20))).collect()}
    for k in range(7):
        r = found[sha(f"t{k}")]
        assert r["member"] == (k < 5) and r["winner"] == max(i for i in range(20) if i % 7 == k) and r["n"] == len([i for i in range(20) if i % 7 == k])
    assert sorted(bytes(r["digest"]).hex() for r in history.entries().collect()) == sorted(sha(f"t{k}") for k in range(5))
    history.save(work.path("saved"))
    later = exact_dedup.DigestHistory.open(spark, work.path("saved"))
    got = {r["id"]: r for r in exact_dedup.exact_dedup(rows(range(5, 20)), history=later).collect()}
    assert set(got) == set(range(5, 20))
    for i, r in got.items():
        same = [j for j in range(20) if j % 7 == i % 7]
        assert (r["winner"], r["n"]) == (max(same), len(same))


def test_bpe_round_trip(spark, odd, none):
    ranks = {bytes([b]): b for b in range(256)} | {b"sa": 256, b"me": 257, b"same": 258}
    out = bpe.bpe_decode(bpe.bpe_encode(odd, ranks, bpe.KNOWN_PATTERN), ranks).collect()
    assert sorted(bytes(r["decoded"]) for r in out) == sorted((t or "").encode() for _, t in ODD)
    assert all(r["n_tokens"] * 4 == len(r["token_ids"]) for r in out)
    assert bpe.bpe_decode(bpe.bpe_encode(none, ranks, bpe.KNOWN_PATTERN), ranks).collect() == []


def test_bpe_decodes_in_the_encoding_worker(spark, data, odd, none):
    import public_tokenizers

    from tidewell.llm.queries import queries

    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    for pattern in (bpe.KNOWN_PATTERN, r"\w+|\W+"):
        apart = bpe.bpe_decode(bpe.bpe_encode(odd, ranks, pattern), ranks).collect()
        once = bpe.bpe_encode(odd, ranks, pattern, decoded=True)
        assert sorted(once.collect(), key=repr) == sorted(apart, key=repr) and once.columns == ["id", "n_tokens", "token_ids", "decoded"]
    assert bpe.bpe_encode(none, ranks, bpe.KNOWN_PATTERN, decoded=True).collect() == []
    # a second step in Python doubles the workers of a task, each with an encoder's caches in the end
    plan = queries()["op2_bpe"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_url_filter(spark, monkeypatch):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/a?x#y", "https://a.b.example.org/en/12", "x://org", "x://org/", "http://shop.com/cart", "http://user@h.com:80/de/", "http://u.com/fr/\nz", "http://zzz.net/x.org\n/y", "http://zzz.net/a.com\n/de/x", "http://a\nb.com/de/x"]
    df = spark.createDataFrame([(k, u, "rule", None) for k, u in enumerate(urls)], "page_id long, url string, rule string, html string")
    rules = [url_filter.SiteRule("org", "/", "allow"), url_filter.SiteRule("example.org", "/es/", "block"), url_filter.SiteRule("example.org", "/en/1", "block"), url_filter.SiteRule("com", "/fr/", "allow"), url_filter.SiteRule("com", "/de/", "block")]
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "block")
    assert got[3] == ("example.org", "/es/a", "example.org/es/", "block")
    assert got[4] == ("a.b.example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("org", "", None, "allow") and got[6] == ("org", "/", "org/", "allow")
    assert got[7] == ("shop.com", "/cart", None, "block")
    assert got[8] == ("user@h.com:80", "/de/", None, "allow")
    assert got[9][1:] == ("/fr/\nz", "com/fr/", "allow")
    assert got[10] == ("zzz.net", "/x.org\n/y", None, "allow") and got[11] == ("zzz.net", "/a.com\n/de/x", None, "allow")
    assert got[12] == ("a\nb.com", "/de/x", "com/de/", "block")
    monkeypatch.setattr(url_filter, "BLOCK_RULES", 2)  # rules in several passes say the same
    assert {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules).collect()} == got
    assert url_filter.filter_urls(df.limit(0), rules).collect() == []


def test_classifiers(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (7, 0, 1), (6, 1, 0), (99, 1, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        got = score(odd, fit(odd, labels, F.lit(True))).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
        assert score(none, fit(none, labels, F.lit(True))).collect() == []
        assert len(score(odd, fit(odd, labels, F.lit(False))).collect()) == len(ODD)
    model = quality.fit_quality(odd, labels, F.lit(True))
    assert quality.keep_good(odd, model, 0.5).count() == quality.score_quality(odd, model).where("score >= 0.5").count() and quality.keep_good(none, model, 0.5).collect() == []
    assert quality.fit_quality(odd, labels, F.lit(True), sample_rows=1).vectors.shape[0] == 1


def test_pii(spark, odd, none):
    texts = [*[(i, t) for i, t in ODD], (20, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 300.1.1.1 é +49 (30) 123456 é 4845168114407329 x 4845168114407328"), (21, "x" * 5000 + "@" + "1" * 5000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = {20: "email:0:5,email:5:11,ip:12:19,ip:20:27,card:58:74,phone:40:55", 21: ""}
    assert want[20].count(",") == 5
    rows = {r["id"]: r for r in pii.find_pii(df).select("id", pii.joined_spans("base").alias("b"), pii.joined_spans("spans").alias("s")).collect()}
    assert rows[20]["b"] == want[20] and rows[21]["b"] == ""
    assert set(rows[20]["b"].split(",")) <= set(rows[20]["s"].split(","))
    assert rows[1]["b"] == rows[2]["b"] == ""
    assert pii.find_pii(none).collect() == []
    cleaned = {r["id"]: r["text"] for r in pii.redact(df, pii.find_pii(df)).collect()}
    assert cleaned[20] == "[EMAIL][EMAIL] [IP].[IP] 300.1.1.1 é [PHONE] é [CARD] x 4845168114407328"


def test_pii_adds_what_the_base_cannot_hold(spark):
    plain = [f"write to user{k}@site{k}.org or +1 (692) 555-{7000 + k} or 4845168114407329 or 10.1.{k}.7 today" for k in range(20)]
    added = ["bob (at) mail (dot) com", "bob[at]mail[dot]com", "bob(at)mail.com", "(692) 555-7565", "692-555-7565", "030 1234567", "4845.1681.1440.7329", "10[.]1[.]2[.]3"]
    left = ["2024-01-15 10", "1998-2004", "12.3456789", "1500 3000", "4845.1681.1440.7328", "me (at) home", "(2005) 1234-1238", "123456789", "1, 2, 3, 4", "1.234.567,89"]
    docs = [*plain, *(f"é so {x}. Then" for x in (*added, *left))]
    rows = {r["id"]: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    for k, x in enumerate(added, len(plain)):
        assert not rows[k]["base"] and [docs[k][s:e] for _, s, e in rows[k]["spans"]] == [x], x
    for k, x in enumerate(left, len(plain) + len(added)):
        assert not rows[k]["spans"], x
    assert all(rows[k]["spans"] == rows[k]["base"] and len(rows[k]["base"]) == 4 for k in range(len(plain)))


BASE_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits := re.sub("[^0-9]", "", m)) <= 19 and sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def plain_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, (pattern, good) in BASE_KINDS.items() for m in re.finditer(pattern, text or "") if good(m[0])]


def test_pii_base_against_plain_patterns(spark):
    """Every document of a table, by the contract's patterns as they stand."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["id"]: r["b"].split(",") if r["b"] else [] for r in pii.find_pii(docs).select("id", pii.joined_spans("base").alias("b")).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got == {i: plain_spans(t) for i, t in texts.items()} and any(got.values())


def test_pii_in_a_text_of_very_many_spans(spark):
    import time

    one = "7.8.9.1 é me@some.org, +49 30 1234567, 4845168114407329; "
    start = time.perf_counter()
    row = pii.find_pii(spark.createDataFrame([(1, one * 10_000), (2, one)], "doc_id long, text string")).where("id = 1").select(pii.joined_spans("base").alias("b")).first()
    assert time.perf_counter() - start < 90
    found = row["b"].split(",")
    assert len(found) == 40_000 and found == plain_spans(one * 10_000)


def test_decontaminate(spark, odd, none):
    item = "The quick brown fox jumps over the lazy dog while nobody looks."
    bench = spark.createDataFrame([(1, item, 0), (2, item.upper(), 0), (3, None, 0), (4, "short", 0), (5, "Who wrote Hamlet?", 0)], "item_id long, text string, doc_id long")
    more = [(50, "Before. " + item.replace("brown", "brawn") + " After."), (51, item[:30]), (52, "Now: who WROTE hamlet, and why"), (53, "who wrote hamlets"), (54, "short")]
    docs = odd.select("doc_id", "text", "id", "n", F.lit(1).alias("item_id")).unionByName(spark.createDataFrame([(i, t, "id", 1, 1) for i, t in more], "doc_id long, text string, id string, n long, item_id int"))
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.find_leaks(docs, bench).collect()) == [(50, 1, 1), (50, 2, 1), (52, 5, 0)]
    assert sorted(r["item_id"] for r in decontaminate.find_leaks(docs, bench, block_bytes=10).collect()) == [1, 2, 5]
    left = decontaminate.drop_leaks(docs, bench, block_bytes=10)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == sorted(i or 0 for i, _ in [*ODD, (51, ""), (53, ""), (54, "")])
    assert sorted((r["item_id"], r["chars"]) for r in decontaminate.unsearched_items(bench).collect()) == [(3, 0), (4, 5)]
    assert decontaminate.drop_leaks(none, bench).collect() == [] and decontaminate.find_leaks(none, bench).collect() == [] and decontaminate.find_leaks(docs, bench.limit(0)).collect() == []


def test_decontaminate_a_table_against_brute_force(spark, data):
    """The query's rows: every item that Myers' algorithm, run over the whole of each text, finds."""
    from tidewell.llm.queries import queries

    items = [(r["item_id"], decontaminate.normalise(r["text"])) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], decontaminate.normalise(r["text"] or "")) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in queries()["op7_decontaminate"](spark, data).collect()}
    leaked = {d for d, _ in got}
    rng = random.Random(0)
    docs = [x for x in docs if x[0] in leaked][:15] + rng.sample(docs, 8)
    for d, text in docs:
        text = text[:4000]
        for n, item in rng.sample(items, min(20, len(items))) + [x for x in items if (d, x[0]) in got]:
            hit = decontaminate.least_distance(item, text, int(decontaminate.EDIT_RATE * len(item)))
            assert hit is None or got[d, n] <= hit[0]
            assert (d, n) not in got or len(text) == 4000 or hit[0] == got[d, n]


def test_components(spark):
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(1000, k) for k in range(1001, 1100)] + [(k, k + 1) for k in range(2000, 2060)] + [(5, 5), (None, 1)]
    sets = components.UnionFind()
    for a, b in links:
        if a is not None and a != b:
            sets.union(a, b)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long").repartition(5), Workspace(spark, "test"), "c").collect()}
    assert got == {x: sets.find(x) for x in sets.up}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test"), "c").collect() == []


@pytest.mark.parametrize("at_once", [400, 399])
def test_components_of_few_links_take_no_rounds(spark, monkeypatch, at_once):
    """200 links (after each task has shrunk its own) have 400 nodes at most: one step joins them if a task may hold so many, else rounds do, alike."""
    monkeypatch.setattr(components, "LINKS_AT_ONCE", at_once)
    links = [(k + 1, k) for k in range(150)] + [(1000 + k, 2000 + k % 7) for k in range(50)]
    sets, written, keep = components.UnionFind(), [], Workspace.keep
    for a, b in links:
        sets.union(a, b)
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: (written.append(name), keep(self, df, name))[1])
    df = spark.createDataFrame(spark.sparkContext.parallelize(links, 200), "a long, b long")
    got = [tuple(r) for r in components.connected_components(df, Workspace(spark, "test"), "c").collect()]
    assert sorted(got) == sorted((x, sets.find(x)) for x in sets.up)
    assert (written == ["c-0", "c-whole"]) if at_once == 400 else len(written) > 3


def near_copies(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = []
    for g in range(3):
        base = [word() for _ in range(60)]
        for _ in range((40, 7, 2)[g]):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(60)] = word()
            rows.append(" ".join(copy))
    passage = " ".join(word() for _ in range(30))
    rows += [passage + " " + " ".join(word() for _ in range(rng.choice((4, 6, 9, 40)))) for _ in range(25)]
    rows += [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(20)] + [rows[0], rows[0].upper(), rows[5] + " "]
    return list(enumerate(rows)) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  B"), (905, "b a")]


@pytest.mark.parametrize("block, sets", [(ngram_join.BLOCK_SHINGLES, ngram_join.BLOCK_SETS), (300, ngram_join.BLOCK_SETS), (ngram_join.BLOCK_SHINGLES, 6)])
def test_ngram_join(spark, monkeypatch, block, sets):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    docs = near_copies()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, sid string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in ngram_join.ngram_join(df, counters=1 << 12, block_shingles=block).collect()}
    sets, links = {i: shingles(t) for i, t in docs}, components.UnionFind()
    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links.union(a, b)
    assert got == {i: (len(s), links.find(i)) for i, s in sets.items()}


def brute_components(docs):
    sets, links = {i: shingles(t) for i, t in docs}, components.UnionFind()
    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links.union(a, b)
    return {i: links.find(i) for i in sets}


def test_ngram_join_where_the_order_says_nothing(spark):
    """Unlike documents with shared passages, 1,000 shingles a counter: all are tied into one cluster, and still few pairs are looked at."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passages = [words(30) for _ in range(12)]
    docs = [" ".join([words(60), rng.choice(passages), words(10), rng.choice(passages)]) for _ in range(450)]
    docs += [f"{docs[k]} more words" for k in range(0, 450, 30)] + [docs[7].replace(" ", "  ")]
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["id"]: r["component"] for r in ngram_join.ngram_join(df, counters=64, block_shingles=4_000).collect()}
    want = brute_components(docs)
    assert got == want and len(set(want.values())) == 450
    sizes = spark.createDataFrame([(i, len(shingles(t)), i % 18, i, 0, 0) for i, t in docs], "node long, n long, block long, known long, main long, cluster long")
    visits = {tuple(r) for r in ngram_join.routed_visits(sizes, df.select(F.col("doc_id").alias("node"), "text"), 5, 80).select("node", "block").collect()}
    apart = [(a, b) for b, a in want.items() if a != b and a % 18 != b % 18]
    assert apart and all((b, a % 18) in visits and (a == 0 or (a, b % 18) in visits) for a, b in apart) and len(visits) < len(docs) / 4


@pytest.mark.parametrize("sets", [256, 1])
def test_ngram_join_odd_rows(spark, odd, none, monkeypatch, sets):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    got = ngram_join.ngram_join(odd, counters=1 << 12).collect()
    assert len(got) == len(ODD) and all((r["component"] is None) == (r["id"] is None) for r in got)
    assert {r["component"] for r in got if r["id"] == 4} == {3}
    assert ngram_join.ngram_join(none, counters=1 << 12).collect() == []


def brute_lines(docs):
    key = lambda line: line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = {}
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, []).append(i)
    hot = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if hot.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("broadcast, batches", [(1_000_000, 6), (0, 2)])
def test_line_dedup(spark, broadcast, batches):
    random.seed(2)
    lines = [LINE, LINE.upper() + "  ", "\t" + LINE, "another long line, which comes up in some documents", "short", "", "é" * 40, "é" * 39]
    docs = [(k, "\n".join(random.choice(lines) for _ in range(random.randint(0, 6)))) for k in range(40)] + [(50, None), (51, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.line_dedup(df, batches=batches, broadcast_keys=broadcast).collect()}
    assert got == brute_lines(docs)


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_line_dedup_of_null_and_repeated_ids(spark, broadcast):
    other = "Some other line that is long enough to be taken for one."
    docs = [(k, f"{LINE}\n{k}") for k in range(5)] + [(k, f"{k}\n{other}") for k in range(5)] + [(None, f"x\n{LINE}"), (None, LINE), (7, LINE), (7, f"{LINE}\nb\n{LINE}"), (6, LINE), (6, "a\nb\nc\n" + LINE), (6, other)]
    docs += [(None, f"{k} a line that only rows without an id hold, five of them\na line that only rows without an id hold, five of them") for k in range(5)]
    docs += [(i, t) for i, t in ODD]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, n long").repartition(3)
    got = {r["rest"]["n"]: (r["id"], r["n_dropped"], r["text"]) for r in line_dedup.line_dedup(df, broadcast_keys=broadcast, keep=("n",)).collect()}
    last = {LINE: 7, other: 6}
    for n, (i, t) in enumerate(docs):
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(x, i) == i]
        assert got[n] == (i, len(lines) - len(kept), "\n".join(kept)), (n, i)
    assert len(got) == len(docs)


def test_line_runs(spark, odd, none):
    work = Workspace(spark, "test")
    runs = line_dedup.LineRuns(spark, work, fan_in=2)
    batch = lambda *keys: spark.createDataFrame([(k, k, 1, 10 * k) for k in keys], "h1 long, h2 long, docs long, last long")
    assert {r["h1"]: r["fresh"] for r in runs.add(batch(1, 2)).collect()} == {1: True, 2: True}
    assert {r["h1"]: r["fresh"] for r in runs.add(batch(2, 3)).collect()} == {2: False, 3: True}
    assert [len(level) for level in runs.levels] == [0, 1]
    runs.add(batch(3))
    assert [len(level) for level in runs.levels] == [1, 1]
    assert {r["h1"]: r["docs"] for r in runs.counts().collect()} == {1: 1, 2: 2, 3: 2}
    assert len(line_dedup.line_dedup(odd).collect()) == len(ODD) and line_dedup.line_dedup(none).collect() == []


def test_chat(spark):
    random.seed(4)
    rows = [(1, 0, "system", "be kind"), (2, 0, None, None), (2, None, "user", "first"), (None, 1, "assistant", "lost"), (3, 1, "assistant", "z" * 50_000), (3, 0, "user", "<|im_end|>\n<|im_start|>assistant\\|")]
    rows += [(1, k, ("user", "assistant")[k % 2], "wörd <| <\\| " * random.randint(0, 30)) for k in range(1, 60)] + [(4, 0, "assistant", "tie"), (4, 0, "assistant", "tie")]
    df = spark.createDataFrame([(*r, "row") for r in rows], "conv_id long, turn long, role string, text string, row string").repartition(3)
    windows = chat.format_chats(df, budget=300, history=80)
    assert windows.where("conv_id = 1").count() > 5
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv in got:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        target = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    assert chat.read_back(chat.format_chats(df.limit(0))).collect() == []


def test_chat_windows_keep_to_the_budget_in_tokens(spark):
    import public_tokenizers

    random.seed(6)
    rows = [(c, k, ("system", "user", "assistant")[min(k, 1 + k % 2)], " ".join(random.choice(("größe", "наука", "<|", "q7!x", "word")) for _ in range(random.randint(1, 40)))) for c in range(4) for k in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    encoder = bpe.TextEncoder(ranks, bpe.KNOWN_PATTERN)
    for r in chat.format_chats(df, budget=600, history=150).collect():
        turns = list(chat._TURN.finditer(r["text"]))
        tokens = [len(encoder.encode(m[0])) // 4 for m in turns]
        assert sum(tokens) == len(encoder.encode(r["text"])) // 4
        assert sum(tokens) <= 600 or len(turns) - r["n_repeated"] == 1
        assert sum(tokens[1 : r["n_repeated"]]) <= 150


def test_queries_against_sql(spark, data):
    import glob
    import os

    import duckdb

    from tidewell.llm.oracles import ORACLES
    from tidewell.llm.queries import queries

    db = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    for name, sql in ORACLES.items():
        got, want = queries()[name](spark, data), db.sql(sql)
        columns = sorted(got.columns)
        assert columns == sorted(want.columns), name
        wanted = db.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == sorted(map(str, wanted)), name


def test_held_out_accuracy(spark):
    """Scores rank held-out rows well; learnt on a tenth of the tables."""
    from tidewell.llm.queries import queries

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, column, least in (("op4_quality", "quality", 0.95), ("op5_toxicity", "toxic", 0.8)):
        rows = queries()[name](spark, folder).where("held_out").join(labels, "doc_id").select("score", column).collect()
        good, bad = [r[0] for r in rows if r[1] == 1], [r[0] for r in rows if r[1] == 0]
        wins = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
        assert wins > least, name


def test_pipeline(spark, data):
    """Each stage against its definition, by brute force on what the stage before it kept."""
    from corpus_pipeline import COLUMNS, STAGES

    docs, work = spark.read.parquet(f"{data}/documents.parquet"), Workspace(spark, "test")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, data), name)
        if name == "tokens":
            import public_tokenizers
            import tiktoken

            public = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
            got = {r["doc_id"]: np.frombuffer(r["token_ids"], "<u4").tolist() for r in docs.collect()}
            assert got == {i: public.encode_ordinary(t or "") for i, t in before.items()}
            continue
        assert tuple(docs.columns) == COLUMNS
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality":
            labels, source = spark.read.parquet(f"{data}/labels.parquet"), spark.read.parquet(f"{data}/documents.parquet")
            scores = quality.score_quality(source, quality.fit_quality(source, labels, F.lit(True))).collect()
            assert set(now) == {r["id"] for r in scores if r["score"] >= 0.3} and all(before[i] == t for i, t in now.items())
        elif name == "lines":
            assert now == {i: t for i, (_, _, t) in brute_lines(list(before.items())).items()}
        elif name == "near_duplicates":
            sets, links = {i: shingles(t) for i, t in before.items()}, components.UnionFind()
            for a in sets:
                for b in sets:
                    if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        links.union(a, b)
            assert set(now) == {i for i in sets if links.find(i) == i}
        elif name == "decontaminate":
            texts = {i: decontaminate.normalise(t or "") for i, t in before.items()}
            leaked = {i for i, t in texts.items() if any(x in t for x in items)}
            assert set(now) <= set(before) - leaked
            short = {i for i, t in texts.items() if len(t) < 1500}  # these against the whole definition
            near = {i for i in short if any(decontaminate.least_distance(x, texts[i], int(decontaminate.EDIT_RATE * len(x))) for x in items if len(x) * 0.9 < len(texts[i]))}
            assert set(now) & short == short - near
        before = now
    assert before and re.match("[a-z]", STAGES[0][0])


def test_pipeline_stages_on_odd_tables(spark, data):
    """Nulls, empty and long texts, repeated rows and ids, columns of clashing names, and no rows at all."""
    from corpus_pipeline import COLUMNS, STAGES

    long = "A line that is long enough to be counted, and in five documents at that."
    rows = [*ODD, *((20 + k, f"{long}\nand the rest of number {k}") for k in range(6)), (20, long)]
    made = spark.createDataFrame([(i, t, None, None, None, n, "id", 1, "x") for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, row long, id string, rest long, component string").repartition(3)
    for name, stage in STAGES:
        out = stage(spark, made, data)
        got, none = out.collect(), stage(spark, made.limit(0), data).collect()
        assert none == [], name
        if name == "tokens":
            assert len(got) == len(rows)
            continue
        assert tuple(out.columns) == COLUMNS, name
        key = lambda i, t: (i is None, i or 0, t or "")
        kept = sorted(key(r["doc_id"], r["text"]) for r in got)
        if name == "lines":
            last = {long: 25}
            want = [(i, "\n".join(x for x in (t or "").split("\n") if last.get(x, i) == i)) for i, t in rows]
            assert kept == sorted(key(i, t) for i, t in want)
        elif name == "near_duplicates":  # rows of one id are one node, and rows without an id are none
            links, sets = components.UnionFind(), [(i, shingles(t)) for i, t in rows if i is not None]
            for i, a in sets:
                for j, b in sets:
                    if a and b and 100 * len(a & b) >= 80 * len(a | b) and i != j:
                        links.union(i, j)
            assert links.find(4) == 3 and links.find(25) == 20
            assert kept == sorted(key(i, t) for i, t in rows if i is None or links.find(i) == i)
        elif name == "decontaminate":
            assert kept == sorted(key(i, t) for i, t in rows)
        else:
            assert set(kept) <= {key(i, t) for i, t in rows}


def test_chat_query_reads_its_control_texts_back(spark, data):
    """Every conversation of the table, and the one that holds the template's own marks."""
    from tidewell.llm.queries import CONTROL_TEXT, queries

    rows = [(r["conv_id"], r["turn"], r["role"] or "", r["text"] or "") for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    got = {r["conv_id"]: r for r in queries()["op9_chat_format"](spark, data).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted(x[1:] for x in rows if x[0] == conv)
        target = "".join(x for _, role, x in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(target), hashlib.sha256(target.encode()).hexdigest()) and r["formatted_chars"] > sum(len(x) for _, _, x in turns)


def test_bpe_query_as_the_public_library(spark, data):
    import public_tokenizers
    import tiktoken

    from tidewell.llm.queries import queries

    public = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries()["op2_bpe"](spark, data).collect()}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = public.encode_ordinary(r["text"] or "")
        assert got.pop(r["doc_id"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(r["text"]))
    assert not got


def test_ngram_query_against_brute_force(spark, data):
    from tidewell.llm.queries import queries

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = brute_components(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries()["op8_ngram_join"](spark, data).collect()}
    assert got == {i: (len(shingles(t)), want[i]) for i, t in docs} and len(set(want.values())) < len(docs)


def test_toxicity_leaves_clean_documents_alone(spark):
    from tidewell.llm.queries import queries

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries()["op5_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert clean and sum(clean) <= 0.03 * len(clean)  # learnt on some 300 labels


def test_workspaces_are_swept(spark):
    import os

    from tidewell.llm.common import swept

    outside = Workspace(spark, "test")
    kept = outside.keep(spark.range(3), "a")
    with swept(spark):
        inside = Workspace(spark, "test")
        inside.keep(spark.range(3), "a")
        inside.keep(spark.range(3), "b")
        inside.drop("a")
        assert not os.path.exists(inside.path("a")) and os.path.exists(inside.path("b"))
    assert not os.path.exists(inside.root) and kept.count() == 3
