"""The operators' cores against brute force, without Spark."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import bpe, chat, decontaminate, exact_dedup, line_dedup, ngram_join, pii, quality, toxicity, url_filter, vec
from tidewell.llm.components import UnionFind

TEXT = st.text(alphabet="aAbBé🙂 \t\n.,'12", max_size=60)


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 80))
def test_shingle_sets(texts, limit):
    sets = [s for _, _, data, at in vec.slices(pa.array(texts, pa.string()), limit) for s in vec.shingle_sets(data, at)]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(np.intersect1d(sets[a], sets[b])) == len(shingles(texts[a]) & shingles(texts[b]))


def test_hashes_of_structured_texts():
    """Thue-Morse words and their complements collide under any polynomial modulo a power of two."""
    for k in (3, 6, 10, 11, 14):
        morse = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << k))
        pair = [morse, morse.translate(str.maketrans("ab", "ba"))]
        (a, b) = vec.shingle_sets(*next(iter(vec.slices(pa.array([f"one two three four {x}" for x in pair]), 1 << 30)))[2:])
        assert a.tolist() != b.tolist()
        _, _, data, at = next(iter(vec.slices(pa.array(pair), 1 << 30)))
        _, _, _, _, h1, h2 = line_dedup.line_keys(data, at, 1)
        assert h1[0] != h1[1] and h2[0] != h2[1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=150), max_size=12))
def test_range_hashes_tell_ranges_apart(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    edge = np.cumsum([0, *map(len, parts)])
    got = vec.range_hashes(data, edge[:-1], edge[1:]).tolist()
    for a, x in zip(got, parts):
        for b, y in zip(got, parts):
            assert (a == b) == (x == y)


def test_slices_of_sliced_arrays():
    array = pa.array(["aa", None, "", "bcd", "e" * 50])[1:]
    got = [bytes(data[at[k] : at[k + 1]]) for _, _, data, at in vec.slices(array, 4) for k in range(len(at) - 1)]
    assert got == [b"", b"", b"bcd", b"e" * 50]


def digests(n, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (n, 32), dtype=np.uint8)


@pytest.mark.parametrize("n", [0, 1, 2, 100, 5000])
def test_minimal_perfect_hash(n):
    keys = digests(n)
    sizes, flat, slot = exact_dedup.build_mph(keys)
    assert sorted(slot.tolist()) == list(range(n))
    assert (exact_dedup.lookup_mph(sizes, flat, keys) == slot).all()
    other = exact_dedup.lookup_mph(sizes, flat, digests(50, 1))
    assert ((other >= -1) & (other < max(n, 1))).all()  # claims of nonmembers are only claims


def test_keys_that_no_level_settles(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(exact_dedup, "MAX_LEVELS", 1)
    keys, other = digests(300), digests(20, 1)
    rows = lambda m: pd.DataFrame({"digest": [x.tobytes() for x in m], "winner": pd.array(range(len(m)), "Int64"), "n": 1})
    index = exact_dedup._index_bucket((0,), rows(keys), 1)
    assert sum(np.unpackbits(np.frombuffer(index["levels"][0], np.uint8))) < 300
    found = exact_dedup._lookup_bucket((0,), rows(np.concatenate((keys, other))), index)
    assert found["member"].tolist() == [True] * 300 + [False] * 20 and found["n"].tolist() == [2] * 300 + [1] * 20


def toy_ranks():
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate((b"ab", b"bc", b"abc", b"aa", b"aaaa", b"ca", b"abcab", b" a", b"aab")):
        ranks[t] = 256 + k
    return ranks


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30).map(lambda b: bytes(97 + x % 3 for x in b)), st.integers(0, 30), st.integers(0, 5), st.binary(max_size=4).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_prefix_encoding_append_and_edit(data, at, size, new):
    ranks = toy_ranks()
    encoder = bpe.PrefixEncoder(ranks)
    last = encoder.prefixes(data)
    for end in range(1, len(data) + 1):
        assert encoder.read(last, end) == bpe.merge_encode(data[:end], ranks)
    piece = bpe.EncodedPiece(encoder, data).append(new)
    assert encoder.read(piece.last) == bpe.merge_encode(data + new, ranks)
    piece.edit(min(at, len(piece.data)), min(at + size, len(piece.data)), new)
    assert encoder.read(piece.last) == bpe.merge_encode(piece.data, ranks)
    assert encoder.decode(piece.ids()) == piece.data


def test_bpe_as_the_public_library():
    tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    public = tiktoken.Encoding("public", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.TextEncoder(ranks, tokenizers.PATTERN)
    assert tokenizers.PATTERN == bpe.KNOWN_PATTERN
    random.seed(0)
    texts = ["", " ", "it's we'll 'tis 'S", "a" * 5000, "<|endoftext|> <|im_end|>", "\n\n  x  y　z", "ñandú été 中文 🙂🙂 １２ ½"]
    texts += ["".join(random.choice("ab é'stllrevmd12 \n\t,.🙂") for _ in range(random.randint(0, 60))) for _ in range(500)]
    for _, _, data, at in vec.slices(pa.array(texts), 300):
        for k, ids in enumerate(own.encode_rows(data, at)):
            text = bytes(data[at[k] : at[k + 1]]).decode()
            assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text), text
            assert own.encoder.decode(np.frombuffer(ids, "<u4").tolist()) == text.encode()
    other = bpe.TextEncoder(ranks, r"\S+|\s+")  # another pattern goes the plain way
    assert other.encoder.decode(np.frombuffer(other.encode("it's 1"), "<u4").tolist()) == b"it's 1"


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=15), st.text("abc", max_size=25), st.integers(0, 15))
def test_myers_distance(item, text, most):
    want, got = brute_distance(item, text), decontaminate.least_distance(item, text, most)
    assert (got and got[0]) == (want if want <= most and (want < len(item) or got) else None)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_leaks_within_the_budget_are_found(seed):
    rng = random.Random(seed)
    item = decontaminate.normalise("".join(rng.choice("abcdefgh ") for _ in range(60)))
    finder = decontaminate.LeakFinder([(7, item)], 0.1)
    leaked = list(item)
    for _ in range(rng.randint(0, 8)):
        k = rng.randrange(len(leaked))
        leaked[k : k + rng.randint(0, 1)] = [rng.choice("abcdefgh")] if rng.random() < 0.5 else []
    text = decontaminate.normalise("".join(rng.choice("xyz ") for _ in range(rng.randint(0, 80))) + "".join(leaked) + "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 80))))
    want = brute_distance(item, text)
    got = finder.search(text)
    assert [g[:2] for g in got] == ([(7, want)] if want <= finder.budget[0] else [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ,.", max_size=80), max_size=6), st.lists(st.text("abc ", min_size=14, max_size=60), min_size=1, max_size=4))
def test_rows_are_searched_as_texts(texts, items):
    """Rows of one buffer, empty ones among them, against the best distance of each item to each text."""
    items = [(k, decontaminate.normalise(x)) for k, x in enumerate(items) if len(decontaminate.normalise(x)) >= decontaminate.SHORT_CHARS]
    finder, got = decontaminate.LeakFinder(items, 0.1, 20), []
    for _, _, data, at in vec.slices(pa.array(texts, pa.string()), 60):
        got += [sorted(x[:2] for x in row) for row in finder.search_rows(data, at)]
    for text, row in zip(map(decontaminate.normalise, texts), got):
        want = []
        for n, item in items:
            if len(item) < 20:
                if f" {item} " in f" {text} ":
                    want.append((n, 0))
            elif (d := brute_distance(item, text)) <= int(0.1 * len(item)):
                want.append((n, d))
        assert row == want


def test_normal_form():
    assert decontaminate.normalise("  Été,\nA--b ÑÜ×÷\t") == "été a b ñü×÷".encode().decode("latin-1")
    assert decontaminate.normalise("") == "" and decontaminate.normalise(" ,. ") == ""


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), max_size=14), min_size=1, max_size=14), st.sampled_from([50, 80, 100]))
def test_prefix_tree_join(sets, percent):
    arrays = [np.sort(vec.mix(np.array(sorted(s), np.uint64) + np.uint64(1))) for s in sets]
    order = ngram_join.GlobalOrder(np.random.default_rng(0).integers(0, 5, 64).astype(np.uint8))
    got, want = UnionFind(), UnionFind()
    for a, b in ngram_join.join_sets(list(range(len(sets))), arrays, list(range(len(sets))), percent, order):
        assert 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        got.union(a, b)
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                linked = 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
                if linked:
                    want.union(a, b)
                distance = ngram_join.bitmap_distance(ngram_join.parity_bitmap(arrays[a]), ngram_join.parity_bitmap(arrays[b]))
                assert distance <= len(sets[a] ^ sets[b])
    assert [got.find(k) for k in range(len(sets))] == [want.find(k) for k in range(len(sets))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=2, max_size=10))
def test_similar_sets_meet(sets):
    """Nodes that are linked come out of the candidate search as pairs or tied."""
    order = ngram_join.GlobalOrder(np.zeros(64, np.uint8))
    rows = []
    for k, s in enumerate(sets):
        a = order.sort(vec.mix(np.array(sorted(s), np.uint64) + np.uint64(1)))
        p = ngram_join.prefix_length(len(a), 80)
        for i in range(p):
            rows.append((a[i], k, len(a), i))
    pairs, ties = ngram_join._meet(np.array(rows, ngram_join._POSTING), 80)
    met = {tuple(sorted(x)) for x in [*pairs.tolist(), *ties.tolist()]}
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert (b, a) in met


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB \t\n\x0bé", max_size=30), max_size=6), st.integers(1, 4))
def test_line_keys(texts, least):
    strip = lambda s: s.strip("\x20\x09\x0a\x0b\x0c\x0d")
    lower = str.maketrans("B", "b")
    got = []
    for lo, _, data, at in vec.slices(pa.array(texts, pa.string()), 20):
        row, start, end, key, h1, h2 = line_dedup.line_keys(data, at, least)
        got += [(lo + r, bytes(data[a:b]).decode(), bool(k), (x, y)) for r, a, b, k, x, y in zip(row.tolist(), start, end, key, h1.tolist(), h2.tolist())]
    want = [(k, line) for k, t in enumerate(texts) for line in t.split("\n")]
    assert [g[:2] for g in got] == want
    keys = {}
    for _, line, is_key, h in got:
        assert is_key == (len(strip(line)) >= least)
        if is_key:
            assert keys.setdefault(strip(line).translate(lower), h) == h
    assert len(set(keys.values())) == len(keys)


@settings(max_examples=150, deadline=None)
@given(st.text("<|\\im_startend>%0A\n a", max_size=40))
def test_chat_escapes(text):
    body = chat.escape(text)
    assert chat.unescape(body) == text and chat.END not in body and chat.START not in body
    role = chat.escape_role(text)
    assert chat.unescape_role(role) == text and "\n" not in role and chat.END not in role


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.booleans()), max_size=20), st.integers(20, 100), st.integers(0, 40))
def test_chat_windows(turns, budget, history):
    rows = [(k, 5, n, k == 0 and s) for k, (n, s) in enumerate(turns)]
    out = list(chat.choose_windows(iter(rows), budget, history))
    assert [t for t, _, _, _, again in out if not again] == list(range(len(turns)))  # each turn is new once, in order
    for w in {x[2] for x in out}:
        inside = [x for x in out if x[2] == w]
        places = [x[3] for x in inside]
        assert places == sorted(places) and [x[4] for x in inside] == sorted((x[4] for x in inside), reverse=True)
        tokens = sum(turns[x[0]][0] for x in inside)
        system = turns[0][0] if turns and turns[0][1] else 0
        if len([x for x in inside if not x[4]]) > 1:
            assert tokens <= budget
        assert sum(turns[x[0]][0] for x in inside if x[4] and x[0]) <= history or not system and sum(turns[x[0]][0] for x in inside if x[4]) <= history
        if w and system:
            assert inside[0][0] == 0 and inside[0][4]


def test_rules_are_filed_under_their_rarest_token():
    rules = [url_filter.SiteRule("org", "/", "allow"), url_filter.SiteRule("example.org", "/es/", "block"), url_filter.SiteRule("example.org", "/en/1", "block")]
    assert rules[2].literals == ["example", "org", "en"]  # "1" may go on, so it is no token
    index = url_filter.RuleIndex(rules, [], {"org": 9, "example": 5, "es": 1, "en": 3})
    assert set(index.filed) == {"org", "es", "en"}
    assert index.judge("a.example.org", "/en/123") == ("example.org/en/1", "block")
    assert index.judge("example.org", "/es/x") == ("example.org/es/", "block")
    assert index.judge("notexample.org", "/es/x") == ("org/", "allow")
    assert index.judge("example.org", "") == (None, None) and index.judge("", "") == (None, None)
    index.tried = 0
    index.judge("x.com", "/fr/1")
    assert index.tried == 0  # no token fetches a rule, so no expression runs


RULES = [url_filter.SiteRule("org", "/", "allow"), url_filter.SiteRule("example.org", "/es/", "block"), url_filter.SiteRule("example.org", "/en/1", "block"), url_filter.SiteRule("com", "/fr/", "allow"), url_filter.SiteRule("com", "/de/", "block")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["example", "org", "com", ".", "x", "\n", "a", ":80", "-"]), max_size=6), st.lists(st.sampled_from(["/", "es", "en", "1", "fr", "de", "\n", "org", ".", "com", "x"]), max_size=7))
def test_rules_against_a_plain_loop(host, path):
    host, path = "".join(host), "/" + "".join(path) if path else ""
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    assert url_filter.RuleIndex(RULES, [], {}).judge(host, path) == ((best.name, best.verdict) if best else (None, None))


def test_latent_votes():
    rng = np.random.default_rng(0)
    counts = np.zeros((60, quality.BINS), np.float32)
    labels = np.arange(60) % 2
    for k in range(60):
        counts[k, rng.integers(0, 50, 30) + 100 * labels[k]] += 1
    model = quality.LatentModel.fit(counts, labels, rank=8)
    score = model.score(counts)
    assert ((score > 0.5) == (labels == 1)).all() and (score >= 0).all() and (score <= 1).all()
    assert model.score(np.zeros((1, quality.BINS), np.float32))[0] == pytest.approx(labels.mean())
    # blocked cosines are the plain ones
    v = model.unit(model.weigh(counts, model.idf) @ model.project)
    assert np.allclose(v @ model.vectors.T, [[a @ b for b in model.vectors] for a in v], atol=1e-5)


def test_machine_learns_a_pair():
    """Label 1 exactly if both terms are there, with each alone as common: no additive weights can tell."""
    rng = np.random.default_rng(0)
    a, b = rng.random(600) < 0.5, rng.random(600) < 0.5
    y = (a == b).astype(np.float32)
    rows = np.concatenate([np.flatnonzero(a), np.flatnonzero(b), np.flatnonzero(~a), np.flatnonzero(~b)])
    bins = np.concatenate([np.full(a.sum(), 3), np.full(b.sum(), 5), np.full((~a).sum(), 7), np.full((~b).sum(), 9)])
    model = toxicity.FactorizationMachine.fit(rows, bins, y, rounds=400)
    score = model.score(600, rows, bins)
    assert ((score > 0.5) == (y > 0)).mean() > 0.95
    # the pair term equals the sum over pairs
    held = [np.searchsorted(model.slot, bins[rows == k]) for k in range(5)]
    for k, at in enumerate(held):
        pairs = sum(model.factor[i] @ model.factor[j] for n, i in enumerate(at) for j in at[n + 1 :])
        assert np.log(score[k] / (1 - score[k])) == pytest.approx(model.bias + model.weight[at].sum() + pairs, abs=1e-3)


@pytest.mark.parametrize("others", [0, 200, 900])
def test_machine_finds_a_pair_among_other_terms(others):
    """Neither of the two tells anything alone, while many other terms are weakly tied to the label."""
    rng = np.random.default_rng(1)
    n = 4000
    a, b = rng.random(n) < 0.5, rng.random(n) < 0.5
    y = (a == b).astype(np.float32)
    noise = rng.random((n, others)) < 0.3 + 0.07 * y[:, None]
    held = np.concatenate((a[:, None], b[:, None], noise), axis=1)
    rows, bins = np.nonzero(held)
    train = rows < 3000
    model = toxicity.FactorizationMachine.fit(rows[train], bins[train] * 7 + 3, y[:3000])
    assert {3, 10} <= set(model.slot.tolist())
    score = model.score(1000, rows[~train] - 3000, bins[~train] * 7 + 3)
    assert ((score > 0.5) == (y[3000:] > 0)).mean() > 0.85
    # terms that are only noise go in by no pair
    x = noise[:, :100].astype(np.float32)[:, : max(1, others)]
    if others:
        flat = rng.random(n) < 0.5
        single = toxicity.likelihood_ratio(x[flat].sum(axis=0), x.sum(axis=0), int(flat.sum()), n)
        assert not len(toxicity.paired_terms(x, flat, single))


def test_term_bins():
    texts = ["Trash### trash", "", "été"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *(len(t.encode()) for t in texts)])
    row, bins = toxicity.term_bins(data, at)
    assert np.bincount(row, minlength=3).tolist() == [2, 0, 2]  # each word and the one head it has


def test_trees():
    counts = [(1, 90, 90), (0, 200, 2), (3, 10, 10), (2, 50, 0)]  # bit 0 makes the label
    model = pii.BoostedTrees.fit(counts)
    assert model.margin(1) > model.thresholds[0] - 1e-6 and model.margin(3) > model.thresholds[0] - 1e-6
    assert model.margin(0) < model.thresholds[0] and model.margin(2) < model.thresholds[0]
    assert pii.BoostedTrees.fit([]).thresholds == {}


def test_crc_fold():
    assert zlib.crc32(b"12") % 5 == zlib.crc32(str(12).encode()) % 5
