"""Exact Jaccard self-join on word n-grams with prefix trees.

A document's set is its distinct n-word shingles, hashed to 64 bits.  One
global order holds for all sets: rarer shingles first, by a table of counts
that is summed over the whole corpus and grows with it (COUNTERS).

1. Documents with equal sets are one node (joined by a 128-bit set hash), so
   groups of copies never reach the join.
2. Two similar sets share a shingle among the first ``n - ceil(t * n) + 1`` in
   the global order.  Those prefixes are dealt out by shingle.  Nodes that meet
   are possible partners if their sizes and the shingle's positions allow it
   and if parity bitmaps of the sets leave room for the threshold (all three
   are bounds, so no link is lost).  Where many nodes meet in one shingle they
   are tied to the least of them instead of to each other: that only puts
   them into one cluster.
3. Connected possible partners form a cluster; each cluster is joined exactly.
   Its sets go into a prefix tree in the global order, most frequent shingles
   first, so that near copies share long paths.  Every set traverses the tree
   with the overlap of the shared path so far; a subtree is left when the
   remaining lengths cannot reach the threshold, or when all its sets are
   already linked with the one at hand.
4. A cluster that is larger than a block is dealt out over blocks.  Blocks are
   joined first, then one set for each component found so far.  What then is
   apart from the cluster's largest component visits blocks, but only those
   that it is routed to by prefixes, now in the order of exact counts within
   the cluster: it meets a block where they share a shingle that is rare in the
   cluster, whatever else tied them, and where sizes and positions leave room.
   Two sets that are similar and not yet linked so meet in a block: the result
   is exact, and a task holds a block and as many visitors.

Defined cases: words are runs of bytes other than ASCII white space, with A-Z
lower-cased; with fewer words than n the whole sequence is the one shingle;
null, empty and blank texts have empty sets and are linked with nothing; rows
with a null id are returned with a null component; equal ids are one node; an
empty table gives no rows; texts are read whole; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, no_null, shuffle_partitions
from .components import UnionFind, connected_components
from .vec import U64, mix, shingle_sets, slices

N = 5
PERCENT = 80
#: Least and most counters of the global order, one byte each when broadcast; between them there is one for each SHARE shingles.
COUNTERS, MOST_COUNTERS, SHARE = 1 << 22, 1 << 26, 24
RANGES = 64
#: Postings that a task holds at a time, about.
BUCKET_POSTINGS = 2_000_000
#: Nodes that meet in one shingle and are still compared pair by pair.
PAIRWISE = 32
#: Shingles and sets in a block of a cluster, about.
BLOCK_SHINGLES, BLOCK_SETS = 200_000, 256
#: Bits of the filter that picks the texts of clusters from the table.
FILTER_BITS = 1 << 26
BITMAP_BITS = 1 << 15


def least_overlap(total: int | np.ndarray, percent: int):
    """Common shingles that two sets with ``total`` shingles together need: 100 o >= percent (total - o)."""
    return -(-percent * total // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class GlobalOrder:
    """Rarer shingles first, equal counts by hash."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def of(self, shingles: np.ndarray) -> np.ndarray:
        return self.counts[(shingles % U64(len(self.counts))).astype(np.int64)].astype(np.int64)

    def sort(self, shingles: np.ndarray) -> np.ndarray:
        return shingles[np.lexsort((shingles, self.of(shingles)))]


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the members in each of about 1.5 places a member (a power of two, at most BITMAP_BITS)."""
    bits = 64
    while bits < 1.5 * len(shingles) and bits < BITMAP_BITS:
        bits *= 2
    return np.packbits(np.bincount((mix(shingles) % U64(bits)).astype(np.int64), minlength=bits) & 1).tobytes() if len(shingles) else b""


_ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)


def bitmap_distance(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference; the longer bitmap is folded, place modulo length, by parity."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    elif len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(_ONES[x ^ y].sum())


class PrefixTree:
    """Path-compressed tree over sets whose members are local ranks, ascending.

    Node arrays: parent edge (slice of a set), depth at its end, least and
    greatest set size below, children, and the sets that end there.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())  # big-endian bytes sort like the ranks
        self.edge: list[np.ndarray] = []
        self.depth: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[list[int]] = []
        self.ends: list[list[int]] = []
        self.some: list[int] = []  # one set below
        self.joined: list[bool] = []  # all sets below are linked with each other
        self._build(order, 0)

    def _node(self, edge, depth) -> int:
        self.edge.append(edge)
        self.depth.append(depth)
        self.low.append(1 << 60)
        self.high.append(0)
        self.children.append([])
        self.ends.append([])
        self.some.append(-1)
        self.joined.append(False)
        return len(self.edge) - 1

    def _build(self, order: list[int], depth: int) -> None:
        root = self._node(np.zeros(0, np.int64), 0)
        work = [(root, order)]
        while work:
            node, members = work.pop()
            at = self.depth[node]
            sizes = [len(self.sets[i]) for i in members]
            self.low[node], self.high[node], self.some[node] = min(sizes), max(sizes), members[0]
            self.joined[node] = len(members) == 1
            here = [i for i in members if len(self.sets[i]) == at]
            self.ends[node] = here
            for _, part in groupby((i for i in members if len(self.sets[i]) > at), key=lambda i: int(self.sets[i][at])):
                part = list(part)
                a, b = self.sets[part[0]], self.sets[part[-1]]  # sorted: what these share, all share
                m = min(len(a), len(b))
                differ = np.flatnonzero(a[at:m] != b[at:m])
                stop = at + int(differ[0]) if len(differ) else m
                child = self._node(a[at:stop], stop)
                self.children[node].append(child)
                work.append((child, part))

    def link(self, own: int, held: np.ndarray, sets: UnionFind, percent: int) -> Iterator[int]:
        """Sets similar to set ``own`` that are not yet linked with it; ``held`` marks its members by rank."""
        mine = self.sets[own]
        n = len(mine)
        stack: list[tuple] = [(0, 0, False)]
        while stack:
            node, overlap, leaving = stack.pop()
            if leaving:
                first = self.some[node]
                root = sets.find(first)
                self.joined[node] = all(self.joined[c] and sets.find(self.some[c]) == root for c in self.children[node]) and all(sets.find(i) == root for i in self.ends[node])
                continue
            if self.joined[node] and sets.find(self.some[node]) == sets.find(own):
                continue
            edge, depth = self.edge[node], self.depth[node]
            if len(edge):
                overlap += int(held[edge].sum())
                # of the members at hand only those behind the edge's last can still be shared
                left = n - int(np.searchsorted(mine, edge[-1], side="right"))
            else:
                left = n
            low = max(self.low[node], depth)
            reach = overlap + min(left, self.high[node] - depth)
            if reach < least_overlap(n + low, percent):
                continue
            for i in self.ends[node]:
                if i != own and overlap >= least_overlap(n + len(self.sets[i]), percent) and sets.find(i) != sets.find(own):
                    yield i
            if self.children[node]:
                stack.append((node, 0, True))
                stack.extend((c, overlap, False) for c in self.children[node])


def join_sets(names: list[int], members: list[np.ndarray], known: list[int], percent: int, order: GlobalOrder) -> list[tuple[int, int]]:
    """Links (a spanning forest of them) among sets of shingles; ``known`` are the components so far.

    The tree's order is the global one from its frequent end, after the counts
    within these sets: what more of them hold comes first.
    """
    keep = [k for k in range(len(names)) if len(members[k])]
    if len(keep) < 2:
        return []
    values, inverse, count = np.unique(np.concatenate([members[k] for k in keep]), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -order.of(values), -count))] = np.arange(len(values))
    ranked, edges = rank[inverse], np.cumsum([0, *(len(members[k]) for k in keep)])
    sets = [np.sort(ranked[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    tree, joined = PrefixTree(sets), UnionFind()
    first: dict[int, int] = {}
    for k, name in enumerate(keep):
        if first.setdefault(known[name], k) != k:
            joined.union(first[known[name]], k)
    held, links = np.zeros(len(values), bool), []
    for k in sorted(range(len(sets)), key=lambda k: (len(sets[k]), k)):
        held[sets[k]] = True
        for i in tree.link(k, held, joined, percent):
            joined.union(k, i)
            links.append((names[keep[k]], names[keep[i]]))
        held[sets[k]] = False
    return links


def _profile(docs: DataFrame, n: int, counters: int) -> DataFrame:
    """One pass: for each document its size, set hash and bitmap (kind 1); for each task its shingle counts (kind 0)."""

    names = ["kind", "id", "n", "sid", "sid2", "data"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.uint16)
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1)):
                sets = shingle_sets(data, at, n)
                every = np.concatenate(sets)
                bins, add = np.unique((every % U64(counters)).astype(np.int64), return_counts=True)
                counts[bins] = np.minimum(counts[bins].astype(np.int64) + add, 65_535)
                size = np.array([len(s) for s in sets], np.int64)
                key = [set_hash(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ones(hi - lo, np.int32)), batch.column(0)[lo:hi], pa.array(size), *(pa.array([x[k] for x in key], pa.int64()) for k in range(2)), pa.array([parity_bitmap(s) for s in sets], pa.binary()),
                ], names)
        parts = [(k, zlib.compress(p.tobytes(), 1)) for k, p in enumerate(counts.reshape(RANGES, -1)) if p.any()]
        none, zero = pa.nulls(len(parts), pa.int64()), np.zeros(len(parts), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(zero.astype(np.int32)), pa.array([k for k, _ in parts], pa.int64()), pa.array(zero), none, none, pa.array([p for _, p in parts], pa.binary())], names)

    return docs.mapInArrow(profile, "kind int, id long, n long, sid long, sid2 long, data binary")


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set (sorted distinct hashes), in two halves: sums of its members' mixed hashes, and its size."""
    halves = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.sum(mix(shingles ^ U64(seed)), dtype=U64, keepdims=True) + np.full(1, len(shingles), U64) * U64(0x9E3779B97F4A7C15)
        halves.append(int(mix(total).view(np.int64)[0]))
    return halves[0], halves[1]


def _step(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of 256 steps: exact order up to about 20, 4 per cent a step above."""
    return np.minimum(np.round(16 * np.log2(counts + 1.0)), 255).astype(np.uint8)


def _order(spark: SparkSession, profile: DataFrame, counters: int) -> np.ndarray:
    """Corpus counts, summed by range; a table of fixed size comes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(zlib.decompress(part), np.uint16).astype(np.int64)
                sums[k] = sums[k] + got if k in sums else got
        rows = sorted(sums.items())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([_step(s).tobytes() for _, s in rows], pa.binary())], ["id", "data"])

    parts = profile.where("kind = 0").select("id", "data").repartition("id").mapInArrow(add, "id long, data binary").toArrow()
    counts = np.zeros((RANGES, counters // RANGES), np.uint8)
    for k, part in zip(parts.column("id").to_pylist(), parts.column("data").to_pylist()):
        counts[k] = np.frombuffer(part, np.uint8)
    return counts.reshape(-1)


_POSTING = np.dtype([("token", "<u8"), ("sid", "<i8"), ("n", "<u4"), ("at", "<u4")])
_HOT = 0x80000000


def _postings(docs: DataFrame, order, n: int, percent: int, buckets: int) -> DataFrame:
    """Prefixes of all sets, packed by bucket of the shingle.

    Equal sets give one posting a task.  Where more than PAIRWISE sets of a
    task meet in a shingle, all but the least go out tied to the least.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = GlobalOrder(order.value)
        seen: set[tuple] = set()
        for batch in batches:
            held = []
            for _, _, data, at in slices(batch.column(0)):
                for s in shingle_sets(data, at, n):
                    if not len(s) or (key := set_hash(s)) in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(key)
                    p = prefix_length(len(s), percent)
                    rows = np.empty(p, _POSTING)
                    rows["token"], rows["sid"], rows["n"], rows["at"] = ranks.sort(s)[:p], key[0], len(s), np.arange(p)
                    held.append(rows)
            if not held:
                continue
            rows = np.concatenate(held)
            rows = rows[np.lexsort((rows["sid"], rows["token"]))]
            start = np.flatnonzero(np.concatenate(([True], rows["token"][1:] != rows["token"][:-1])))
            size = np.diff(np.append(start, len(rows)))
            ties = []
            if (size > PAIRWISE).any():
                keep = np.ones(len(rows), bool)
                for a, m in zip(start[size > PAIRWISE].tolist(), size[size > PAIRWISE].tolist()):
                    ties.append(np.stack((np.full(m - 1, rows["sid"][a]), rows["sid"][a + 1 : a + m]), axis=1))
                    keep[a + 1 : a + m] = False
                    rows["n"][a] |= _HOT
                rows = rows[keep]
            bucket = (mix(rows["token"]) % U64(buckets)).astype(np.int64)
            order_by = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order_by], bucket[order_by]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            out = [(int(bucket[a]), rows[a:b].tobytes(), b"") for a, b in zip(cut, np.append(cut[1:], len(rows)))]
            if ties:
                ties = np.unique(np.concatenate(ties), axis=0)
                out.append((int(ties[0, 0]) % buckets, b"", ties.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["bucket", "postings", "ties"])

    return docs.select("text").mapInArrow(deal, "bucket long, postings binary, ties binary")


def _meet(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, ties) of the nodes that meet in a shingle."""
    rows = rows[np.lexsort((rows["sid"], rows["token"]))]
    same = np.concatenate(([False], (rows["token"][1:] == rows["token"][:-1]) & (rows["sid"][1:] == rows["sid"][:-1])))
    if same.any():  # a set from several tasks; if any of them tied it, the group is a large one
        at = np.flatnonzero(~same)
        hot = np.maximum.reduceat(rows["n"] & _HOT, at)
        rows = rows[at]
        rows["n"] |= hot
    start = np.flatnonzero(np.concatenate(([True], rows["token"][1:] != rows["token"][:-1])))
    size = np.diff(np.append(start, len(rows)))
    hot = np.maximum.reduceat(rows["n"] & _HOT, start) > 0
    pairs, ties = [], []
    for a, m in zip(start[(size > PAIRWISE) | (hot & (size > 1))].tolist(), size[(size > PAIRWISE) | (hot & (size > 1))].tolist()):
        ties.append(np.stack((np.full(m - 1, rows["sid"][a]), rows["sid"][a + 1 : a + m]), axis=1))
    for m in range(2, PAIRWISE + 1):
        first = start[(size == m) & ~hot]
        if not len(first):
            continue
        i, j = np.triu_indices(m, 1)
        a, b = rows[(first[:, None] + i).ravel()], rows[(first[:, None] + j).ravel()]
        na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
        ok = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.minimum(na - a["at"], nb - b["at"]) >= least_overlap(na + nb, percent))
        pairs.append(np.stack((a["sid"][ok], b["sid"][ok]), axis=1))
    none = np.zeros((0, 2), np.int64)
    return np.unique(np.concatenate(pairs), axis=0) if pairs else none, np.unique(np.concatenate(ties), axis=0) if ties else none


def _partners(postings: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(a, b, tie): nodes that meet in a shingle and may be similar.  A task takes its buckets one after the other, sorted."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            held = []
            for _, packed, tied in group:
                if tied:
                    t = np.frombuffer(tied, "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(t[:, 0].copy()), pa.array(t[:, 1].copy()), pa.array(np.ones(len(t), bool))], ["a", "b", "tie"])
                if packed:
                    held.append(np.frombuffer(packed, _POSTING))
            for k, found in enumerate(_meet(np.concatenate(held), percent) if held else ()):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy()), pa.array(np.full(len(found), k == 1))], ["a", "b", "tie"])

    return postings.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "a long, b long, tie boolean")


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) node ids: ties, and the pairs whose bitmaps leave room for a link."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, tie, na, nb, da, db = (c.to_pylist() for c in batch.columns)
            ok = [t or bitmap_distance(x, y) <= n + m - 2 * least_overlap(n + m, percent) for t, n, m, x, y in zip(tie, na, nb, da, db)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("ra", "rb", "tie", "na", "nb", "da", "db").mapInArrow(judge, "a long, b long")


def _filter_bits(nodes: DataFrame) -> np.ndarray:
    """A bitmap of hashed ids, of FILTER_BITS at any number of nodes."""
    place = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    rows = nodes.select(F.floor(place / 32768).cast("long").alias("k"), (place % 32768).cast("long").alias("bit")).groupBy("k").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        out[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text, ...) of the documents that are nodes of clusters; others are filtered out before anything is shuffled."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(nodes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            keep = pa.array((bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["node", "text"]).filter(keep)

    some = docs.where("id is not null").select("id", "text", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("place")).mapInArrow(pick, "node long, text string")
    return some.join(nodes, "node")


def _block_links(members: DataFrame, n: int, percent: int, order) -> DataFrame:
    """(a, b) links within each (cluster, block) of (cluster, block, node, text, known)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = GlobalOrder(order.value)

        def rows():
            for batch in batches:
                keys = [batch.column(c).to_pylist() for c in (0, 1, 2, 4)]
                for lo, _, data, at in slices(batch.column(3)):
                    for k, s in enumerate(shingle_sets(data, at, n)):
                        yield keys[0][lo + k], keys[1][lo + k], keys[2][lo + k], keys[3][lo + k], s

        for _, group in groupby(rows(), key=lambda r: r[:2]):
            names, known, sets = [], [], []
            for _, _, node, component, s in group:
                names.append(node)
                known.append(component)
                sets.append(s)
            links = join_sets(names, sets, known, percent, ranks)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], ["a", "b"])

    dealt = members.repartition(F.col("cluster"), F.col("block")).sortWithinPartitions("cluster", "block", "node")
    return dealt.select("cluster", "block", "node", "text", "known").mapInArrow(join, "a long, b long")


def _sizes(spark: SparkSession, docs: DataFrame) -> tuple[int, int]:
    """(counters, buckets) for the corpus, of which a shingle takes about six bytes and every fourth is in a prefix."""
    shingles = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    counters = COUNTERS
    while counters < min(shingles // SHARE, MOST_COUNTERS):
        counters *= 2
    return counters, max(shuffle_partitions(spark), shingles // 4 // BUCKET_POSTINGS)


def ngram_join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
    counters: int | None = None, block_shingles: int = BLOCK_SHINGLES, work: Workspace | None = None,
) -> DataFrame:
    """(id, n_shingles, component) of every row; the component is the least id reachable by links."""
    spark = df.sparkSession
    work = work or Workspace(spark, "ngram-join")
    docs = df.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text"))
    own, buckets = _sizes(spark, docs)
    counters = counters or own
    profile = work.keep(_profile(docs, n, counters), "profile")
    order = spark.sparkContext.broadcast(_order(spark, profile, counters))
    rows = profile.where("kind = 1")
    # nodes: documents with equal sets, named by the least id
    nodes = rows.where("sid is not null and id is not null").groupBy("sid", "sid2").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("data").alias("data"))
    nodes = work.keep(nodes, "nodes")
    met = _partners(_postings(docs.where("id is not null"), order, n, percent, buckets), percent, buckets)
    pairs = work.keep(met.groupBy("a", "b").agg(F.max("tie").alias("tie")), "pairs")
    left = nodes.select(F.col("sid").alias("a"), F.col("node").alias("ra"), F.col("n").alias("na"), F.col("data").alias("da"))
    right = nodes.select(F.col("sid").alias("b"), F.col("node").alias("rb"), F.col("n").alias("nb"), F.col("data").alias("db"))
    near = work.keep(_possible(pairs.join(left, "a").join(right, "b"), percent), "near")
    clusters = connected_components(near, work, "clusters").withColumnRenamed("component", "cluster")
    work.drop("pairs", "near")

    sized = clusters.join(nodes.select("node", "n"), "node")
    blocks = sized.groupBy("cluster").agg(_blocks(block_shingles))
    # written: it is read for the filter, for the texts and for the question below
    sized = work.keep(sized.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).select("node", "n", "cluster", "blocks", "block"), "in-clusters")
    members = _texts_of(docs, sized)
    many = sized.where("blocks > 1").limit(1).count() > 0
    if many:  # texts of the clusters are read several times
        members = work.keep(members, "members")
    links = work.keep(_block_links(members.withColumn("known", F.col("node")), n, percent, order), "links-1")
    if many:
        links = _across_blocks(members.where("blocks > 1"), links, n, percent, block_shingles, order, work)
        work.drop("members")
    found = connected_components(links, work, "components")
    parts = nodes.select("sid", "sid2", "node").join(found, "node", "left").select("sid", "sid2", F.coalesce("component", "node").alias("component"))
    # equal sets make a skewed key here, which AQE splits; nothing above needs a key's rows together
    out = rows.select("id", F.col("n").alias("n_shingles"), "sid", "sid2").join(parts, ["sid", "sid2"], "left")
    return out.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def _blocks(shingles: int):
    """Blocks that a cluster is dealt out over."""
    return F.greatest(F.ceil(F.sum("n") / shingles), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("long").alias("blocks")


def _across_blocks(members: DataFrame, links: DataFrame, n: int, percent: int, block_shingles: int, order, work: Workspace) -> DataFrame:
    """All links of clusters that have several blocks."""

    def labelled(step: str) -> DataFrame:
        """(cluster, node, n, block, known): each node with its component so far."""
        found = connected_components(links, work, step)
        return work.keep(members.select("cluster", "node", "n", "block").join(found, "node", "left").select("cluster", "node", "n", "block", F.coalesce("component", "node").alias("known")), f"{step}-members")

    texts = members.select("node", "text")
    # one set for each component: near copies fall together here
    heads = labelled("across-1").where("node = known").drop("block")  # a component is named by its least node
    room = heads.groupBy("cluster").agg(_blocks(block_shingles))
    heads = heads.join(room, "cluster").withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), "blocks"))
    links = work.keep(links.unionByName(_block_links(heads.join(texts, "node"), n, percent, order)), "links-2")
    now = labelled("across-2")
    sizes = now.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("size", "known"))["known"].alias("main"), F.count(F.lit(1)).alias("parts"))
    open_ = work.keep(now.join(largest.where("parts > 1"), "cluster").drop("parts"), "open")
    if open_.isEmpty():
        return links
    visits = work.keep(routed_visits(open_, texts, n, percent), "visits")
    # many visitors come in groups, each of which meets the block's own sets
    groups = visits.join(open_.select("node", "n"), "node").groupBy("cluster", "block").agg(_blocks(block_shingles).alias("groups"))
    place = (F.col("block") * (1 << 24) + F.col("group")).alias("block")
    known = open_.select("node", "known")
    guests = visits.join(groups, ["cluster", "block"]).withColumn("group", F.pmod(F.xxhash64("node", F.lit(1)), "groups")).select("cluster", place, "node")
    hosts = open_.join(groups, ["cluster", "block"]).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).select("cluster", place, "node")
    more = _block_links(guests.unionByName(hosts).join(known, "node").join(texts, "node"), n, percent, order)
    return work.keep(links.unionByName(more), "links-3")


def routed_visits(open_: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(cluster, node, block) of (cluster, node, n, block, known, main): blocks that a set apart from its cluster's main component has to visit.

    A set of the block may be similar to it only if both hold one shingle in
    their prefixes, in the order of exact counts within the cluster.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in range(3)]
            for lo, _, data, at in slices(batch.column(3)):
                sets = shingle_sets(data, at, n)
                row = np.repeat(np.arange(lo, lo + len(sets)), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([*(pa.array(k[row]) for k in keys), pa.array(np.concatenate(sets).view(np.int64))], ["cluster", "node", "n", "token"])

    held = open_.join(texts, "node").select("cluster", "node", "n", "text").mapInArrow(explode, "cluster long, node long, n long, token long")
    key = ["cluster", "token"]
    # what one set alone holds comes first in the order and links nothing, so only its number matters
    common = held.groupBy(*key).agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = W.partitionBy("node")
    ranked = held.join(common, key).withColumns({"at": F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "token")) - 1})
    prefix = ranked.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100)).select(*key, "node", "n", (F.col("n") - F.col("at")).alias("left"))
    placed = prefix.join(open_.select("node", "block", "known", "main"), "node")
    there = placed.groupBy(*key, "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("left").alias("room"))
    guests = placed.where("known <> main").select(*key, "node", "n", "left", F.col("block").alias("home"))
    # the bounds on two sets, at their best over the block's; a set's own block has been joined
    may = (F.col("block") != F.col("home")) & (100 * F.col("n") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("n"))
    may &= F.least("left", "room") * (100 + percent) >= percent * (F.col("n") + F.col("low"))
    return guests.join(there, key).where(may).select("cluster", "node", "block").distinct()
