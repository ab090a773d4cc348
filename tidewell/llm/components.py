"""Connected components as DataFrame rounds of large-star and small-star.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)  Each
round is aggregations with map-side combining and equi-joins, so a node with
very many links never meets in one task: the join's hot key is split by AQE.
Links that one task may hold anyway (LINKS_AT_ONCE) are joined by one task
instead: a round costs about nine stages, however few the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


class UnionFind:
    """Smallest member of a set is its root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


#: Nodes of links that a task contracts at a time; bounds its memory, not the input.
LINKS_AT_ONCE = 200_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all links that come; for tasks of at most LINKS_AT_ONCE nodes."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
    nodes = list(sets.up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([sets.find(x) for x in nodes], pa.int64())], ["node", "component"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def stars(sets: UnionFind):
        rows = [(x, r) for x in sets.up if (r := sets.find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["a", "b"])

    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
        if len(sets.up) >= LINKS_AT_ONCE:
            yield stars(sets)
            sets = UnionFind()
    yield stars(sets)


def connected_components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns).

    The component is its smallest node.  Links with a null end and links of a
    node to itself say nothing and are left out; no links give no rows.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    # Every partition first shrinks its links to stars on the smallest node it knows.
    edges = work.keep(edges.mapInArrow(_contract, "a long, b long"), f"{name}-0")
    if 2 * edges.count() <= LINKS_AT_ONCE:  # a link has two nodes at most
        whole = work.keep(edges.repartition(1).mapInArrow(_union, "node long, component long"), f"{name}-whole")
        work.drop(f"{name}-0")
        return whole
    seen, k = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large-star: larger neighbours move to the least node in reach
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small-star: each node hands its smaller neighbours to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        k += 1
        edges = work.keep(small, f"{name}-{k}")
        work.drop(f"{name}-{k - 1}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
