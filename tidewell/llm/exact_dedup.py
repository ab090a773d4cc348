"""Exact deduplication against a minimal perfect hash of known digests.

The history is a set of distinct SHA-256 digests, each with a winner locator
(the largest id that has this text) and a count.  It is split into buckets by
the digest's first bytes.  Every bucket holds a minimal perfect hash in the
levelled bit-array form (Limasset et al., "Fast and scalable minimal perfect
hashing", 2017): a key that is alone in its position of a level is settled
there, the others go to the next level, and the rank of a settled bit is the
slot.  Keys that no level settles (none in practice) take the last slots and are
looked up among themselves.  A slot holds the full 32-byte digest, so a lookup compares bytes and a
digest that is not a member is never taken for one.

An arriving batch is first reduced to distinct digests (map-side combining, so
a group of copies of any size costs one row per task), then looked up bucket by
bucket.  Members extend their historical group, nonmembers are grouped among
themselves, and both together are the next history.

Defined cases: null text is the empty text; texts are compared byte for byte;
of equal texts the largest id stays, and equal ids count as several rows of
one winner; rows with a null id take part in the group and only lose to any id;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, no_null
from .vec import U64, mix

#: Digests in a bucket on average; a bucket is what one lookup holds in memory.
BUCKET_KEYS = 4096
MAX_LEVELS = 64
INDEX_SCHEMA = "buckets long, bucket long, n_keys long, level_sizes array<int>, levels binary, digests binary, winners binary, counts binary"
_FOUND = "digest binary, winner long, n long, member boolean"


def _seeds(words: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(words[:, 0] ^ mix(words[:, 1] + U64(level * 2 + 1))) % U64(size)).astype(np.int64)


def _words(digests: np.ndarray) -> np.ndarray:
    """Two 64-bit words of each 32-byte digest."""
    return np.ascontiguousarray(digests[:, 8:24]).view("<u8")


def build_mph(digests: np.ndarray, gamma: float = 1.5) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, all levels' bits, slot of each digest) of distinct digests (n x 32 bytes).

    Slots are a permutation of 0..n-1: the function is perfect and minimal.
    """
    words, left = _words(digests), np.arange(len(digests))
    sizes, bits, place, base = [], [], np.zeros(len(digests), np.int64), 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            break
        size = max(8, int(gamma * len(left)))
        at = _seeds(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        place[left[settled]] = base + at[settled]
        sizes.append(size)
        bits.append(alone)
        base += size
        left = left[~settled]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    slot = (np.cumsum(flat) - 1)[place] if len(flat) else place
    slot[left] = int(flat.sum()) + np.arange(len(left))
    return sizes, flat, slot


def lookup_mph(sizes: list[int], flat: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of each digest; -1 where no level claims it.  Claims are not yet proof."""
    words, slot = _words(digests), np.full(len(digests), -1, np.int64)
    rank, left, base = np.cumsum(flat) - 1, np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            break
        at = base + _seeds(words[left], level, size)
        hit = flat[at]
        slot[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return slot


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _index_bucket(key: tuple, rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    sizes, flat, slot = build_mph(digests)
    order = np.argsort(slot)
    winners = rows["winner"].fillna(-(1 << 63)).to_numpy(np.int64)
    return pd.DataFrame([{
        "buckets": buckets, "bucket": key[0], "n_keys": len(rows), "level_sizes": sizes, "levels": np.packbits(flat).tobytes(),
        "digests": digests[order].tobytes(), "winners": winners[order].tobytes(), "counts": rows["n"].to_numpy(np.int64)[order].tobytes(),
    }])


def _lookup_bucket(key: tuple, rows: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"digest": [], "winner": [], "n": [], "member": []})
    found = np.zeros(len(rows), bool)
    winner, n = rows["winner"].astype("Int64").copy(), rows["n"].to_numpy(np.int64).copy()
    if len(index):
        own = index.iloc[0]
        sizes = [int(x) for x in own["level_sizes"]]
        flat = np.unpackbits(np.frombuffer(own["levels"], np.uint8), count=sum(sizes)).astype(bool)
        held, digests = np.frombuffer(own["digests"], np.uint8).reshape(-1, 32), _matrix(rows["digest"])
        slot = lookup_mph(sizes, flat, digests)
        if own["n_keys"] > flat.sum():
            last = {held[k].tobytes(): k for k in range(int(flat.sum()), len(held))}
            slot = np.array([last.get(d.tobytes(), k) for d, k in zip(digests, slot.tolist())], np.int64)
        found = slot >= 0
        found[found] = (held[slot[found]] == digests[found]).all(axis=1)
        old = np.frombuffer(own["winners"], np.int64)[slot[found]]
        new = winner[found].fillna(-(1 << 63)).to_numpy(np.int64)
        best = pd.array(np.maximum(old, new), dtype="Int64")
        best[np.maximum(old, new) == -(1 << 63)] = pd.NA
        winner[found] = best
        n[found] += np.frombuffer(own["counts"], np.int64)[slot[found]]
    return pd.DataFrame({"digest": rows["digest"], "winner": winner, "n": n, "member": found})


class DigestHistory:
    """Distinct digests seen so far, as one indexed row per bucket."""

    def __init__(self, spark: SparkSession, work: Workspace | None = None, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.work, self.bucket_keys = spark, work or Workspace(spark, "exact-dedup"), bucket_keys
        self.buckets, self.index, self._step = 1, None, 0

    @staticmethod
    def _bucket(buckets: int):
        return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets))

    @staticmethod
    def group(digests: DataFrame) -> DataFrame:
        """Distinct digests with winner and count, from rows (id, digest)."""
        return digests.groupBy("digest").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n"))

    def build(self, groups: DataFrame) -> DigestHistory:
        """Index distinct digests (digest, winner, n)."""
        self.buckets = max(1, -(-groups.count() // self.bucket_keys))
        buckets = self.buckets
        index = groups.withColumn("bucket", self._bucket(buckets)).groupBy("bucket").applyInPandas(lambda key, rows: _index_bucket(key, rows, buckets), INDEX_SCHEMA)
        self._step += 1
        self.index = self.work.keep(index, f"index-{self._step}")
        return self

    def save(self, path: str) -> None:
        """Write the index to a folder of its own, from which a later run opens it."""
        self.index.write.mode("errorifexists").parquet(path)

    @classmethod
    def open(cls, spark: SparkSession, path: str, work: Workspace | None = None, bucket_keys: int = BUCKET_KEYS) -> DigestHistory:
        history = cls(spark, work, bucket_keys)
        history.index = spark.read.schema(INDEX_SCHEMA).parquet(path)
        history.buckets = history.index.agg(F.max("buckets")).first()[0] or 1
        return history

    def merged(self, arrived: DataFrame) -> DataFrame:
        """Distinct digests of history and of what ``lookup`` returned: what no arrival has touched stays as it was."""
        if self.index is None:
            return arrived.drop("member")
        return self.entries().join(arrived.where("member").select("digest"), "digest", "left_anti").unionByName(arrived.drop("member"))

    def lookup(self, groups: DataFrame) -> DataFrame:
        """Each arriving distinct digest with its winner and count over history and arrivals, and whether history had it."""
        arriving = groups.withColumn("bucket", self._bucket(self.buckets))
        if self.index is None:
            return groups.withColumn("member", F.lit(False))
        return arriving.groupBy("bucket").cogroup(self.index.groupBy("bucket")).applyInPandas(_lookup_bucket, _FOUND)

    def entries(self) -> DataFrame:
        """The history's slots as rows again."""

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    held = row.digests
                    winners = pd.array(np.frombuffer(row.winners, np.int64), dtype="Int64").copy()
                    winners[winners == -(1 << 63)] = pd.NA
                    yield pd.DataFrame({"digest": [held[i : i + 32] for i in range(0, len(held), 32)], "winner": winners, "n": np.frombuffer(row.counts, np.int64)})

        return self.index.mapInPandas(unpack, "digest binary, winner long, n long")


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(no_null(text_col).cast("binary"), 256)).alias("digest"))


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", work: Workspace | None = None, bucket_keys: int = BUCKET_KEYS, history: DigestHistory | None = None,
) -> DataFrame:
    """(id, digest, winner, n) for every row: its digest, the id that stays and how many rows share the text.

    Given a ``history``, all rows arrive as its next batch.  Without one, the
    rows with ids up to the middle of the id range are the history, and those
    above it arrive.
    """
    spark = df.sparkSession
    work = work or Workspace(spark, "exact-dedup")
    rows = work.keep(digest_rows(df, id_col, text_col), "digests")
    groups, arriving = DigestHistory.group, rows
    if history is None:
        lo, hi = rows.agg(F.min("id"), F.max("id")).first()
        middle = F.lit((lo + hi) // 2 if lo is not None else 0)
        history = DigestHistory(spark, work, bucket_keys).build(groups(rows.where(F.col("id").isNull() | (F.col("id") <= middle))))
        arriving = rows.where(F.col("id") > middle)
    arrived = work.keep(history.lookup(groups(arriving)), "looked-up")
    # a hot digest is a skewed join key here, which AQE splits; nothing above needs a digest's rows together
    return rows.join(history.merged(arrived), "digest").select("id", "digest", "winner", "n")
