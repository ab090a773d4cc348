"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line keys, sorted by their 128-bit hash, with the number
of documents that hold the key and the largest of their ids.  Each new batch
of documents is reduced to its own keys and merged with the runs: what no run
holds is fresh and starts its own count (the anti-join), what some run holds
goes on from there (its newest version has the largest count).  The result is
added as a run of level 0; when a level has ``fan_in`` runs they are compacted
into one run of the next level.  So a key is rewritten once per level, not once
per batch, and a batch's run tells for each of its keys how it stands over all
batches so far.

Keys that enough documents hold are then dropped from all documents but the
one with the largest id; which they are is read from the runs' newest versions.

Defined cases: a line's key is the line stripped of ASCII white space with A-Z
lower-cased; null and empty texts are one empty line; a document counts once
for a key however often it repeats the line, and all its lines with the key
stay or go together; rows that share an id each count, and all of them keep
the lines if it is the largest id; null ids count as smaller than any id and
are returned; no rows give no rows; other columns are not read.  Two keys are
the same if their XXH3 hashes of 128 bits are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, no_null, shuffle_partitions
from .vec import LOWER, WS, slices, wide_hashes

MIN_CHARS = 40
MIN_DOCS = 5
#: Runs of a level that are compacted into one of the next.
FAN_IN = 4
#: Batches that a whole table is taken in.
BATCHES = 4
#: Keys that one task sorts and merges, about.
TASK_KEYS = 4_000_000
#: Dropped keys that are broadcast (24 bytes each); more are joined instead.
BROADCAST_KEYS = 1_000_000
NO_ID = -(1 << 63)


def line_ranges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every line of every row."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((at[:-1], breaks + 1)))
    end = np.sort(np.concatenate((breaks, at[1:])))
    per_row = 1 + np.diff(np.searchsorted(breaks, at))
    return np.repeat(np.arange(len(at) - 1), per_row), start, end


def line_keys(data: np.ndarray, at: np.ndarray, min_chars: int) -> tuple:
    """(row, start, end, is key, hash, hash) of every line; a key has at least ``min_chars`` code points."""
    row, start, end = line_ranges(data, at)
    solid = np.flatnonzero(~WS[data])
    i, j = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = j > i
    a, b = start.copy(), start.copy()
    a[some], b[some] = solid[i[some]], solid[j[some] - 1] + 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    key = points[b] - points[a] >= min_chars
    h1, h2 = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
    if key.any():
        h1[key], h2[key] = wide_hashes(LOWER[data], a[key], b[key])
    return row, start, end, key, h1, h2


class LineRuns:
    """Levels of sorted runs: (h1, h2, docs, last, fresh); a key's counts are those over all batches up to its run."""

    def __init__(self, spark: SparkSession, work: Workspace, fan_in: int = FAN_IN):
        self.spark, self.work, self.fan_in = spark, work, fan_in
        self.levels: list[list[DataFrame]] = []
        self.names: dict[int, str] = {}
        self.partitions: int | None = None
        self._made = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, run: DataFrame) -> DataFrame:
        self._made += 1
        out = self.work.keep(run.sortWithinPartitions("h1", "h2"), f"run-{self._made}")
        self.names[id(out)] = f"run-{self._made}"
        return out

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h1", "h2").agg(F.max("docs").alias("docs"), F.max("last").alias("last"))

    def add(self, counts: DataFrame) -> DataFrame:
        """Add a batch's (h1, h2, docs, last); returns its run, in which fresh keys are marked."""
        if self.partitions:
            counts = counts.repartition(self.partitions, "h1", "h2")
        own = counts.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        held = self.runs()
        if held:
            old = self._union(held).select("h1", "h2", F.col("docs").alias("old_docs"), F.col("last").alias("old_last"))
            if self.partitions:
                old = old.repartition(self.partitions, "h1", "h2")
            # one merge is the anti-join (nothing held: fresh) and the lookup (held: newest version plus own)
            met = own.join(old.hint("merge"), ["h1", "h2"], "left").groupBy("h1", "h2").agg(
                (F.first("docs") + F.coalesce(F.max("old_docs"), F.lit(0))).alias("docs"), F.greatest(F.first("last"), F.max("old_last")).alias("last"), F.max("old_docs").isNull().alias("fresh")
            )
        else:
            met = own.withColumn("fresh", F.lit(True))
        run = self._write(met)
        level, carry = 0, run
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(carry)
            if len(self.levels[level]) < self.fan_in:
                return run
            whole = self._union(self.levels[level])
            if self.partitions:
                whole = whole.repartition(self.partitions, "h1", "h2")
            carry = self._write(self._newest(whole).withColumn("fresh", F.lit(False)))
            for old in self.levels[level]:
                if old is not run:  # the caller holds this batch's own
                    self.work.drop(self.names.pop(id(old)))
            self.levels[level] = []
            level += 1

    def counts(self, at_least: int = 1) -> DataFrame:
        """(h1, h2, docs, last) of the keys that so many documents hold: a key's newest version passes if any does."""
        return self._newest(self._union(self.runs()).where(F.col("docs") >= at_least))


def batch_counts(docs: DataFrame, bounds: list[int], min_chars: int) -> DataFrame:
    """(batch, h1, h2, docs, last) of (id, text), summed within each task."""
    edges = np.array(bounds, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array([NO_ID if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            parts = []
            for lo, _, data, at in slices(batch.column(1)):
                row, _, _, key, h1, h2 = line_keys(data, at, min_chars)
                parts.append(np.unique(np.stack((h1[key], h2[key], lo + row[key])), axis=1) if key.any() else np.zeros((3, 0), np.int64))
            if not parts:
                continue
            h1, h2, row = np.concatenate(parts, axis=1)
            frame = pd.DataFrame({"batch": np.searchsorted(edges, ids[row], side="left"), "h1": h1, "h2": h2, "last": ids[row]})
            out = frame.groupby(["batch", "h1", "h2"], sort=False).agg(docs=("last", "size"), last=("last", "max")).reset_index()
            yield pa.RecordBatch.from_pandas(out[["batch", "h1", "h2", "docs", "last"]].astype(np.int64), preserve_index=False)

    return docs.mapInArrow(count, "batch long, h1 long, h2 long, docs long, last long")


def _emit(ids, data, at, row, start, end, drop) -> list[tuple]:
    """(id, lines, dropped, kept text) of each row."""
    lines = np.bincount(row, minlength=len(at) - 1)
    gone = np.bincount(row[drop], minlength=len(at) - 1)
    raw, out, first = data.tobytes(), [], np.concatenate(([0], np.cumsum(lines)))
    for r, i in enumerate(ids):
        if gone[r]:
            kept = b"\n".join(raw[start[k] : end[k]] for k in range(first[r], first[r + 1]) if not drop[k])
        else:
            kept = raw[at[r] : at[r + 1]]
        out.append((i, int(lines[r]), int(gone[r]), kept))
    return out


def _kept(docs: DataFrame) -> str:
    return f"id long, n_lines long, n_dropped long, text string, rest {docs.schema['rest'].dataType.simpleString()}"


def _record(rows: list[tuple], rest: pa.Array) -> pa.RecordBatch:
    ids, lines, gone, kept = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), rest], ["id", "n_lines", "n_dropped", "text", "rest"])


def _drop_broadcast(docs: DataFrame, hot: DataFrame, min_chars: int) -> DataFrame:
    rows = hot.toPandas().sort_values(["h1", "h2"])
    h1, h2, last = (rows[c].to_numpy(np.int64) for c in ("h1", "h2", "last"))
    repeats = int(rows.groupby("h1").size().max()) if len(rows) else 0
    shared = docs.sparkSession.sparkContext.broadcast((h1, h2, last))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run1, run2, holder = shared.value
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, data, at in slices(batch.column(1)):
                ids = np.array([NO_ID if x is None else x for x in names[lo:hi]], np.int64)
                row, start, end, key, a, b = line_keys(data, at, min_chars)
                gone = np.zeros(len(row), bool)
                where = np.searchsorted(run1, a)
                for k in range(repeats):
                    slot = np.minimum(where + k, len(run1) - 1)
                    gone |= key & (run1[slot] == a) & (run2[slot] == b) & (holder[slot] != ids[row])
                yield _record(_emit(names[lo:hi], data, at, row, start, end, gone), batch.column(2)[lo:hi])

    return docs.mapInArrow(drop, _kept(docs))


def _drop_joined(docs: DataFrame, hot: DataFrame, min_chars: int, work: Workspace) -> DataFrame:
    """The same with joins only, for dropped keys of any number.  Lines are found again by a row number that is written first, as ids may repeat or be null."""
    docs = work.keep(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(2))
            for lo, _, data, at in slices(batch.column(2)):
                row, _, _, key, a, b = line_keys(data, at, min_chars)
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                own = lo + row[key]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows[own], ids[own], nth[key], a[key], b[key])], ["row", "id", "nth", "h1", "h2"])

    lines = docs.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "text").mapInArrow(explode, "row long, id long, nth long, h1 long, h2 long")
    gone = lines.join(hot.hint("merge"), ["h1", "h2"]).where("id <> last").groupBy("row").agg(F.collect_list("nth").alias("gone"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lists = batch.column(0).to_pylist(), batch.column(2)
            for lo, hi, data, at in slices(batch.column(1)):
                row, start, end = line_ranges(data, at)
                mark, first = np.zeros(len(row), bool), np.searchsorted(row, np.arange(hi - lo))
                for r in range(hi - lo):
                    mark[[first[r] + n for n in lists[lo + r].as_py() or []]] = True
                yield _record(_emit(names[lo:hi], data, at, row, start, end, mark), batch.column(3)[lo:hi])

    return docs.join(gone, "row", "left").select("id", "text", "gone", "rest").mapInArrow(drop, _kept(docs))


def line_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    batches: int = BATCHES, broadcast_keys: int = BROADCAST_KEYS, work: Workspace | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """(id, n_lines, n_dropped, text, rest): each document with its repeated lines gone; ``rest`` is a struct of its columns ``keep``."""
    spark = df.sparkSession
    work = work or Workspace(spark, "line-dedup")
    docs = df.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text"), F.struct(*keep, F.lit(True).alias("_row")).alias("rest"))
    lo, hi = docs.agg(F.min("id"), F.max("id")).first()
    lo, hi = lo or 0, hi or 0
    bounds = [lo + (hi - lo) * (k + 1) // batches for k in range(batches - 1)]
    counts = work.keep(batch_counts(docs.drop("rest"), bounds, min_chars), "lines", by="batch")
    runs = LineRuns(spark, work)
    needed = -(-counts.count() // TASK_KEYS)
    if needed > shuffle_partitions(spark):
        runs.partitions = needed
    for k in range(batches):
        runs.add(counts.where(F.col("batch") == k).drop("batch"))
    hot = work.keep(runs.counts(min_docs).select("h1", "h2", "last"), "hot")
    work.drop("lines", *runs.names.values())
    if hot.count() <= broadcast_keys:
        return _drop_broadcast(docs, hot, min_chars)
    return _drop_joined(docs, hot, min_chars, work)
