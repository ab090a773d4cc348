"""Text quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of hashed terms: its words, the shapes of its words (which
kinds of characters they begin and end with) and how often words come again at
short distances.  A truncated singular value decomposition of the labelled
sample gives latent vectors of some dozen dimensions; those of the labelled
rows are broadcast.  Every text is projected, its cosine with every labelled
vector is computed exactly, block by block, and the nearest vote with their
similarity as weight.

The labelled sample is bounded by ``sample_rows`` (the rows whose hashed ids
come first), and so are the broadcast vectors; nothing else is sampled.

Defined cases: null and empty texts have no terms and get the share of label 1
in the sample; labels that are null or belong to no document are left out;
several labels of one id are averaged and rounded up; without any label every
score is 0.5; texts are read whole; rows are judged one by one, so equal texts
get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, no_null
from .vec import LOWER, U64, mix, range_hashes, slices, word_ranges

SAMPLE_ROWS = 4096
WORD_BINS, SHAPE_BINS = 3072, 1024
BINS = WORD_BINS + SHAPE_BINS
RANK = 64
NEIGHBOURS = 24
#: Similarities are raised to this power before they vote.
SHARPNESS = 4
#: Rows and bytes that are turned into dense vectors at a time.
BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 19

_SHAPE = np.arange(256, dtype=np.int64)
_SHAPE[0x61:0x7B] = _SHAPE[0x80:0x100] = 0x61
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x30:0x3A] = 0x30
#: Distances at which a word that comes again is counted, in the first shape bins.
LAGS = (1, 2, 3, 4, 6, 8, 12, 16)


def term_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed terms, one row of BINS for each text."""
    n = len(at) - 1
    start, end, first = word_ranges(data, at)
    if not len(start):
        return np.zeros((n, BINS), np.float32)
    words = range_hashes(LOWER[data], start, end)
    row = np.repeat(np.arange(n), np.diff(first))
    size = end - start
    second = _SHAPE[data[np.minimum(start + 1, end - 1)]]
    shape = (_SHAPE[data[start]] | second << 8 | _SHAPE[data[np.maximum(end - 2, start)]] << 16 | _SHAPE[data[end - 1]] << 24) ^ (np.minimum(size, 16) // 4 << 33)
    places = [row * BINS + (words % U64(WORD_BINS)).astype(np.int64), row * BINS + WORD_BINS + 8 + (mix(shape.astype(U64)) % U64(SHAPE_BINS - 8)).astype(np.int64)]
    for k, lag in enumerate(LAGS):
        again = np.flatnonzero((words[lag:] == words[:-lag]) & (row[lag:] == row[:-lag]))
        places.append(row[again] * BINS + WORD_BINS + k)
    return np.bincount(np.concatenate(places), minlength=n * BINS).reshape(n, BINS).astype(np.float32)


@dataclass
class LatentModel:
    idf: np.ndarray  # BINS
    project: np.ndarray  # BINS x RANK
    vectors: np.ndarray  # sample x RANK, unit length
    labels: np.ndarray  # sample
    base: float

    @staticmethod
    def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """Damped counts times rarity; words and shapes each of unit length, shapes counting double."""
        out = np.log1p(counts) * idf
        for part, scale in ((slice(0, WORD_BINS), 1.0), (slice(WORD_BINS, BINS), 2.0)):
            norm = np.linalg.norm(out[:, part], axis=1, keepdims=True)
            out[:, part] *= scale / np.where(norm > 0, norm, 1)
        return out

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(norm > 0, norm, 1)

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> LatentModel:
        idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
        x = cls.weigh(counts, idf)
        # randomised range finder with two power steps, then a small exact decomposition
        rank = max(1, min(rank, *x.shape))
        q = x @ np.random.default_rng(0).standard_normal((x.shape[1], min(x.shape[1], rank + 16))).astype(np.float32)
        for _ in range(2):
            q, _ = np.linalg.qr(x @ (x.T @ np.linalg.qr(q)[0]))
        q, _ = np.linalg.qr(q)
        _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
        project = np.ascontiguousarray(vt[:rank].T)
        return cls(idf, project, cls.unit(x @ project).astype(np.float32), labels.astype(np.float32), float(labels.mean()) if len(labels) else 0.5)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.base)
        cosine = self.unit(self.weigh(counts, self.idf) @ self.project).astype(np.float32) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1).astype(np.float64), 0) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, np.clip(vote, 0, 1), self.base)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled documents: those whose hashed ids come first."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn)
    marked = marked.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.ceil(F.avg(label_col)).cast("int").alias("label"))
    there = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null")
    chosen = marked.join(there, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(rows)
    source = docs.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text"))
    return source.join(F.broadcast(chosen), "id")


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> LatentModel:
    """Learn from the labels whose row satisfies ``learn``.

    Vectors, not texts, come to the driver: the counts that are not zero.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1), BLOCK_BYTES, BLOCK_ROWS):
                counts = term_counts(data, at)
                packed = [np.flatnonzero(c).astype("<u2").tobytes() + c[c > 0].astype("<f4").tobytes() for c in counts]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(packed, pa.binary())], ["id", "label", "counts"])

    sample = labelled_sample(docs, labels, label_col, learn, sample_rows, id_col, text_col).select("id", "text", "label")
    rows = sample.mapInArrow(vectors, "id long, label int, counts binary").toArrow().sort_by("id")
    rows = rows.slice(0, sample_rows)  # ids may repeat in documents; the bound holds
    counts = np.zeros((len(rows), BINS), np.float32)
    for own, packed in zip(counts, rows.column("counts")):
        raw = packed.as_py()
        size = len(raw) // 6
        own[np.frombuffer(raw, "<u2", size)] = np.frombuffer(raw, "<f4", size, 2 * size)
    known = np.array(rows.column("label").to_pylist(), np.float32)
    if not len(known):
        return LatentModel(np.zeros(BINS, np.float32), np.zeros((BINS, 1), np.float32), np.zeros((0, 1), np.float32), known, 0.5)
    return LatentModel.fit(counts, known)


def score_quality(docs: DataFrame, model: LatentModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1), BLOCK_BYTES, BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(shared.value.score(term_counts(data, at)), pa.float64())], ["id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text")).mapInArrow(score, "id long, score double")


def keep_good(docs: DataFrame, model: LatentModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows with at least this score, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: pa.Array) -> np.ndarray:
        parts = [shared.value.score(term_counts(data, at)) >= threshold for _, _, data, at in slices(texts, BLOCK_BYTES, BLOCK_ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    return filter_rows(docs, text_col, lambda: judge)
