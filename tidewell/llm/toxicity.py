"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: its words and their first bytes, hashed.  The
machine adds to a bias and a weight for each term the inner products of the
terms' factors for every pair of terms, so a pair such as an insult and the
mention of a group can count for more than its two parts (Rendle, 2010).

It is learnt on a bounded sample of labelled rows (``sample_rows``, a
parameter).  Terms that the sample ties to the label go into the machine, by
themselves or in a pair: two terms whose joint presence tells more about the
label than both do singly go in even if neither tells anything alone.  The
others have weight zero; the model is a table of bounded size and is broadcast.

Defined cases: null and empty texts have no terms and get the bias alone;
labels that are null or belong to no document are left out; several labels of
one id are averaged and rounded up; without any label every score is 0; texts
are read whole and judged one by one, so equal texts get equal scores; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_null
from .quality import labelled_sample
from .vec import LOWER, U64, range_hashes, slices

SAMPLE_ROWS = 8192
BINS = 1 << 20
TERMS = 1024
#: Likelihood ratio (chi-square scale) from which a term counts as tied to the label; so many of the best go in at least.
LEAST_TIE, FEW_TERMS = 8.0, 64
#: Terms whose pairs are compared (the most variable ones), the gain in likelihood ratio from which a pair counts
#: (two million pairs are tried, and chance alone gives about 30: twice that), and how many terms may go in by pairs besides TERMS.
PAIR_TERMS, LEAST_GAIN, PAIRED = 2048, 60.0, 256
FACTORS = 8
ROUNDS = 200
#: Bytes of a word's heads that are terms beside the word, so that forms of a word not seen in the sample count.
PREFIXES = (4, 5)
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 19

#: ASCII letters and digits, and every byte of other characters.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:0x100] = True


def term_bins(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of every distinct hashed term of every text, in order of rows and bins."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _INSIDE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after[-1], after[:-1] = True, ~inside[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    lower = LOWER[data]
    row = np.searchsorted(at, start, side="right") - 1
    keys = [row * BINS + (range_hashes(lower, start, end) % U64(BINS // 2)).astype(np.int64)]
    for size in PREFIXES:
        long = np.flatnonzero(end - start > size)
        heads = range_hashes(lower, start[long], start[long] + size) % U64(BINS // 2) + U64(BINS // 2)
        keys.append(row[long] * BINS + heads.astype(np.int64))
    keys = np.unique(np.concatenate(keys))
    return keys // BINS, keys % BINS


def likelihood_ratio(held: np.ndarray, count: np.ndarray, positive: int, n: int) -> np.ndarray:
    """Of label and presence (chi-square scale), from the positive rows and all rows that hold a term; sound for terms that one label never has."""
    tie = np.zeros(np.shape(count))
    for own, out_of in ((held, positive), (count - held, n - positive)):
        for cell, share in ((own, count), (out_of - own, n - count)):
            tie += cell * np.log(np.maximum(cell, 1e-300) * n / np.maximum(share * float(out_of), 1e-300))
    return 2 * tie


def paired_terms(x: np.ndarray, positive: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Columns of ``x`` (rows by terms, 0 or 1) that tell more in some pair than the pair's terms do singly, best first."""
    n, total = len(x), int(positive.sum())
    with_label, best = x[positive], np.full(x.shape[1], -np.inf)
    for k in range(0, x.shape[1], 256):
        both, held = (x[:, k : k + 256].T @ x).astype(np.float64), (with_label[:, k : k + 256].T @ with_label).astype(np.float64)
        gain = likelihood_ratio(held, both, total, n) - single[k : k + 256, None] - single[None, :]
        gain[np.arange(len(gain)), np.arange(k, k + len(gain))] = -np.inf
        best[k : k + 256] = gain.max(axis=1, initial=-np.inf)
    order = np.argsort(-best, kind="stable")
    return order[best[order] >= LEAST_GAIN][:PAIRED]


def presence(rows: np.ndarray, bins: np.ndarray, n: int, slot: np.ndarray) -> np.ndarray:
    """Rows by the sorted bins ``slot``, 1 where a row holds the bin."""
    x = np.zeros((n, len(slot)), np.float32)
    if len(slot):
        at = np.minimum(np.searchsorted(slot, bins), len(slot) - 1)
        held = slot[at] == bins
        x[rows[held], at[held]] = 1
    return x


@dataclass
class FactorizationMachine:
    slot: np.ndarray  # sorted bins that have weights
    weight: np.ndarray
    factor: np.ndarray  # len(slot) x FACTORS
    bias: float

    @classmethod
    def fit(cls, rows: np.ndarray, bins: np.ndarray, labels: np.ndarray, terms: int = TERMS, factors: int = FACTORS, rounds: int = ROUNDS) -> FactorizationMachine:
        n, positive = len(labels), labels > 0
        total = np.bincount(bins, minlength=BINS)
        with_label = np.bincount(bins[positive[rows]], minlength=BINS)
        seen = np.flatnonzero(total >= 3)
        tie = likelihood_ratio(with_label[seen].astype(float), total[seen].astype(float), int(positive.sum()), n)
        by_tie = np.lexsort((seen, -tie))
        slot = seen[by_tie[: max(FEW_TERMS, int((tie >= LEAST_TIE).sum()))]][:terms]
        varied = np.minimum(total[seen], n - total[seen])
        some = np.sort(np.lexsort((seen, -varied))[:PAIR_TERMS])
        some = some[varied[some] >= 8]
        if len(some):
            slot = np.concatenate((slot, seen[some[paired_terms(presence(rows, bins, n, seen[some]), positive, tie[some])]]))
        slot = np.unique(slot)
        x = presence(rows, bins, n, slot)
        rate = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        theta = [np.array([np.log(rate / (1 - rate))], np.float32), np.zeros(len(slot), np.float32), (np.random.default_rng(0).standard_normal((len(slot), factors)) * 0.02).astype(np.float32)]
        decay, moments = (0.0, 5e-5, 5e-4), [(np.zeros_like(t), np.zeros_like(t)) for t in theta]
        xt = np.ascontiguousarray(x.T)
        for step in range(1, rounds + 1):
            sums = x @ theta[2]
            logit = theta[0] + x @ theta[1] + 0.5 * ((sums**2).sum(axis=1) - x @ (theta[2] ** 2).sum(axis=1))
            error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / n).astype(np.float32)
            pull = xt @ error
            gradients = [np.array([error.sum()], np.float32), pull, xt @ (error[:, None] * sums) - theta[2] * pull[:, None]]
            for t, g, (m, v), l2 in zip(theta, gradients, moments, decay):
                g = g + l2 * t
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                t -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(slot, theta[1], theta[2], float(theta[0][0]))

    def score(self, n: int, rows: np.ndarray, bins: np.ndarray) -> np.ndarray:
        if not len(self.slot):
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        at = np.minimum(np.searchsorted(self.slot, bins), len(self.slot) - 1)
        held = self.slot[at] == bins
        rows, at = rows[held], at[held]
        linear = np.bincount(rows, self.weight[at], n)
        pairs = np.zeros(n)
        for k in range(self.factor.shape[1]):
            f = self.factor[at, k].astype(np.float64)
            pairs += np.bincount(rows, f, n) ** 2 - np.bincount(rows, f * f, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + 0.5 * pairs, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Learn from the labels whose row satisfies ``learn``; hashed terms, not texts, come to the driver."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1), BLOCK_BYTES, BLOCK_ROWS):
                row, bins = term_bins(data, at)
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                packed = [bins[a:b].astype("<i4").tobytes() for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(packed, pa.binary())], ["id", "label", "terms"])

    sample = labelled_sample(docs, labels, label_col, learn, sample_rows, id_col, text_col).select("id", "text", "label")
    got = sample.mapInArrow(terms, "id long, label int, terms binary").toArrow().sort_by("id").slice(0, sample_rows)
    known = np.array(got.column("label").to_pylist(), np.float32)
    if not len(known):
        return FactorizationMachine(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32), -30.0)
    sets = [np.frombuffer(x.as_py(), "<i4") for x in got.column("terms")]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return FactorizationMachine.fit(rows, np.concatenate(sets).astype(np.int64), known)


def score_toxicity(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1), BLOCK_BYTES, BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(shared.value.score(hi - lo, *term_bins(data, at)), pa.float64())], ["id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text")).mapInArrow(score, "id long, score double")
