"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a normal form: letters lower-cased, every run of other
ASCII characters one blank.  A test item of m bytes may be leaked with up to
``rate * m`` edits.  It is cut into one piece more than that: edits can touch
only so many pieces, so some piece appears unchanged in any leak.  The pieces
are filed under their first eight bytes; one look at the eight bytes of every
place of a document, all places at once, finds all hits of all pieces.  Around
a hit the stretch must share enough 4-grams with the item (k edits spoil at most
4 k of them); then Myers' bit-parallel algorithm (1999) gives the least edit
distance of the whole item to any stretch of the document.

Items shorter than ``min_chars`` in normal form are searched without edits, as
whole words; those shorter than SHORT_CHARS say nothing about a document and
are not searched: ``unsearched_items`` reports them.

Defined cases: null and empty texts and items hold nothing; equal items are
each reported; a document is searched whole; several leaks of one item in a
document give one row, the closest; ids may repeat and then each row is judged
on its own; no items or no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, no_null
from .vec import U64, slices

EDIT_RATE = 0.08
MIN_CHARS = 40
SHORT_CHARS = 12
#: Bytes of test items that are broadcast and searched at a time (an index takes about five times that); more come in further passes.
BLOCK_BYTES = 8 << 20
GRAM = 4

_NORMAL = np.full(256, 0x20, np.uint8)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _NORMAL[_c] = _c
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)


def normal_bytes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end): the normal form of row k is bytes[start[k]:end[k]]."""
    if not len(data):
        zero = np.zeros(len(at) - 1, np.int64)
        return data, zero, zero
    out = _NORMAL[data]
    # capitals of Latin-1 (second byte 80..9E after C3, but for the times sign)
    capital = np.flatnonzero((out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[capital] += 0x20
    blank = out == 0x20
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[at[:-1][at[:-1] < len(out)]] = True
    new = np.concatenate(([0], np.cumsum(keep)))[at]
    out = out[keep]
    start, end = new[:-1].copy(), new[1:].copy()
    some = np.flatnonzero(end > start)
    start[some] += out[start[some]] == 0x20
    some = np.flatnonzero(end > start)
    end[some] -= out[end[some] - 1] == 0x20
    return out, start, end


def normalise(text: str) -> str:
    """Normal form of a text, as one character per UTF-8 byte."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    out, start, end = normal_bytes(data, np.array([0, len(data)]))
    return out[start[0] : end[0]].tobytes().decode("latin-1")


def least_distance(item: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best stretch of ``text`` within ``most`` edits of ``item``; the first of equals."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(xh | plus))
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(xv | up)), up & xv
        if score <= most and (best is None or score < best[0]):
            best = score, j + 1
    return best


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def _grams(data: np.ndarray) -> np.ndarray:
    return (_lanes(data)[: max(0, len(data) - GRAM + 1)] & U64((1 << 8 * GRAM) - 1)).astype(np.uint32)


class LeakFinder:
    """Pieces of test items (id, normal form), filed under their heads."""

    def __init__(self, items: list[tuple], rate: float, min_chars: int = MIN_CHARS):
        self.items = [(n, text.encode("latin-1")) for n, text in items]
        self.whole = [len(text) < min_chars for _, text in items]  # found without edits, as whole words
        self.budget = [0 if short else int(rate * len(text)) for (_, text), short in zip(items, self.whole)]
        owners: dict[bytes, list] = {}
        for n, (_, text) in enumerate(self.items):
            parts = self.budget[n] + 1
            cuts = [len(text) * k // parts for k in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    owners.setdefault(text[a:b], []).append((n, a))
        self.pieces, self.owners = list(owners), list(owners.values())
        self.heads: list[tuple] = []
        sizes = np.array([min(8, len(p)) for p in self.pieces], np.int64)
        for size in sorted(set(sizes.tolist())):
            own = np.flatnonzero(sizes == size)
            head = np.frombuffer(b"".join(self.pieces[k][:size].ljust(8, b"\0") for k in own), "<u8")
            by_head = np.argsort(head, kind="stable")
            head, own = head[by_head], own[by_head]
            bits = min(24, max(16, int(len(own) * 8).bit_length()))
            table = np.zeros(1 << bits, bool)
            table[self._slot(head, bits)] = True
            self.heads.append((size, U64((1 << 8 * size) - 1), head, own, bits, table))
        self.grams: dict[int, np.ndarray] = {}

    @staticmethod
    def _slot(head: np.ndarray, bits: int) -> np.ndarray:
        return ((head * U64(0x9E3779B97F4A7C15)) >> U64(64 - bits)).astype(np.int64)

    def _hits(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, piece) of every piece in the bytes."""
        lanes, raw = _lanes(data), data.tobytes()
        for size, mask, head, own, bits, table in self.heads:
            here = lanes[: max(0, len(data) - size + 1)] & mask
            at = np.flatnonzero(table[self._slot(here, bits)])
            lo, hi = np.searchsorted(head, here[at], "left"), np.searchsorted(head, here[at], "right")
            some = hi > lo
            for place, a, b in zip(at[some].tolist(), lo[some].tolist(), hi[some].tolist()):
                for k in own[a:b].tolist():
                    piece = self.pieces[k]
                    if len(piece) <= 8 or raw.startswith(piece, place):
                        yield place, k

    def _enough(self, n: int, stretch: np.ndarray) -> bool:
        """Whether the stretch has as many of the item's 4-grams as a leak must."""
        item = self.items[n][1]
        need = len(item) - GRAM + 1 - GRAM * self.budget[n]
        if need <= 0:
            return True
        if n not in self.grams:
            if len(self.grams) > 10_000:
                self.grams.clear()
            self.grams[n] = np.unique(_grams(np.frombuffer(item, np.uint8)))
        own, here = self.grams[n], _grams(stretch)
        return int((own[np.minimum(np.searchsorted(own, here), len(own) - 1)] == here).sum()) >= need

    def search_rows(self, data: np.ndarray, at: np.ndarray, any_one: bool = False) -> list[list[tuple]]:
        """For each row (item, distance, end) of each item that it leaks, or of one of them; ``end`` is a place in the normal form."""
        normal, start, end = normal_bytes(data, at)
        out: list[list[tuple]] = [[] for _ in range(len(at) - 1)]
        found = list(self._hits(normal)) if self.pieces and len(normal) else []
        if not found:
            return out
        rows = np.searchsorted(start, np.array([p for p, _ in found]), side="right") - 1
        begins: dict[tuple[int, int], set[int]] = {}
        for (place, k), row in zip(found, rows.tolist()):
            # empty rows share their start with the next: the last of them is the one that holds the place
            if row >= 0 and place + len(self.pieces[k]) <= end[row]:
                for n, offset in self.owners[k]:
                    begins.setdefault((row, n), set()).add(place - offset)
        for (row, n), places in sorted(begins.items()):
            if any_one and out[row]:
                continue
            best = self._closest(normal, int(start[row]), int(end[row]), n, sorted(places))
            if best:
                out[row].append((self.items[n][0], best[0], best[1] - int(start[row])))
        return out

    def _closest(self, normal: np.ndarray, first: int, last: int, n: int, at: list[int]) -> tuple[int, int] | None:
        item, most, best, i = self.items[n][1], self.budget[n], None, 0
        if self.whole[n]:
            for p in at:
                q = p + len(item)
                if p >= first and q <= last and (p == first or normal[p - 1] == 0x20) and (q == last or normal[q] == 0x20) and normal[p:q].tobytes() == item:
                    return 0, q
            return None
        while i < len(at):  # windows that overlap are searched as one
            lo = hi = at[i]
            while i < len(at) and at[i] <= hi + len(item) + 2 * most:
                hi = at[i]
                i += 1
            a, b = max(first, lo - most), min(last, hi + len(item) + most)
            if b - a < len(item) - most or not self._enough(n, normal[a:b]):
                continue
            stretch = normal[a:b].tobytes()
            exact = stretch.find(item)
            hit = (0, exact + len(item)) if exact >= 0 else least_distance(item.decode("latin-1"), stretch.decode("latin-1"), most)
            if hit and (best is None or hit[0] < best[0]):
                best = hit[0], a + hit[1]
        return best

    def search(self, text: str) -> list[tuple]:
        """(item, distance, end) for each item that a text in normal form leaks."""
        data = np.frombuffer(text.encode("latin-1"), np.uint8)
        return self.search_rows(data, np.array([0, len(data)]))[0]


_finders: dict[str, LeakFinder] = {}


def _finder(key: str, shared, rate: float, min_chars: int) -> LeakFinder:
    """The index of a broadcast block, made once by each Python worker, which keeps the last two."""
    if key not in _finders:
        while len(_finders) > 1:
            del _finders[next(iter(_finders))]
        _finders[key] = LeakFinder(shared.value, rate, min_chars)
    return _finders[key]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Test items in normal form, in blocks that are small enough to broadcast; one block at a time is on the driver."""
    block: list[tuple] = []
    size = 0
    for item, text in benchmark.select(F.col(item_col).cast("long"), no_null(text_col)).orderBy(item_col).toLocalIterator():
        text = normalise(text)
        if len(text) < SHORT_CHARS:
            continue
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    yield block


def unsearched_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, chars) of the items that are too short to be searched, with the size of their normal form."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.array([len(normalise(t)) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size], ["item_id", "chars"])

    return benchmark.select(F.col(item_col).cast("long").alias("item_id"), no_null(text_col).alias("text")).mapInArrow(judge, "item_id long, chars long").where(F.col("chars") < SHORT_CHARS)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = EDIT_RATE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows that leak no item, with all their columns."""
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        if block:
            shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

            def make_judge(shared=shared, key=key):
                finder = _finder(key, shared, rate, min_chars)
                return lambda texts: np.array([not hits for _, _, data, at in slices(texts) for hits in finder.search_rows(data, at, any_one=True)], bool)

            docs = filter_rows(docs, text_col, make_judge)
    return docs


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    rate: float = EDIT_RATE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, distance, end) for each document and item that it leaks.

    Items are broadcast in blocks of at most ``block_bytes`` (one item at
    least), each block a pass over the documents.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_null(text_col).alias("text"))
    out = None
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            finder = _finder(key, shared, rate, min_chars)
            for batch in batches:
                rows, ids = [], batch.column(0)
                for lo, _, data, at in slices(batch.column(1)) if finder.items else ():
                    for k, hits in enumerate(finder.search_rows(data, at)):
                        rows += [(ids[lo + k].as_py(), *hit) for hit in hits]
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "end"])

        part = source.mapInArrow(search, "doc_id long, item_id long, distance long, end long")
        out = part if out is None else out.unionByName(part)
    return out
