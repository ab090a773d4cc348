"""Hashing of whole text columns with numpy, on the buffers Arrow hands over.

Words and lines are byte ranges of the column's data buffer.  Words are hashed
eight bytes at a time, all words at once: each step mixes the next bytes into
the state with a permutation of 64 bits.  So two words of one length up to
eight bytes never share a hash, and others do with a chance of 2**-64, whatever
their bytes.  Long ranges, and the 128-bit keys of lines, are hashed by XXH3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
CHUNK = 1 << 19
#: Ranges up to this size are hashed all at once, longer ones singly.
SHORT = 64

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WS = np.zeros(256, bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32


LOWER = _LOWER.astype(np.uint8)
_MASK = (np.array([1], U64) << (np.arange(8, dtype=U64) * U64(8))) - U64(1)
_MASK = np.append(_MASK, ~U64(0))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of MurmurHash3 (public domain), on an array."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def slices(column, limit: int = CHUNK, rows: int = 1 << 14) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo..hi of the column with their bytes, about ``limit`` bytes and at most ``rows`` rows at a time.

    A row is never cut; one that is longer than the limit comes alone.
    """
    data, at = text_buffers(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of the bytes, as they are."""
    size = end - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = size.astype(U64) * U64(0x9E3779B97F4A7C15)
    live = np.flatnonzero((size > 0) & (size <= SHORT))
    done = 0
    while len(live):
        out[live] = mix(out[live] ^ (lanes[start[live] + done] & _MASK[np.minimum(size[live] - done, 8)]))
        done += 8
        live = live[size[live] > done]
    long = np.flatnonzero(size > SHORT)
    if len(long):
        raw = memoryview(data if data.flags.c_contiguous else np.ascontiguousarray(data))
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist())), U64, len(long))
    return out


def wide_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the 128-bit hash of each range."""
    raw = memoryview(data if data.flags.c_contiguous else np.ascontiguousarray(data))
    whole = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())])
    halves = np.frombuffer(whole, "<i8").reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def word_ranges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each row (n + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = ~WS[data]
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~word[:-1]
    before[at[:-1][at[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~word[1:]
    after[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(word & before)
    end = np.flatnonzero(word & after) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word with A-Z lower-cased, and where each row's words begin."""
    start, end, first = word_ranges(data, at)
    if not len(start):
        return np.zeros(0, U64), first
    return range_hashes(LOWER[data], start, end), first


_GRAM = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) > 1:
        values = values[np.concatenate(([True], values[1:] != values[:-1]))]
    return values


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles.

    A row with fewer words has its whole word sequence as the only member; a
    row without words has an empty set.
    """
    words, first = word_hashes(data, at)
    grams = np.zeros(max(0, len(words) - k + 1), U64)
    for i in range(k if len(grams) else 0):
        grams += words[i : i + len(grams)] * _GRAM[i]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(distinct(grams[a : b - k + 1]))
        elif b > a:
            short = np.sum(words[a:b] * _GRAM[8 : 8 + b - a], dtype=U64, keepdims=True) + np.full(1, b - a, U64)
            out.append(mix(short))
        else:
            out.append(np.zeros(0, U64))
    return out
