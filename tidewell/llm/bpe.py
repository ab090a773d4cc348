"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that its encoding ends
with.  A token t that ends at byte i is that token exactly if the last token u
of the prefix before t stays next to t when u + t is encoded on its own: BPE is
local, so a sequence is the encoding of its bytes if and only if each adjacent
pair is the encoding of its own bytes.  Hence one table entry per byte is
enough to encode, to append to a piece exactly, and to re-encode after an edit
from the first byte that changed.

Texts are first cut into pieces by the tokenizer's pattern; each piece is
encoded on its own and pieces are remembered in a bounded cache.

Defined cases: null text is the empty text and has no tokens; texts of any
length are encoded whole, in time linear in their bytes; control strings are
ordinary text; decoding is bytes and need not be valid UTF-8; equal rows give
equal results, and other columns are not read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_null
from .vec import range_hashes, slices


#: The public vocabulary that the queries use.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces that a worker remembers; then it starts over.
CACHE_PIECES = 500_000
#: Token pairs of which it remembers whether they can be neighbours.
CACHE_PAIRS = 500_000
#: A piece longer than this is not worth remembering.
CACHE_BYTES = 64
#: Bytes of output that a worker gathers before it hands them on.
OUT_BYTES = 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_NEVER = 1 << 62


def merge_encode(piece: bytes, ranks: dict[bytes, int], parts_of: bool = False) -> list[int]:
    """BPE by its definition: merge the leftmost pair of least rank until none is left (with ``parts_of``, until two parts are left)."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1 + parts_of:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if rank == _NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[x] for x in parts]


def unmade_tokens(ranks: dict[bytes, int]) -> frozenset[int]:
    """Tokens that the merges never arrive at."""
    return frozenset(rank for token, rank in ranks.items() if merge_encode(token, ranks) != [rank])


class PrefixEncoder:
    """Encoder over one vocabulary.  All 256 single bytes must be tokens.

    An Aho-Corasick automaton names the tokens that end at each byte.  Tokens
    that merging never makes (``unmade``) can only stand for a whole piece and
    are left out of it.
    """

    def __init__(self, ranks: dict[bytes, int], unmade: frozenset[int] | None = None):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.unmade = unmade_tokens(ranks) if unmade is None else unmade
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank not in self.unmade:
                self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        self.longest = max(map(len, ranks))
        self._pairs: dict[int, bool] = {}
        self._ends: dict[int, tuple | None] = {}

    def _spines(self, token: int) -> tuple:
        """What the token's right end and left end look like as merging goes on: [(bytes, rank at which it goes)].

        None if a part of the token outranks it, as no trained vocabulary has.
        """
        known = self._ends.get(token, 0)
        if known == 0:
            own = self.tokens[token]
            if len(own) == 1:
                known = [(own, _NEVER)], [(own, _NEVER)]
            else:
                left, right = merge_encode(own, self.ranks, parts_of=True)
                a, b = self._spines(left), self._spines(right)
                if a is None or b is None or max(left if len(self.tokens[left]) > 1 else -1, right if len(self.tokens[right]) > 1 else -1) > token:
                    known = None
                else:
                    known = [*b[0][:-1], (b[0][-1][0], token), (own, _NEVER)], [*a[1][:-1], (a[1][-1][0], token), (own, _NEVER)]
            self._ends[token] = known
        return known

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joined bytes.

        They are not if, at some moment of merging both, the right end of the
        one and the left end of the other make a token that comes before the
        next merge of either (the leftmost of equal rank goes first).
        """
        known = self._pairs.get(left << 32 | right)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            a, b = self._spines(left), self._spines(right)
            if a is None or b is None:
                known = merge_encode(self.tokens[left] + self.tokens[right], self.ranks) == [left, right]
            else:
                ends, begins, i, j, rank = a[0], b[1], 0, 0, self.ranks.get
                known = True
                while True:
                    (x, until), (y, til) = ends[i], begins[j]
                    across = rank(x + y, _NEVER)
                    if across < until and across <= til and across != _NEVER:
                        known = False
                        break
                    if until == til == _NEVER:
                        break
                    if until <= til:
                        i += 1
                    else:
                        j += 1
            self._pairs[left << 32 | right] = known
        return known

    def prefixes(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """Last token of each non-empty prefix; ``last`` holds those already known."""
        last = [] if last is None else last
        have, pairs = len(last), self._pairs
        # tokens that end after the known part may begin up to `longest` bytes earlier
        skip = max(0, have - self.longest)
        for end, (token, size) in self.ends.iter(piece[skip:].decode("latin-1")):
            end += skip + 1
            if end <= len(last):
                continue  # this prefix has its token already
            if size == end or pairs.get(last[end - size - 1] << 32 | token) or self.adjacent(last[end - size - 1], token):
                last.append(token)
        return last

    def read(self, last: list[int], end: int | None = None) -> list[int]:
        """The tokens of the prefix of ``end`` bytes, from the table."""
        end, out = len(last) if end is None else end, []
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.read(self.prefixes(piece))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EncodedPiece:
    """One piece with its prefix table, to be appended to and edited."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, data, encoder.prefixes(data)

    def append(self, more: bytes) -> EncodedPiece:
        self.data += more
        self.encoder.prefixes(self.data, self.last)
        return self

    def edit(self, start: int, end: int, new: bytes) -> EncodedPiece:
        """Replace bytes start..end; entries before ``start`` stay valid."""
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        self.encoder.prefixes(self.data, self.last)
        return self

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.get(self.data)
        return [whole] if whole is not None else self.encoder.read(self.last)


#: The pattern that the vectorised splitter implements; any other one is left to ``regex``.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: Code points of Unicode's White_Space.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point; made once per worker."""
    if not _classes:
        out = np.full(0x110000, _OTHER, np.uint8)
        for lo in range(0, 0x110000, 0x8000):
            part = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "." for c in range(lo, lo + 0x8000))
            for pattern, value in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER)):
                for m in regex.finditer(pattern, part):
                    out[lo + m.start() : lo + m.end()] = value
        out[WHITE_SPACE] = _SPACE
        _classes.append(out)
    return _classes[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each character's first byte, and its code point, of valid UTF-8."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead]
    point = first.astype(np.int32)
    for low, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        of = np.flatnonzero((first >= low) & (first < (low | 0xF0 if more == 3 else low + (0x20 if more == 1 else 0x10))) if more < 3 else first >= low)
        if len(of):
            x = (first[of] & bits).astype(np.int32)
            for k in range(1, more + 1):
                x = (x << 6) | (data[lead[of] + k] & 0x3F)
            point[of] = x
    return lead, point


def split_known(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Start of each piece of the known pattern in rows ``at`` of ``data``; pieces cover all bytes."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead, point = code_points(data)
    kind = char_classes()[point]
    n = len(kind)
    row = np.zeros(n + 1, bool)  # a row starts at this character
    row[np.searchsorted(lead, at)] = True
    row[n] = True
    start = np.empty(n, bool)
    start[0], start[1:] = True, kind[1:] != kind[:-1]
    start |= row[:n]
    # white space before something else: its last character is not part of the run
    space = kind == _SPACE
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~row[1:n]
    start |= last
    # and a plain blank there belongs to what follows
    joined = np.flatnonzero(last & (point == 0x20)) + 1
    start[joined] = False
    # contractions: an apostrophe that is a run of its own, with the letters after it
    quote = np.flatnonzero((point == 0x27) & start)
    quote = quote[quote + 1 < n]
    for q in quote[(kind[quote + 1] == _LETTER) & ~row[quote + 1]].tolist():
        a, b = int(point[q + 1]), int(point[q + 2]) if q + 2 < n and not row[q + 2] else 0
        size = 1 if a in (0x73, 0x74, 0x6D, 0x64) else 2 if (a, b) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)) else 0
        if size:
            start[q + 1 : q + 1 + size] = False
            if q + 1 + size < n and kind[q + 1 + size] == _LETTER:
                start[q + 1 + size] = True
    return lead[start]


class TextEncoder:
    """Whole columns of texts: pieces, a cache of pieces, ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, unmade: frozenset[int] | None = None):
        self.encoder, self.pattern = PrefixEncoder(ranks, unmade), pattern
        self.find = regex.compile(pattern).findall
        self.cache: dict[bytes, bytes] = {}

    def piece(self, raw: bytes) -> bytes:
        ids = self.cache.get(raw)
        if ids is None:
            tokens = self.encoder.encode_piece(raw)
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(raw) <= CACHE_BYTES:
                if len(self.cache) >= CACHE_PIECES:
                    self.cache.clear()
                self.cache[raw] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Token ids of one text as little-endian unsigned 32-bit integers."""
        if self.pattern != KNOWN_PATTERN:
            return b"".join(self.piece(x.encode("utf-8")) for x in self.find(text))
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        return self.encode_rows(data, np.array([0, len(data)]))[0]

    def encode_rows(self, data: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Ids of each row.  Equal pieces are found by hash, compared byte by byte, and encoded once."""
        start = split_known(data, at)
        if not len(start):
            return [b""] * (len(at) - 1)
        end = np.append(start[1:], len(data))
        _, one, same = np.unique(range_hashes(data, start, end), return_index=True, return_inverse=True)
        size = end - start
        rep = one[same]
        if not (size[rep] == size).all() or not (data[np.repeat(start[rep] - start, size) + np.arange(len(data))] == data).all():
            one = same = np.arange(len(start))  # two pieces share a hash: take each on its own
        raw = data.tobytes()
        known = [self.piece(raw[a:b]) for a, b in zip(start[one].tolist(), end[one].tolist())]
        count = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, base = np.frombuffer(b"".join(known), "<u4"), np.cumsum(count) - count
        each = count[same]
        stop = np.cumsum(each)
        ids = flat[np.repeat(base[same] - (stop - each), each) + np.arange(stop[-1])]
        first = np.searchsorted(start, at)  # rows' first pieces
        edge = np.append(0, stop)[first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]


_workers: dict[str, TextEncoder] = {}


def text_encoder(vocabulary: dict[bytes, int], unmade: frozenset[int], pattern: str) -> TextEncoder:
    """The encoder that this worker keeps for the pattern; made anew for another vocabulary."""
    worker = _workers.get(pattern)
    if worker is None or worker.encoder.ranks != vocabulary:
        worker = _workers[pattern] = TextEncoder(vocabulary, pattern, unmade)
    return worker


def _batches(columns: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows, all fields but two of each being bytes, in batches of bounded size."""
    held, size = [], 0
    for row in columns:
        held.append(row)
        size += sum(map(len, row[2:])) + 64
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names)


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Each rank's token."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode_ids(table: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def bpe_encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, n_tokens, token_ids): ids are packed little-endian uint32, the layout that training readers map.

    The vocabulary is broadcast; it is a fixed file whose size does not depend on the data.
    With ``decoded`` there is also what ``bpe_decode`` makes of the ids, in the
    same worker: a second step of its own would double a task's workers, and as
    Spark deals workers out anew, each would come to hold an encoder's caches.
    """
    shared = df.sparkSession.sparkContext.broadcast((ranks, unmade_tokens(ranks)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, unmade = shared.value
        worker = text_encoder(vocabulary, unmade, pattern)

        def rows():
            for batch in batches:
                keys = batch.column(0).to_pylist()
                if pattern != KNOWN_PATTERN:
                    yield from ((i, len(ids) // 4, ids) for i, text in zip(keys, batch.column(1)) for ids in [worker.encode(text.as_py())])
                    continue
                for lo, _, data, at in slices(batch.column(1)):
                    yield from ((keys[lo + k], len(ids) // 4, ids) for k, ids in enumerate(worker.encode_rows(data, at)))

        if decoded:
            table = token_table(vocabulary)
            yield from _batches(((*row, decode_ids(table, row[-1])) for row in rows()), ["id", "n_tokens", "token_ids", "decoded"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])
        else:
            yield from _batches(rows(), ["id", "n_tokens", "token_ids"], [pa.int64(), pa.int64(), pa.binary()])

    made = "id long, n_tokens long, token_ids binary" + ", decoded binary" * decoded
    return df.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text")).mapInArrow(encode, made)


def bpe_decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded``, the bytes of ``token_ids``, to (id, n_tokens, token_ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(shared.value)

        def rows():
            for batch in batches:
                for i, n, ids in zip(*(batch.column(c).to_pylist() for c in range(2)), batch.column(2)):
                    ids = ids.as_py()
                    yield i, n, ids, decode_ids(table, ids)

        yield from _batches(rows(), ["id", "n_tokens", "token_ids", "decoded"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    return encoded.select("id", "n_tokens", "token_ids").mapInArrow(decode, "id long, n_tokens long, token_ids binary, decoded binary")
