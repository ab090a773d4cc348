"""Chat formatting in budgeted windows.

Token counts of a conversation's turns are summed up in turn order.  A turn
counts the tokens of its whole template, marks and role included, encoded with
the vocabulary; the tokenizer's pattern cuts pieces where a template ends and
the next begins, so a window has exactly the sum of its turns' tokens.  Windows
are spans of whole turns that fit the budget: each begins with the system turn
(if the conversation opens with one) and repeats as many of the turns before
it as the history budget takes.  Only turns that a window brings for the first
time are targets: an assistant turn's text lies under the loss mask exactly
once, and in later windows where it is history it is masked.

The template marks turns with control strings.  Where a text or role holds
such a string it is escaped by one backslash more behind its first character,
so reading back restores every text exactly.

Defined cases: turns are ordered by turn, role and text, and a null turn comes
first; null roles and texts are empty; a turn larger than the budget has a
window of its own with no history, never cut; rows of a null conversation id
are one conversation; no rows give no windows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import KNOWN_PATTERN, VOCABULARY, load_ranks, text_encoder, unmade_tokens
from .common import Workspace
from .vec import slices

BUDGET = 2048
HISTORY = 512
START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE, _PLAIN = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def template(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a turn."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def choose_windows(turns: Iterator[tuple], budget: int, history: int) -> Iterator[tuple]:
    """(turn, conversation, window, position, repeated) from (turn, conversation, tokens, is system), sorted within whole conversations.

    Spans are differences of the running prefix sum of tokens.  Only turns that
    a later window may repeat are held, so memory is bounded by the history
    budget, not by the conversation.
    """
    current, begun = None, False
    for turn, conv, tokens, is_system in turns:
        if not begun or conv != current:
            current, begun = conv, True
            window = position = total = opened = 0
            fresh = False  # the open window has a turn of its own
            system = (turn, tokens) if is_system else None
            recent: deque = deque()
        if fresh and total + tokens - opened > budget:
            window, fresh = window + 1, False
            kept = system[1] if system else 0
            limit = min(history, budget - kept - tokens)
            if system:
                yield system[0], conv, window, 0, True
            opened = total
            for name, place, before in recent:
                if total - before <= limit:
                    opened = min(opened, before)
                    yield name, conv, window, place, True
            opened -= kept
        yield turn, conv, window, position, False
        fresh = True
        if position or not system:
            recent.append((turn, position, total))
        total += tokens
        position += 1
        while recent and total - recent[0][2] > history:
            recent.popleft()


def _record(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(k, 256).columns))


def count_tokens(turns: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``tokens``, the number of tokens of a turn's template, to (row, conv_id, turn, role, text)."""
    shared, names = turns.sparkSession.sparkContext.broadcast((ranks, unmade_tokens(ranks))), [*turns.columns, "tokens"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = text_encoder(*shared.value, KNOWN_PATTERN)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                whole = pa.array(["".join(template(*x)) for x in zip(part.column(3).to_pylist(), part.column(4).to_pylist())], pa.large_string())
                tokens = [len(ids) // 4 for _, _, data, at in slices(whole) for ids in worker.encode_rows(data, at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tokens, pa.int64())], names)

    return turns.mapInArrow(count, "row long, conv_id long, turn long, role string, text string, tokens long")


def format_chats(df: DataFrame, budget: int = BUDGET, history: int = HISTORY, work: Workspace | None = None, ranks: dict[bytes, int] | None = None) -> DataFrame:
    """(conv_id, window, n_repeated, text, loss_start, loss_end): each window's text and the spans (code points) under its loss mask.

    Texts are dealt out by conversation and window, so a conversation of any
    length is formatted by many tasks; only its token counts, one small row a
    turn, pass through one.  Without ``ranks`` tokens are those of VOCABULARY.
    """
    if ranks is None:
        import public_tokenizers

        ranks = load_ranks(public_tokenizers.path(VOCABULARY))
    work = work or Workspace(df.sparkSession, "chat")
    turns = df.select(
        F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = work.keep(count_tokens(turns, ranks), "turns")
    small = turns.select("row", "conv_id", "turn", "role", F.xxhash64("text").alias("x"), "tokens")
    small = small.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "x", "row").select("row", "conv_id", "tokens", (F.col("role") == "system").alias("is_system"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = choose_windows(_rows(batches), budget, history)
        while part := list(islice(out, 50_000)):
            yield _record(part, ["row", "conv_id", "window", "position", "repeated"], [pa.int64()] * 4 + [pa.bool_()])

    placed = small.mapInArrow(place, "row long, conv_id long, window long, position long, repeated boolean")
    dealt = placed.join(turns.select("row", "role", "text"), "row").repartition(F.col("conv_id"), F.col("window"))
    dealt = dealt.sortWithinPartitions("conv_id", "window", "position").select("conv_id", "window", "repeated", "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (conv, window), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            parts, at, repeated, start, end = [], 0, 0, [], []
            for _, _, again, role, text in rows:
                head, body, tail = template(role, text)
                if again:
                    repeated += 1
                elif role == "assistant":
                    start.append(at + len(head))
                    end.append(at + len(head) + len(body))
                parts.append(f"{head}{body}{tail}")
                at += len(parts[-1])
            out.append((conv, window, repeated, "".join(parts), start, end))
            size += at
            if size > 4 << 20:
                yield _record(out, _NAMES, _TYPES)
                out, size = [], 0
        yield _record(out, _NAMES, _TYPES)

    return dealt.mapInArrow(write, "conv_id long, window long, n_repeated long, text string, loss_start array<long>, loss_end array<long>")


_NAMES = ["conv_id", "window", "n_repeated", "text", "loss_start", "loss_end"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the windows alone.

    A digest of a whole conversation has to see it in order: each is streamed
    through its task window by window, and never held.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, repeated, text, start, end in rows:
                size += len(text)
                for k, m in enumerate(_TURN.finditer(text)):
                    if k >= repeated:
                        n += 1
                        turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                for a, b in zip(start, end):
                    target = unescape(text[a:b])
                    chars += len(target)
                    loss.update(target.encode())
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
        yield _record(out, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window").select(*_NAMES)
    return ordered.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
