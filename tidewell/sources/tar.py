"""TAR archives as tables of members, by headers only.

Headers chain: the next one's place is known from the last one's size.  So a
walk is sequential within an archive and parallel across archives, and it can
start again from any header offset.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from ..errors import ArchiveError
from .ranges import RangeReader

BLOCK = 512
REGULAR = (b"0", b"\0")
EXTENSIONS = (b"x", b"g", b"L", b"K")


@dataclass(frozen=True)
class TarMember:
    name: str
    typeflag: str
    size: int
    header_offset: int
    data_offset: int
    next_header_offset: int


_UNSAFE = re.compile(r"[\\\x00]|^[A-Za-z]:|(^|/)\.{1,2}(/|$)|^/|//")


def check_name(name: str) -> str:
    """A relative path without empty, dot or dot-dot parts (one closing slash marks a directory)."""
    if not name.rstrip("/") or _UNSAFE.search(name.rstrip("/")):
        raise ArchiveError(f"unsafe member name {name!r}")
    return name


def number(field: bytes) -> int:
    """Octal text, or base-256 when the first bit is set."""
    if field[:1] and field[0] & 0x80:
        return int.from_bytes(bytes([field[0] & 0x7F]) + field[1:], "big")
    text = field.strip(b" \0")
    if not re.fullmatch(rb"[0-7]*", text):
        raise ArchiveError(f"bad number {field!r}")
    return int(text or b"0", 8)


def parse_header(block: bytes, offset: int, archive_size: int) -> TarMember:
    if len(block) != BLOCK:
        raise ArchiveError(f"header of {len(block)} bytes at {offset}")
    if sum(block[:148]) + 8 * 32 + sum(block[156:]) != number(block[148:156]):
        raise ArchiveError(f"checksum mismatch at {offset}")
    try:
        name, prefix = (block[a:b].split(b"\0", 1)[0].decode("utf-8") for a, b in ((0, 100), (345, 500)))
    except UnicodeDecodeError as error:
        raise ArchiveError(f"name at {offset} is not UTF-8") from error
    full = check_name("/".join(x for x in (prefix, name) if x))
    size = number(block[124:136])
    after = offset + BLOCK + -(-size // BLOCK) * BLOCK
    if after > archive_size:
        raise ArchiveError(f"{full!r} goes beyond the archive")
    return TarMember(full, block[156:157].decode("latin-1"), size, offset, offset + BLOCK, after)


class TarArchive:
    def __init__(self, client, url: str, chunk: int = 1 << 20):
        self.reader = RangeReader(client, url, chunk)

    def members(self, start: int = 0, most: int | None = None) -> Iterator[TarMember]:
        """Members from a header offset on; two zero blocks, or the end, close the archive."""
        at, seen = start, 0
        if at % BLOCK:
            raise ArchiveError(f"header offset {at} is not aligned")
        while at + BLOCK <= self.reader.size and (most is None or seen < most):
            block = self.reader.read(at, BLOCK)
            if not any(block):
                return
            if block[156:157] in EXTENSIONS:
                raise ArchiveError(f"extension header at {at}")
            member = parse_header(block, at, self.reader.size)
            yield member
            at, seen = member.next_header_offset, seen + 1

    def read(self, member: TarMember) -> bytes:
        if member.typeflag.encode("latin-1") not in REGULAR:
            raise ArchiveError(f"{member.name!r} is not a regular file")
        return self.reader.read(member.data_offset, member.size)
