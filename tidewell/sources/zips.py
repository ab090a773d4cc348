"""ZIP and ZIP64 central directories over byte ranges."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from ..errors import ArchiveError
from .ranges import RangeReader
from .tar import check_name

# Record layouts and signatures of the format (fixed values).
END, END64, LOCATOR, ENTRY, LOCAL, SIGNATURE = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4", b"PK\5\5"
ALL16, ALL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class ZipMember:
    name: str
    method: int
    flags: int
    crc32: int
    compressed_size: int
    size: int
    header_offset: int


def find_end(tail: bytes) -> int:
    """Where the end record starts whose comment ends with the object."""
    at = tail.rfind(END)
    while at >= 0:
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            return at
        at = tail.rfind(END, 0, at)
    raise ArchiveError("no end record")


def _wide(extra: bytes, values: list[int], limits: list[int]) -> list[int]:
    """Values at their limit are replaced, in order, from the ZIP64 extra field."""
    if all(v != limit for v, limit in zip(values, limits)):
        return values
    at, body = 0, None
    while at < len(extra):
        if at + 4 > len(extra):
            raise ArchiveError("malformed extra field")
        kind, size = struct.unpack_from("<HH", extra, at)
        if at + 4 + size > len(extra):
            raise ArchiveError("truncated extra field")
        if kind == 1:
            body = extra[at + 4 : at + 4 + size]
            break
        at += 4 + size
    if body is None:
        raise ArchiveError("ZIP64 values without their field")
    out, at = [], 0
    for value, limit in zip(values, limits):
        if value == limit:
            width = 4 if limit == ALL16 else 8
            if at + width > len(body):
                raise ArchiveError("ZIP64 field is too short")
            value, at = int.from_bytes(body[at : at + width], "little"), at + width
        out.append(value)
    return out


def parse_directory(data: bytes, count: int) -> Iterator[ZipMember]:
    """The entries of a central directory; nothing but a signature may follow them."""
    at, names = 0, set()
    for _ in range(count):
        if at + 46 > len(data) or data[at : at + 4] != ENTRY:
            raise ArchiveError(f"no entry at {at} of the directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, size, n, m, k, disk = struct.unpack_from("<IIIHHHH", data, at + 16)
        (header,) = struct.unpack_from("<I", data, at + 42)
        if at + 46 + n + m + k > len(data):
            raise ArchiveError("truncated entry")
        raw = data[at + 46 : at + 46 + n]
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        size, packed, header, disk = _wide(data[at + 46 + n : at + 46 + n + m], [size, packed, header, disk], [ALL32, ALL32, ALL32, ALL16])
        if disk:
            raise ArchiveError("archive on several disks")
        if not name or "\0" in name or name in names:
            raise ArchiveError(f"empty or repeated name {name!r}")
        names.add(name)
        yield ZipMember(name, method, flags, crc, packed, size, header)
        at += 46 + n + m + k
    rest = data[at:]
    if rest and not (rest[:4] == SIGNATURE and len(rest) >= 6 and len(rest) == 6 + struct.unpack_from("<H", rest, 4)[0]):
        raise ArchiveError("bytes behind the directory")


class ZipArchive:
    def __init__(self, client, url: str, chunk: int = 1 << 20, most_directory: int = 1 << 28, most_member: int = 8 << 30):
        self.reader, self.most = RangeReader(client, url, chunk), most_member
        size = self.reader.size
        start = max(0, size - 22 - ALL16 - 20)
        tail = self.reader.read(start, size - start)
        at = find_end(tail)
        disk, first, here, count, length, offset = struct.unpack_from("<HHHHII", tail, at + 4)
        limit = start + at
        self.zip64 = ALL16 in (here, count) or ALL32 in (length, offset)
        if self.zip64:
            if at < 20 or tail[at - 20 : at - 16] != LOCATOR:
                raise ArchiveError("no ZIP64 locator")
            _, where, disks = struct.unpack_from("<IQI", tail, at - 16)
            if disks != 1 or where + 56 > size:
                raise ArchiveError("bad ZIP64 locator")
            record = self.reader.read(where, 56)
            if record[:4] != END64:
                raise ArchiveError("no ZIP64 end record")
            disk, first, here, count, length, offset = struct.unpack_from("<IIQQQQ", record, 16)
            limit = where
        if disk or first or here != count:
            raise ArchiveError("archive on several disks")
        if length > most_directory or offset + length > limit:
            raise ArchiveError("directory out of bounds")
        self._members = list(parse_directory(self.reader.read(offset, length), count))

    def members(self) -> list[ZipMember]:
        return self._members

    def stream(self, member: ZipMember) -> Iterator[bytes]:
        """The member's bytes, a chunk at a time; size and CRC are checked before the last is handed on."""
        check_name(member.name)
        if member.flags & 1 or member.method not in (0, 8) or member.size > self.most:
            raise ArchiveError(f"{member.name!r} cannot be read")
        head = self.reader.read(member.header_offset, 30)
        flags, method = struct.unpack_from("<HH", head, 6)
        n, m = struct.unpack_from("<HH", head, 26)
        if head[:4] != LOCAL or method != member.method or (flags ^ member.flags) & 0x809 or self.reader.read(member.header_offset + 30, n).decode("utf-8" if flags & 0x800 else "cp437") != member.name:
            raise ArchiveError(f"{member.name!r}: the local header differs")
        at, left = member.header_offset + 30 + n + m, member.compressed_size
        inflate, crc, size, held = zlib.decompressobj(-15) if member.method == 8 else None, 0, 0, b""
        while True:
            raw = self.reader.read(at, min(left, self.reader.chunk))
            at, left = at + len(raw), left - len(raw)
            out = inflate.decompress(raw) if inflate else raw
            if not left and inflate:
                out += inflate.flush()
            crc, size = zlib.crc32(out, crc), size + len(out)
            if size > member.size:
                raise ArchiveError(f"{member.name!r} is longer than stated")
            if held:
                yield held
            held = out
            if not left:
                break
        if size != member.size or crc != member.crc32 or inflate and (not inflate.eof or inflate.unused_data):
            raise ArchiveError(f"{member.name!r}: size or CRC differs")
        yield held

    def read(self, member: ZipMember) -> bytes:
        return b"".join(self.stream(member))
