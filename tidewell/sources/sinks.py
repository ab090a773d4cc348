"""Sinks for bytes: packs, extracted members, and direct downloads.

Each task writes to a file beside its target, flushes it to the disk, and
renames it; what a lost task leaves is a partial file that nobody reads and
the next attempt replaces.  A pack is the exception: its partial file is kept
and gone on with from its last checkpoint.  Sources are read through
``RangeReader``, so every reply's range, size and ETag are checked whatever
the client is.  Targets lie on storage that all tasks share.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import zlib
from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import ArchiveError
from .ranges import FileClient, RangeReader
from .tar import check_name

JPEG_START, JPEG_END = b"\xff\xd8", b"\xff\xd9"


def safe_target(root: str, relative: str) -> str:
    """Absolute path below ``root``; refuses unsafe names and links that lead out."""
    check_name(relative)
    path = os.path.join(os.path.realpath(root), relative)
    if os.path.realpath(os.path.dirname(path)) != os.path.dirname(path) or os.path.islink(path):
        raise ArchiveError(f"{relative!r} leads through a link")
    return path


def write_whole(path: str, parts: Iterable[bytes]) -> None:
    """Write, flush, rename.  The name is a task's own, so attempts do not meet."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    partial = f"{path}.{os.getpid()}-{time.monotonic_ns()}.partial"
    try:
        with open(partial, "wb") as f:
            for part in parts:
                f.write(part)
            f.flush()
            os.fsync(f.fileno())
        os.replace(partial, path)
        folder = os.open(os.path.dirname(path), os.O_RDONLY)
        os.fsync(folder)
        os.close(folder)
    finally:
        if os.path.exists(partial):
            os.unlink(partial)


def check_jpeg(data: bytes, name: str, sha256: str | None = None) -> str:
    if not data.startswith(JPEG_START) or not data.endswith(JPEG_END):
        raise ArchiveError(f"{name!r} is not a whole JPEG")
    digest = hashlib.sha256(data).hexdigest()
    if sha256 and digest != sha256:
        raise ArchiveError(f"{name!r}: SHA-256 differs")
    return digest


STORAGE = "archive_key string, member_name string, destination string, storage_kind string, storage_path string, pack_offset bigint, payload_size bigint, sha256 string, header_offset bigint, data_offset bigint"


#: Payloads after which a pack is flushed and its state written.
CHECKPOINT = 500


def _sync_folder(path: str) -> None:
    folder = os.open(os.path.dirname(path), os.O_RDONLY)
    os.fsync(folder)
    os.close(folder)


def append_pack(path: str, plan: list[tuple], fetch: Callable[[tuple], bytes], checkpoint: int = CHECKPOINT) -> list[str]:
    """Write a pack of payloads laid end to end; returns their hashes.  ``plan`` has (name, offset, size) in order.

    Bytes are flushed before the state that counts them, so what a crash
    leaves behind the state is cut off and written again, and all before it is
    kept.  A pack that is there already (a crash between its renaming and the
    ledger's status) is verified slice by slice instead of being written.
    """
    at = 0
    for name, offset, size in plan:
        if offset != at:
            raise ArchiveError(f"{path}: payloads do not tile at {name!r}")
        at += size
    identity = hashlib.sha256(json.dumps(plan).encode()).hexdigest()
    partial, state = f"{path}.partial", f"{path}.state"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if os.path.exists(path):
        if os.path.getsize(path) != at:
            raise ArchiveError(f"{path} is there with another size")
        with open(path, "rb") as f:
            return [check_jpeg(f.read(size), name) for name, _, size in plan]
    import fcntl

    with open(partial, "ab") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)  # another attempt of the task may still be running
        except OSError as error:
            raise ArchiveError(f"{path} is being written by another attempt") from error
        hashes: list[str] = []
        if os.path.exists(state):
            with open(state, encoding="utf-8") as held:
                kept = json.load(held)
            if kept["plan"] == identity and kept["bytes"] <= os.path.getsize(partial):
                hashes = kept["hashes"]
        done = sum(size for _, _, size in plan[: len(hashes)])
        f.truncate(done)
        f.seek(done)

        def keep() -> None:
            f.flush()
            os.fsync(f.fileno())
            write_whole(state, [json.dumps({"plan": identity, "bytes": f.tell(), "hashes": hashes}).encode()])

        for row in plan[len(hashes) :]:
            data = fetch(row)
            if len(data) != row[2]:
                raise ArchiveError(f"{row[0]!r}: {len(data)} bytes instead of {row[2]}")
            digest = check_jpeg(data, row[0])
            f.write(data)
            hashes.append(digest)
            if len(hashes) % checkpoint == 0:
                keep()
        keep()
        os.replace(partial, path)
        _sync_folder(path)
    os.unlink(state)
    return hashes


def write_packs(plan: DataFrame, source_root: str, pack_root: str, existing_root: str, client: Callable = FileClient, checkpoint: int = CHECKPOINT) -> DataFrame:
    """Write each archive's pack, one task an archive, in offset order; returns the plan's rows with hashes (member_storage).

    Payloads stream through one at a time, and an attempt goes on where the
    last one's checkpoint was.  A row that is kept in place is verified where
    it lies and nothing of it is fetched.  The plan may carry ``source_size``
    and ``etag`` of its archives: another object under the name is refused.
    """
    pins = [c for c in ("source_size", "etag") if c in plan.columns]

    def pack(batches):
        import pandas as pd

        def rows():
            for batch in batches:
                yield from batch.itertuples(index=False)

        source, done = client(source_root), []
        for (kind, path), part in groupby(rows(), key=lambda r: (r.storage_kind, r.storage_path if r.storage_kind == "pack" else "")):
            if kind == "pack":
                part = list(part)  # names and places, no payloads
                by_place = {int(r.pack_offset): r for r in part}
                reader = RangeReader(source, part[0].archive_key, size=getattr(part[0], "source_size", None), etag=getattr(part[0], "etag", None))
                steps = [(r.member_name, int(r.pack_offset), int(r.payload_size)) for r in part]
                hashes = append_pack(safe_target(pack_root, path), steps, lambda x: reader.read(int(by_place[x[1]].data_offset), x[2]), checkpoint)  # noqa: B023
                done = [(*r[:7], digest, r.header_offset, r.data_offset) for r, digest in zip(part, hashes)]
            else:
                for r in part:
                    with open(safe_target(existing_root, r.storage_path), "rb") as f:
                        done.append((*r[:7], check_jpeg(f.read(), r.storage_path), r.header_offset, r.data_offset))
            names = [c.split()[0] for c in STORAGE.split(", ")]
            yield pd.DataFrame(done, columns=names).astype({"pack_offset": "Int64"})
            done = []

    columns = ["archive_key", "member_name", "destination", "storage_kind", "storage_path", "pack_offset", "payload_size", "header_offset", "data_offset"]
    dealt = plan.select(*columns, *pins).repartition("archive_key").sortWithinPartitions("archive_key", "storage_kind", "pack_offset", "storage_path")
    return dealt.mapInPandas(pack, STORAGE)


def extract_members(rows: DataFrame, source_root: str, target_root: str, client: Callable = FileClient) -> DataFrame:
    """Write TAR members (archive_key, member_name, data_offset, member_size, path) to their paths; a file that is there is verified, not rewritten."""

    def extract(batches):
        import pandas as pd

        source, readers = client(source_root), {}
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.archive_key not in readers:
                    readers = {r.archive_key: RangeReader(source, r.archive_key)}
                data = readers[r.archive_key].read(int(r.data_offset), int(r.member_size))
                path, status = safe_target(target_root, r.path), "written"
                if os.path.exists(path):
                    with open(path, "rb") as f:
                        if f.read() != data:
                            raise ArchiveError(f"{r.path!r} is there with other bytes")
                    status = "verified"
                else:
                    write_whole(path, [data])
                out.append((r.path, len(data), zlib.crc32(data), hashlib.sha256(data).hexdigest(), status))
            yield pd.DataFrame(out, columns=["path", "size", "crc32", "sha256", "status"])

    return rows.select("archive_key", "member_name", "data_offset", "member_size", "path").mapInPandas(extract, "path string, size bigint, crc32 bigint, sha256 string, status string")


def download(jobs: DataFrame, target_root: str, client: Callable, attempts: int = 4, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Fetch direct-index rows (path, source_url, offset, size, sha256, identity); returns receipts (path, identity, sha256, requests, retries).

    Wrong bytes are final; a failing transport is tried again after 1, 2, 4, at
    most 8 seconds.  If the rows carry ``source_size`` and ``etag``, another
    object under the address is refused.
    """
    pins = [c for c in ("source_size", "etag") if c in jobs.columns]

    def fetch(batches):
        import pandas as pd

        readers: dict[str, RangeReader] = {}
        for batch in batches:
            source, out = client(), []
            for r in batch.itertuples(index=False):
                retries, before = 0, 0
                while True:
                    try:
                        if r.source_url not in readers:
                            size, etag = getattr(r, "source_size", None), getattr(r, "etag", None)
                            readers = {r.source_url: RangeReader(source, r.source_url, size=None if pd.isna(size) else int(size), etag=None if pd.isna(etag) else etag)}
                        else:
                            before = readers[r.source_url].requests
                        data = readers[r.source_url].read(int(r.offset), int(r.size))
                        break
                    except OSError:
                        retries += 1
                        if retries == attempts:
                            raise
                        wait(min(8.0, 2.0 ** (retries - 1)))
                digest = check_jpeg(data, r.path, r.sha256)
                write_whole(safe_target(target_root, r.path), [data])
                out.append((r.path, r.identity, digest, readers[r.source_url].requests - before, retries))
            yield pd.DataFrame(out, columns=["path", "identity", "sha256", "requests", "retries"])

    return jobs.select("path", "source_url", "offset", "size", "sha256", "identity", *pins).mapInPandas(fetch, "path string, identity string, sha256 string, requests bigint, retries bigint")


def still_good(receipts: DataFrame, hashes: DataFrame) -> DataFrame:
    """Receipts whose file is there with its hash: (path, sha256) of files decide what a later run skips."""
    return receipts.join(hashes.select("path", F.col("sha256").alias("now")), "path").where("now = sha256").drop("now")


def extract_databases(rows: DataFrame, source_root: str, target_root: str, client: Callable = FileClient) -> DataFrame:
    """Extract ZIP members (archive_key, member_name) below a folder under their base names; returns (path, size, crc32, status).

    A file that is there with the member's size and CRC is validated, not
    rewritten; one that differs is replaced.  Bytes stream to a file beside
    the target, and only one whose size and CRC agree gets its name.
    """

    def crc_of(path: str) -> int:
        crc = 0
        with open(path, "rb") as f:
            while part := f.read(1 << 20):
                crc = zlib.crc32(part, crc)
        return crc

    def extract(batches):
        import pandas as pd

        from .zips import ZipArchive

        source, held = client(source_root), {}
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.archive_key not in held:
                    archive = ZipArchive(source, r.archive_key)
                    held = {r.archive_key: (archive, {m.name: m for m in archive.members()})}
                archive, members = held[r.archive_key]
                member = members[r.member_name]
                path, status = safe_target(target_root, os.path.basename(r.member_name)), "extracted"
                if os.path.exists(path) and os.path.getsize(path) == member.size and crc_of(path) == member.crc32:
                    status = "validated"
                else:
                    write_whole(path, archive.stream(member))
                out.append((os.path.basename(r.member_name), member.size, member.crc32, status))
            yield pd.DataFrame(out, columns=["path", "size", "crc32", "status"])

    dealt = rows.select("archive_key", "member_name").repartition("archive_key").sortWithinPartitions("archive_key", "member_name")
    return dealt.mapInPandas(extract, "path string, size bigint, crc32 bigint, status string")


def move_packs(packs: DataFrame, source_root: str, target_root: str, delete_source: bool = False) -> DataFrame:
    """Copy packs (path, length) to another store, one task a pack; returns (path, length, sha256, verified).

    The copy is read again and its hash compared before the source may go.
    """

    def digest(path: str) -> str:
        whole = hashlib.sha256()
        with open(path, "rb") as f:
            while part := f.read(1 << 20):
                whole.update(part)
        return whole.hexdigest()

    def move(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                source, target = safe_target(source_root, r.path), safe_target(target_root, r.path)
                want = digest(source)
                if os.path.getsize(source) != r.length:
                    raise ArchiveError(f"{r.path!r}: the size differs from the listing")
                if not (os.path.exists(target) and digest(target) == want):
                    with open(source, "rb") as f:
                        write_whole(target, iter(lambda: f.read(1 << 20), b""))  # noqa: B023
                verified = digest(target) == want
                if not verified:
                    raise ArchiveError(f"{r.path!r}: the copy differs")
                if delete_source:
                    os.unlink(source)
                out.append((r.path, r.length, want, verified))
            yield pd.DataFrame(out, columns=["path", "length", "sha256", "verified"])

    return packs.select("path", "length").repartition("path").mapInPandas(move, "path string, length bigint, sha256 string, verified boolean")


def publish_release(files: Iterable[str], put: Callable[[str, bytes], None], get: Callable[[str], bytes]) -> list[dict]:
    """Upload files, fetch each again, and compare digests; ``put`` and ``get`` are the release host's."""
    out = []
    for path in files:
        with open(path, "rb") as f:
            data = f.read()
        name = os.path.basename(path)
        put(name, data)
        digest = hashlib.sha256(data).hexdigest()
        if hashlib.sha256(get(name)).hexdigest() != digest:
            raise ArchiveError(f"{name!r}: the uploaded file differs")
        out.append({"asset": name, "sha256": digest, "size": len(data)})
    return out


def png(pixels) -> bytes:
    """A PNG file of height by width by 3 unsigned bytes."""
    import struct

    height, width, _ = pixels.shape
    rows = b"".join(b"\0" + row.tobytes() for row in pixels)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def draw_panels(images: DataFrame, target_root: str) -> DataFrame:
    """One PNG for each (anchor_token, channel) of decoded images (position, height, width, pixels), frames from left to right; returns (path, frames, sha256)."""

    def draw(key, rows):
        import numpy as np
        import pandas as pd

        rows = rows.sort_values("position")
        frames = [np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 3) for r in rows.itertuples()]
        panel = np.zeros((max(f.shape[0] for f in frames), sum(f.shape[1] for f in frames), 3), np.uint8)
        at = 0
        for f in frames:
            panel[: f.shape[0], at : at + f.shape[1]] = f
            at += f.shape[1]
        data, path = png(panel), f"{key[0]}-{key[1]}.png"
        write_whole(safe_target(target_root, path), [data])
        return pd.DataFrame([(path, len(frames), hashlib.sha256(data).hexdigest())], columns=["path", "frames", "sha256"])

    columns = ["anchor_token", "channel", "position", "height", "width", "pixels"]
    return images.select(*columns).groupBy("anchor_token", "channel").applyInPandas(draw, "path string, frames bigint, sha256 string")
