"""TAR and ZIP over byte ranges, the client contract, and the data source."""

import io
import struct
import tarfile
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.errors import ArchiveError
from tidewell.sources.archives import ArchiveMembers, read_payloads
from tidewell.sources.ranges import HttpClient, MemoryClient, RangeReader, parse_reply
from tidewell.sources.tar import TarArchive, check_name, number
from tidewell.sources.zips import ZipArchive, find_end

JPEG = b"\xff\xd8" + b"0123456789ab" + b"\xff\xd9"


def make_tar(files, kind=tarfile.USTAR_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=kind) as t:
        for name, data in files:
            info = tarfile.TarInfo(name)
            info.type = tarfile.DIRTYPE if data is None else tarfile.REGTYPE
            info.size = len(data or b"")
            t.addfile(info, io.BytesIO(data or b""))
    return out.getvalue()


def make_zip(files, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in files:
            z.writestr(name, data)
    return out.getvalue()


def test_tar_walk_and_read():
    client = MemoryClient({"a": make_tar([("d/", None), ("d/one.jpg", JPEG)])})
    archive = TarArchive(client, "a", chunk=1 << 20)
    members = list(archive.members())
    assert [(m.name.rstrip("/"), m.typeflag, m.size) for m in members] == [("d", "5", 0), ("d/one.jpg", "0", 16)]
    assert archive.read(members[1]) == JPEG
    assert len(client.requests) == 2  # the probe, and one chunk for everything
    assert all(etag == client.etag for _, _, etag in client.requests[1:])
    assert [m.name for m in archive.members(members[1].header_offset)] == ["d/one.jpg"]
    with pytest.raises(ArchiveError):
        archive.read(members[0])


def test_tar_refusals():
    data = bytearray(make_tar([("one.jpg", JPEG)]))
    data[10] ^= 1
    with pytest.raises(ArchiveError, match="checksum"):
        list(TarArchive(MemoryClient({"a": bytes(data)}), "a").members())
    with pytest.raises(ArchiveError, match="extension"):
        list(TarArchive(MemoryClient({"a": make_tar([("x" * 200, JPEG)], tarfile.PAX_FORMAT)}), "a").members())
    with pytest.raises(ArchiveError, match="beyond"):
        list(TarArchive(MemoryClient({"a": make_tar([("one.jpg", b"z" * 4000)])[:1024]}), "a").members())
    for name in ("../x", "/x", "a/../b", "a\\b", "", "a//b", "C:x"):
        with pytest.raises(ArchiveError):
            check_name(name)
    assert number(b"0000020\0") == 16 and number(b"\x80" + bytes(9) + b"\x01\x00") == 256 and number(b"   \0") == 0
    with pytest.raises(ArchiveError):
        number(b"0009\0")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=3000), max_size=5), st.integers(512, 4096))
def test_tar_round_trip(files, chunk):
    named = [(f"m{k}.bin", data) for k, data in enumerate(files)]
    archive = TarArchive(MemoryClient({"a": make_tar(named)}), "a", chunk)
    assert [(m.name, archive.read(m)) for m in archive.members()] == named


def test_zip_methods_and_bounded_ranges():
    big = bytes(range(256)) * 384 + b"x" * 17
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        client = MemoryClient({"a": make_zip([("a.db", b"hello" * 50), ("b/c.db", big)], method)})
        archive = ZipArchive(client, "a", chunk=4096)
        assert [m.name for m in archive.members()] == ["a.db", "b/c.db"]
        assert archive.read(archive.members()[1]) == big
        assert max(b - a + 1 for a, b, _ in client.requests) <= 4096
        assert all(etag == client.etag for _, _, etag in client.requests[1:])


def test_zip_refusals():
    data = bytearray(make_zip([("a.db", b"hello" * 50)], zipfile.ZIP_STORED))
    data[40] ^= 1
    archive = ZipArchive(MemoryClient({"a": bytes(data)}), "a")
    with pytest.raises(ArchiveError, match="CRC"):
        archive.read(archive.members()[0])
    archive = ZipArchive(MemoryClient({"a": make_zip([("../escape.db", b"x")])}), "a")
    with pytest.raises(ArchiveError, match="unsafe"):
        archive.read(archive.members()[0])
    with pytest.raises(ArchiveError):
        find_end(b"PK\5\6" + bytes(18) + b"trailing")


def test_zip64():
    name, body = b"a.db", b"payload"
    import zlib

    local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, zlib.crc32(body), len(body), len(body), len(name), 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    where = len(local) + len(entry)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, where, 1)
    end = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    archive = ZipArchive(MemoryClient({"a": local + entry + end64 + locator + end}), "a")
    assert archive.zip64 and len(archive.members()) == 1 and archive.read(archive.members()[0]) == body


def test_reply_contract():
    good = {"Content-Range": "bytes 2-4/10", "ETag": '"e"'}
    assert parse_reply(206, good, 2, 4, lambda n: b"abc").data == b"abc"
    for status, headers, data in ((200, good, b"abc"), (206, {"Content-Range": "bytes 1-4/10"}, b"abc"), (206, good, b"ab"), (206, {}, b"abc")):
        with pytest.raises(ArchiveError):
            parse_reply(status, headers, 2, 4, lambda n, data=data: data)

    class Changing(MemoryClient):
        def fetch(self, url, start, end, *, etag=None):
            got = super().fetch(url, start, end, etag=etag)
            return got if etag is None else type(got)(got.start, got.end, got.total, '"other"', got.data)

    with pytest.raises(ArchiveError, match="ETag"):
        RangeReader(Changing({"a": b"x" * 100}), "a").read(0, 10)


def test_retries_then_gives_up():
    waits, calls = [], []

    def opener(request, timeout):
        calls.append(1)
        raise TimeoutError("slow")

    with pytest.raises(ArchiveError, match="after 3"):
        HttpClient(3, wait=waits.append, opener=opener).fetch("http://localhost/x", 0, 1)
    assert len(calls) == 3 and waits == [1.0, 2.0]


def test_data_source(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.tar").write_bytes(make_tar([(f"{k}/{n}.jpg", JPEG + bytes([n])) for n in range(5)]))
    (tmp_path / "z.zip").write_bytes(make_zip([("a.db", b"1"), ("b.db", b"22")]))
    spark.dataSource.register(ArchiveMembers)
    load = lambda **o: spark.read.format("archive_members").options(root=str(tmp_path), **o).load()
    tars = load(paths="0.tar,1.tar,2.tar")
    assert tars.count() == 15
    content = {r["member_name"]: bytes(r["content"]) for r in read_payloads(tars, str(tmp_path)).collect()}
    assert content["2/4.jpg"] == JPEG + b"\x04"
    assert sorted((r["member_name"], r["member_size"]) for r in load(kind="zip", paths="z.zip").collect()) == [("a.db", 1), ("b.db", 2)]


def test_streamed_scan_resumes(spark, tmp_path):
    from tidewell.errors import StateConflict
    from tidewell.streaming.incremental import Ledger, scan_archives

    root = tmp_path / "in"
    root.mkdir()
    (root / "a.tar").write_bytes(make_tar([(f"{n}.jpg", JPEG) for n in range(7)]))
    ledger = Ledger(spark, str(tmp_path / "state"), {"etag": "1"})
    (root / "b.tar").write_bytes(make_tar([]))
    paths = ["a.tar", "b.tar"]
    assert not scan_archives(spark, str(root), paths, ledger, max_headers=3)
    first = ledger.rows().count()
    (tmp_path / "state/batches/batch=1").mkdir()  # a step that crashed before its marker
    assert not scan_archives(spark, str(root), paths, ledger, max_headers=3)
    assert scan_archives(spark, str(root), paths, Ledger(spark, str(tmp_path / "state"), {"etag": "1"}), max_headers=3)
    names = [r["member_name"] for r in ledger.rows().collect()]
    assert first == 3 and sorted(names) == [f"{n}.jpg" for n in range(7)]
    with pytest.raises(StateConflict):
        Ledger(spark, str(tmp_path / "state"), {"etag": "2"})
