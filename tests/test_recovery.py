"""What a crash, a second writer, or a changed source leaves behind."""

import json
import os

import pytest

from tests.test_archives import make_tar
from tidewell.errors import ArchiveError, SchemaMismatch, StateConflict, TidewellError
from tidewell.operators import ranking
from tidewell.plans.publish import MANIFEST, Store, open_product, publish
from tidewell.schemas import metadata_rows
from tidewell.sources import readers
from tidewell.sources.ranges import KeepAliveClient, MemoryClient, RangeReader, bare_etag
from tidewell.sources.sinks import append_pack, download, publish_release
from tidewell.streaming.incremental import Ledger, scan_archives, wait_for_space


def image(n):
    return b"\xff\xd8" + bytes([n]) * (n + 3) + b"\xff\xd9"


def layout(count):
    out, at = [], 0
    for n in range(count):
        out.append((f"{n}.jpg", at, len(image(n))))
        at += len(image(n))
    return out


@pytest.mark.parametrize("lost_at", [0, 1, 4, 6, 9])
def test_pack_goes_on_from_its_checkpoint(tmp_path, lost_at):
    path, plan, asked = str(tmp_path / "p/x.pack"), layout(10), []

    def fetch(row):
        if len(asked) == lost_at:
            raise OSError("lost")
        asked.append(row[0])
        return image(int(row[0].split(".")[0]))

    with pytest.raises(OSError):
        append_pack(path, plan, fetch, checkpoint=3)
    assert not os.path.exists(path)
    with open(f"{path}.partial", "ab") as f:
        f.write(b"torn")  # bytes that no state counts
    again = []
    hashes = append_pack(path, plan, lambda r: again.append(r[0]) or image(int(r[0].split(".")[0])), checkpoint=3)
    assert again == [f"{n}.jpg" for n in range(lost_at // 3 * 3, 10)] and len(hashes) == 10
    assert open(path, "rb").read() == b"".join(image(n) for n in range(10)) and os.listdir(tmp_path / "p") == ["x.pack"]
    # a crash between the renaming and the ledger's status: the pack is verified, nothing is fetched
    assert append_pack(path, plan, lambda r: 1 / 0) == hashes
    with open(path, "r+b") as f:
        f.write(b"\0")
    with pytest.raises(ArchiveError):
        append_pack(path, plan, lambda r: 1 / 0)


def test_pack_of_another_plan_starts_over(tmp_path):
    path = str(tmp_path / "x.pack")
    with pytest.raises(ArchiveError, match="instead of"):
        append_pack(path, layout(3), lambda r: image(0) if r[0] == "2.jpg" else image(int(r[0][0])), checkpoint=1)
    other = [(f"{9 - n}.jpg", o, s) for n, (_, o, s) in enumerate(layout(3))]
    got = []
    append_pack(path, other, lambda r: got.append(r[0]) or image(9 - int(r[0][0])))
    assert got == ["9.jpg", "8.jpg", "7.jpg"]
    with pytest.raises(ArchiveError, match="tile"):
        append_pack(str(tmp_path / "y.pack"), [("a.jpg", 1, 5)], lambda r: b"")


def test_two_attempts_of_a_pack(tmp_path):
    import fcntl

    path = str(tmp_path / "x.pack")
    with open(f"{path}.partial", "ab") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        with pytest.raises(ArchiveError, match="another attempt"):
            append_pack(path, layout(2), lambda r: image(int(r[0][0])))


def test_publication_is_whole(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "p"), {"metadata": metadata_rows(spark, {"a": 1})}
    real = Store.rename
    monkeypatch.setattr(Store, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        publish(spark, table, path, "ledger")
    assert not os.path.exists(path)
    monkeypatch.setattr(Store, "rename", real)
    (tmp_path / "p._staging-dead").mkdir()  # what a killed run leaves
    publish(spark, table, path, "ledger")
    assert os.path.exists(f"{path}/{MANIFEST}") and sorted(os.listdir(tmp_path)) == ["p"]
    assert open_product(spark, path, "ledger", verify=True)["metadata"].count() == 1


def test_documents_are_replaced_whole(spark, tmp_path):
    store, path = Store(spark, str(tmp_path)), str(tmp_path / "d.json")
    store.replace_text(path, "1")
    store.replace_text(path, "2")
    assert store.read_text(path) == "2" and [n for n in store.list(str(tmp_path)) if not n.startswith(".")] == ["d.json"]
    with pytest.raises(Exception):  # noqa: B017
        store.write_text(path, "3")
    waits = []
    assert wait_for_space(store, str(tmp_path), 0, 0, False, 1, 1, waits.append)
    assert not wait_for_space(store, str(tmp_path), 1 << 62, 0, False, 1, 3, waits.append) and waits == [1, 1]
    assert wait_for_space(store, str(tmp_path), 1 << 62, 0, True, 1, 1, waits.append)


def test_one_writer_of_a_ledger(spark, tmp_path):
    (tmp_path / "a.tar").write_bytes(make_tar([(f"{n}.jpg", image(n)) for n in range(5)]))
    ledger = Ledger(spark, str(tmp_path / "state"), {"e": 1})
    with ledger.locked():
        with pytest.raises(StateConflict, match="another writer"):
            scan_archives(spark, str(tmp_path), ["a.tar"], Ledger(spark, str(tmp_path / "state"), {"e": 1}))
    assert not scan_archives(spark, str(tmp_path), ["a.tar"], ledger, 2)
    (tmp_path / "state/_lock").write_text("a writer that crashed")
    with pytest.raises(StateConflict):
        scan_archives(spark, str(tmp_path), ["a.tar"], ledger, 2)
    assert not scan_archives(spark, str(tmp_path), ["a.tar"], ledger, 2, take_over=True)
    assert scan_archives(spark, str(tmp_path), ["a.tar"], ledger, 2) and not (tmp_path / "state/_lock").exists()
    rows = ledger.rows().collect()
    assert sorted(r["member_name"] for r in rows) == [f"{n}.jpg" for n in range(5)]
    assert ledger.note(ledger.committed()[-1]) == {"a.tar": max(r["next_header_offset"] for r in rows)}


def test_pinned_sources(spark, tmp_path):
    client = MemoryClient({"a": bytes(range(50))}, etag='W/"e1"')
    assert bare_etag('W/"e1"') == bare_etag('"e1"') == bare_etag("e1") == "e1" and bare_etag('""') is None is bare_etag(None)
    assert RangeReader(client, "a", size=50, etag='"e1"').read(3, 4) == bytes([3, 4, 5, 6])
    for pin in (dict(size=51), dict(etag='"e2"')):
        with pytest.raises(ArchiveError, match="instead of"):
            RangeReader(client, "a", **pin)
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a").write_bytes(image(1) + image(2))
    from tidewell.sources.ranges import FileClient

    root, size = str(tmp_path / "src"), len(image(1)) + len(image(2))
    rows = [(f"d/{n}.jpg", "a", o, s, None, "i", size, FileClient(root).fetch("a", 0, 0).etag) for n, o, s in ((1, 0, len(image(1))), (2, len(image(1)), len(image(2))))]
    jobs = spark.createDataFrame(rows, "path string, source_url string, offset bigint, size bigint, sha256 string, identity string, source_size bigint, etag string")
    assert download(jobs, str(tmp_path / "out"), lambda: FileClient(root)).count() == 2 and (tmp_path / "out/d/2.jpg").read_bytes() == image(2)
    (tmp_path / "src/a").write_bytes(image(1) + image(2) + b"more")
    with pytest.raises(Exception, match="instead of"):
        download(jobs, str(tmp_path / "out2"), lambda: FileClient(root)).collect()
    # a short reply is refused, whatever the client
    jobs = jobs.selectExpr("path", "source_url", "offset + 1000 AS offset", "size", "sha256", "identity")
    with pytest.raises(Exception, match="outside"):
        download(jobs, str(tmp_path / "out3"), lambda: FileClient(root)).collect()


class Connection:
    """Replies with ranges of a body; drops the connection at chosen requests."""

    body, made = bytes(range(100)), []

    def __init__(self, peer, drop):
        self.peer, self.drop, self.asked, self.closed = peer, drop, [], False
        Connection.made.append(self)

    def request(self, method, path, headers):
        self.asked.append((path, headers))
        if self.drop and len(self.asked) > 1:
            raise ConnectionResetError("gone")

    def getresponse(self):
        start, end = map(int, {k.lower(): v for k, v in self.asked[-1][1].items()}["range"].removeprefix("bytes=").split("-"))
        data = self.body[start : end + 1]

        class Reply:
            status, reason, headers = 206, "", {"Content-Range": f"bytes {start}-{end}/100", "ETag": '"e"'}

            def __init__(self):
                self.left = data

            def read(self, n):
                out, self.left = self.left[:n], self.left[n:]
                return out

        return Reply()

    def close(self):
        self.closed = True


def test_kept_connections_and_peers():
    Connection.made = []
    client = KeepAliveClient(wait=lambda s: None, addresses={"h.example": ["10.0.0.1", "10.0.0.2"]}, connect=lambda scheme, host, port, peer, timeout: Connection(peer, drop=not Connection.made))
    assert client.fetch("https://h.example/x?y=1", 5, 9).data == bytes(range(5, 10))
    assert client.fetch("https://h.example/x", 0, 1).data == b"\0\1" and client.fetch("https://h.example/x", 2, 2).data == b"\2"
    first, second = Connection.made
    assert (first.peer, second.peer, first.closed, len(second.asked)) == ("10.0.0.1", "10.0.0.2", True, 2)
    assert first.asked[0][0] == "/x?y=1" and first.asked[0][1]["Host"] == "h.example"


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.txt").write_text("".join(f"line {n} of {k}\n" for n in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path)).collect()
        assert readers.numbered_lines(spark, str(tmp_path)).select("path").rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 6000 and all(r["line"] == f"line {r['line_number'] - 1} of {r['path'][-5]}" for r in rows)


def test_log_names_without_a_parser(spark, tmp_path):
    import hashlib

    text = "num_history_frames: 4\nlog_names:\n  - log_a\n\n  # one\n  - 'log-b.1'\n- \"c\"\ntokens:\n  - ff\n"
    (tmp_path / "f.yaml").write_text(text)
    pin = hashlib.sha256(text.encode()).hexdigest()
    assert [r[0] for r in readers.read_log_names(spark, str(tmp_path / "f.yaml"), pin).collect()] == ["log_a", "log-b.1", "c"]
    for bad in (text.replace("log_a", "log a"), text.replace("log_a", "c"), "tokens:\n  - ff\n", text.replace("  - log_a", "  - 'log_a")):
        (tmp_path / "f.yaml").write_text(bad)
        with pytest.raises(SchemaMismatch):
            readers.read_log_names(spark, str(tmp_path / "f.yaml"))
    with pytest.raises(SchemaMismatch, match="pinned"):
        readers.read_log_names(spark, str(tmp_path / "f.yaml"), pin)


def test_listing_pages_and_headers():
    pages = {"https://h/b?list-type=2&prefix=a%2F": (200, "<IsTruncated>true</IsTruncated><NextContinuationToken>x&amp;y</NextContinuationToken>"), "https://h/b?list-type=2&prefix=a%2F&continuation-token=x%26y": (200, "<IsTruncated>false</IsTruncated>")}
    assert len(list(readers.fetch_listing(pages.__getitem__, "https://h/b", "a/"))) == 2
    for fetch, base in ((lambda u: (403, ""), "https://h/b"), (lambda u: (200, "<IsTruncated>true</IsTruncated>"), "https://h/b"), (pages.__getitem__, "http://h/b")):
        with pytest.raises(TidewellError):
            list(readers.fetch_listing(fetch, base))
    headers = {"Authorization": "s", "Accept": "x"}
    assert readers.safe_headers(headers, "https://API.host/x", ["api.host"]) == headers
    for url, moved in (("https://other/x", False), ("http://api.host/x", False), ("https://api.host/x", True)):
        assert readers.safe_headers(headers, url, ["api.host"], moved) == {"Accept": "x"}


def test_hashes_of_listed_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in range(3):
        (tmp_path / f"d/{n}").write_bytes(bytes([n]))
    listed = spark.createDataFrame(spark.read.format("binaryFile").load(str(tmp_path / "d")).selectExpr("path", "length", "modificationTime AS modified").collect())
    assert readers.file_hashes(spark, str(tmp_path / "d"), listed).count() == 3
    (tmp_path / "d/1").write_bytes(b"longer")
    with pytest.raises(StateConflict, match="d/1"):
        readers.file_hashes(spark, str(tmp_path / "d"), listed)


def test_release(tmp_path):
    (tmp_path / "a").write_bytes(b"1")
    held = {}
    assert publish_release([str(tmp_path / "a")], held.__setitem__, held.__getitem__)[0]["size"] == 1
    with pytest.raises(ArchiveError):
        publish_release([str(tmp_path / "a")], held.__setitem__, lambda n: b"2")


def test_positions_over_groups_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FAN_OUT", 3)
    keys = [k * k % 5003 for k in range(1, 700)] + [-5, -40]
    keys = sorted(set(keys))
    got = {r["k"]: r["position"] for r in ranking.global_position(spark.createDataFrame([(k,) for k in keys], "k long").repartition(4), "k", 16).collect()}
    assert got == {k: n for n, k in enumerate(keys)}
    assert json.dumps(sorted(got)) == json.dumps(keys)
