"""Scenarios of planning and reading: phase, irregular rows, capture gaps, overlap, drift, and each way to fail."""

import json
import tempfile

import pytest

from tidewell.errors import ImagesUnavailable, IndexError_, RuleViolation, StateConflict, TidewellError
from tidewell.plans import catalog_world
from tidewell.plans.planner import NativeLogs, gap_lengths, plan_counts, plan_histories, plan_report
from tidewell.plans.publish import Scratch, Store, open_product, publish
from tidewell.plans.reports import document_parts, to_document
from tidewell.schemas import schema
from tidewell.serving import HistoryIndex, MetadataAdapter, load_images, padded, with_gaps

CHANNELS = ["CAM_F0", "CAM_R0"]
SHA = "a" * 64
TOKEN = "00000000000000aa"


def token(n):
    return bytes.fromhex(f"{n:016x}")


def fixture(spark, images=16, rows=14, anchors=(3,), kept=(0, 5, 10, 15), shift=lambda i, t: t + 20_000, anchor_ts=None, log_token=0xBB, lidar_token=None):
    ts = lambda k: anchor_ts if anchor_ts and k == anchors[0] else 1_000_000 + k * 500_000
    at = dict(enumerate(kept))
    names = [0xAA + a - anchors[0] if a in anchors else 0x500 + a for a in range(rows)]
    anchor_rows = [
        ("log_a", k, f"{names[k]:016x}", ts(k), "log_a", f"{0xBB:016x}", f"{0xCC:016x}", f"x/{k}.pcd",
         {c: (f"log_a/{c}/{c}_{at.get(k, min(5 * k, images - 1)):03d}.jpg",) for c in CHANNELS})
        for k in range(rows)
    ]
    times = [shift(i, 1_000_000 + i * 100_000) for i in range(images)]
    native = NativeLogs(
        spark.createDataFrame([("log_a", token(log_token), "log_a")], schema("log")),
        spark.createDataFrame([("log_a", token(lidar_token or names[a]), ts(a), token(0xCC), f"d/{a}.pcd") for a in anchors], schema("lidar")),
        spark.createDataFrame([("log_a", token(0x900 + c), name) for c, name in enumerate(CHANNELS)], schema("camera")),
        spark.createDataFrame([("log_a", token(0x1000 * (c + 1) + i), times[i], f"{CHANNELS[c]}_{i:03d}.jpg", token(0x900 + c)) for c in range(2) for i in range(images)], schema("image")),
    )
    tokens = spark.createDataFrame([(f"  {names[a]:016X} ",) for a in anchors], "token string")
    return spark.createDataFrame(anchor_rows, schema("anchor_row")), native, tokens


SCRATCH = tempfile.mkdtemp(prefix="tidewell-test-")


def plan(spark, *args, **kw):
    rows, native, tokens = fixture(spark, *args, **kw)
    return plan_histories(spark, rows, native, tokens, SHA, CHANNELS, keep=Scratch(spark, SCRATCH).keep)


def test_phase(spark):
    p = plan(spark)
    p.rules.enforce("plan")
    report = plan_report(p)
    assert (report["image_references"], report["distinct_images"], report["max_reference_count"]) == (32, 32, 1)
    assert report["history_frame_counts"] == {c: {"16": 1} for c in CHANNELS} and report["cadence_exceptions"] == 0
    assert {r["history_end_ts_us"] for r in p.anchor_camera.collect()} == {2_520_000}
    assert p.anchor.first()["mapping_method"] == "native_lidar_token"


def test_irregular(spark):
    p = plan(spark, kept=(0, 5, 10, 14), anchor_ts=2_400_000)
    p.rules.enforce("plan")
    report = plan_report(p)
    assert report["history_frame_counts"] == {c: {"15": 1} for c in CHANNELS}
    assert (report["image_references"], report["cadence_exceptions"]) == (30, 1)


def test_gap_is_kept_and_reported(spark):
    p = plan(spark, kept=(0, 5, 9, 14), shift=lambda i, t: t + 100_000 if t >= 1_800_000 else t)
    p.rules.enforce("plan")
    report = plan_report(p)
    assert report["history_frame_counts"] == {c: {"15": 1} for c in CHANNELS}
    assert (report["capture_gaps"], report["gap_histogram"], report["gap_anchors"], report["gap_anchor_channels"]) == (2, {"200000": 2}, 1, 2)
    index = HistoryIndex(spark, p.tables())
    one = with_gaps(index.histories(index.tokens(), ["CAM_F0"])).first()
    assert [f["image_ts_us"] for f in one["frames"]][7:9] == [1_700_000, 1_900_000] and one["gap_deltas_us"] == [200_000]


def test_gap_lengths_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Every gap has a length of its own: the counts bring one row at a time to the driver, and the histogram is read from a file."""
    p = plan(spark, shift=lambda i, t: t + 100_000 * i + i * i if i else t)
    brought, collect = [], type(p.anchor).collect
    monkeypatch.setattr(type(p.anchor), "collect", lambda self: brought.append(found := collect(self)) or found)
    counts = plan_counts(p)
    assert counts["capture_gaps"] > 20 and all(len(rows) <= 1 for rows in brought)
    lengths = {str(r["delta_us"]): r["count"] for r in collect(gap_lengths(p))}
    del brought[:]
    report = plan_report(p)
    assert len(lengths) > 10 and report["gap_histogram"] == lengths and list(report["gap_histogram"]) == sorted(lengths)
    assert all(report["gap_histogram"][k] == n for k, n in lengths.items()) and "1" not in report["gap_histogram"]
    assert all(len(rows) < len(lengths) for rows in brought)
    plain = json.dumps({**report, "gap_histogram": lengths}, sort_keys=True, indent=2)
    assert to_document(report) == plain and to_document({"a": {}, "b": [1, {"c": "x\ny"}]}) == json.dumps({"a": {}, "b": [1, {"c": "x\ny"}]}, sort_keys=True, indent=2)
    store = Store(spark, str(tmp_path))
    store.replace_text(f"{tmp_path}/report.json", document_parts(report))
    assert store.read_text(f"{tmp_path}/report.json") == plain


def test_plan_report_query_brings_single_rows(spark, monkeypatch):
    brought, collect = [], type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: brought.append(found := collect(self)) or found)
    made = catalog_world.plan_report(spark, "/root/testdata/sf0.001")
    assert max(map(len, brought), default=0) <= 1 and collect(made)[0]["capture_gaps"] > 100


def test_overlap_shares_images(spark):
    p = plan(spark, images=21, rows=15, anchors=(3, 4), kept=(0, 5, 10, 15, 20), shift=lambda i, t: t)
    p.rules.enforce("plan")
    report = plan_report(p)
    assert (report["anchors"], report["image_references"], report["distinct_images"], report["max_reference_count"]) == (2, 64, 42, 2)


@pytest.mark.parametrize(
    "rule, change",
    [
        ("log.identity", dict(log_token=0xBC)), ("lidar.one", dict(lidar_token=0x77)), ("anchor.future", dict(rows=13)),
        ("retained.one", dict(shift=lambda i, t: t + 60_000)), ("stream.cadence", dict(shift=lambda i, t: t + 70_000 if i == 7 else t)),
    ],
)
def test_fails_closed(spark, tmp_path, rule, change):
    rows, native, tokens = fixture(spark, **change)
    if rule == "lidar.one":
        native.lidar = native.lidar.withColumn("ts_us", native.lidar["ts_us"] + 1)
    p = plan_histories(spark, rows, native, tokens, SHA, CHANNELS, keep=Scratch(spark, SCRATCH).keep)
    with pytest.raises(RuleViolation) as error:
        publish(spark, p.tables(), str(tmp_path / "index"), "history", lambda staged: p.rules)
    assert rule in str(error.value)
    assert not (tmp_path / "index").exists() and not list(tmp_path.iterdir())


def test_lidar_fallback(spark):
    p = plan(spark, lidar_token=0x77)
    p.rules.enforce("plan")
    assert p.anchor.first()["mapping_method"] == "native_lidar_timestamp_and_filename"


def test_unknown_token_and_partial(spark):
    rows, native, _ = fixture(spark)
    tokens = spark.createDataFrame([(TOKEN,), ("ff",)], "token string")
    p = plan_histories(spark, rows, native, tokens, SHA, CHANNELS, keep=Scratch(spark, SCRATCH).keep)
    assert "anchor.found" in {r["rule"] for r in p.rules.violations().collect()}
    part = plan_histories(spark, rows, native, tokens, SHA, CHANNELS, max_anchors=1, keep=Scratch(spark, SCRATCH).keep)
    part.rules.enforce("plan")
    assert {r["key"]: r["value"] for r in part.metadata.collect()}["partial"] == "true"


def test_publish_and_read(spark, tmp_path):
    p, path = plan(spark), str(tmp_path / "index")
    manifest = publish(spark, p.tables(), path, "history", lambda staged: p.rules)
    assert manifest["tables"]["native_image"]["rows"] == 32
    with pytest.raises(StateConflict):
        publish(spark, p.tables(), path, "history")
    open_product(spark, path, "history", verify=True)
    with pytest.raises(TidewellError):
        open_product(spark, path, "storage")
    index = HistoryIndex.open(spark, path)
    ask = lambda t: spark.createDataFrame([(t,)], "token string")
    assert index.has(ask("  00000000000000AA ")).first()["found"] and not index.has(ask("beef")).first()["found"]
    assert index.preserves_gaps and not index.native_jpegs_verified
    got = index.histories(ask(TOKEN), CHANNELS)
    assert {len(r["frames"]) for r in got.collect()} == {16}
    one = index.availability(ask(TOKEN), spark.createDataFrame([], "path string")).first()
    assert one[1:4] == (32, 0, 32) and one["missing_paths"] == sorted(f"sensor_blobs/log_a/{c}/{c}_{i:03d}.jpg" for c in CHANNELS for i in range(16))
    wide = padded(got, 18).first()
    assert wide["valid"][15:] == [True, False, False] and wide["timestamps_us"][16:] == [-1, -1]
    with pytest.raises(IndexError_):
        padded(got, 10)
    with pytest.raises(IndexError_):
        index.histories(ask("beef"))
    with pytest.raises(IndexError_):
        index.histories(ask(TOKEN), ["CAM_B0"])
    with pytest.raises(IndexError_):
        HistoryIndex.open(spark, path, expected_frames=15).histories(ask(TOKEN))
    adapter = MetadataAdapter(index, ask(TOKEN))
    assert adapter.tokens().count() == 1 and adapter.anchor(TOKEN).count() == 2
    with pytest.raises(IndexError_):
        adapter.anchor("beef")


def test_reader_rejects_a_wrong_count(spark):
    p = plan(spark)
    tables = p.tables()
    tables["anchor_camera"] = tables["anchor_camera"].selectExpr(*[c if c != "frame_count" else "frame_count - 1 AS frame_count" for c in tables["anchor_camera"].columns])
    index = HistoryIndex(spark, tables)
    with pytest.raises(IndexError_, match="history"):
        index.histories(index.tokens())


def test_images_from_packs(spark, tmp_path):
    import hashlib

    jpeg = b"\xff\xd8" + b"body" + b"\xff\xd9"
    p = plan(spark)
    index = HistoryIndex(spark, p.tables())
    got = index.histories(index.tokens())
    (tmp_path / "a.pack").write_bytes(b"x" * 19 + jpeg)
    paths = [r["blob_path"] for r in p.native_image.collect()]
    rows = [(d, "k", d, "pack", "a.pack", 19, len(jpeg), hashlib.sha256(jpeg).hexdigest()) for d in paths]
    storage = spark.createDataFrame(rows, schema("image_storage"))
    loaded = load_images(spark, got, storage, str(tmp_path))
    assert loaded.count() == 32 and bytes(loaded.first()["content"]) == jpeg
    (tmp_path / "a.pack").write_bytes(b"x" * 19 + jpeg[:-1] + b"\x00")
    with pytest.raises(ImagesUnavailable):
        load_images(spark, got, storage, str(tmp_path))
    with pytest.raises(ImagesUnavailable):
        load_images(spark, got, storage.limit(3), str(tmp_path))
