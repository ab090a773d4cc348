"""The tools end to end on a small fleet: plan, ledger, packs, storage index, reading, direct index, offload."""

import hashlib
import json
import pickle
import sqlite3
import zipfile

import numpy as np
import pytest
import yaml

from tests.test_archives import make_tar
from tidewell import cli
from tidewell.errors import ImagesUnavailable, TidewellError
from tidewell.plans import rules as R
from tidewell.plans.publish import open_product, read_shards
from tidewell.plans.reports import exit_code
from tidewell.serving import HistoryIndex, ImageLoader, MetadataAdapter, retained_references
from tidewell.workflow import Workflow

CHANNELS = ["CAM_F0", "CAM_R0"]
KEY = "public/train_set/sensors_train_camera_7.zip"


def image(c, i):
    return b"\xff\xd8" + bytes([c, i]) * (i + 2) + b"\xff\xd9"


def decode(data):
    return np.full((2, 3, 3), data[3], np.uint8)


def broken_decoder(data):
    return np.zeros((2, 3), np.uint8)


def number(n):
    return n.to_bytes(8, "big")


@pytest.fixture(scope="module")
def fleet(tmp_path_factory):
    """One log: 16 images a channel at 10 Hz, 14 rows at 2 Hz, one anchor with a whole history and future."""
    root = tmp_path_factory.mktemp("fleet")
    for name in ("anchors", "native", "archives/public/train_set", "work", "official/log_a/CAM_F0"):
        (root / name).mkdir(parents=True)
    at = {0: 0, 1: 5, 2: 10, 3: 15}
    rows = [
        {"token": number(0x500 + k), "timestamp": 1_000_000 + k * 500_000, "log_name": "log_a", "log_token": number(0xBB).hex(), "scene_token": number(0xCC).hex(), "lidar_path": f"x/{k}.pcd",
         "cams": {c: {"data_path": f"log_a/{c}/{c}_{at.get(k, 15):03d}.jpg"} for c in CHANNELS}}
        for k in range(14)
    ]
    (root / "anchors/log_a.pkl").write_bytes(pickle.dumps(rows))
    db = sqlite3.connect(root / "native/log_a.db")
    db.executescript("CREATE TABLE log(token, logfile); CREATE TABLE lidar_pc(token, timestamp, scene_token, filename); CREATE TABLE camera(token, channel); CREATE TABLE image(token, timestamp, filename_jpg, camera_token);")
    db.execute("INSERT INTO log VALUES (?, 'log_a')", (number(0xBB),))
    db.execute("INSERT INTO lidar_pc VALUES (?, ?, ?, 'd/3.pcd')", (number(0x503), 2_500_000, number(0xCC)))
    members = []
    for c, channel in enumerate(CHANNELS):
        db.execute("INSERT INTO camera VALUES (?, ?)", (number(0x900 + c), channel))
        for i in range(16):
            db.execute("INSERT INTO image VALUES (?, ?, ?, ?)", (number(0x1000 * (c + 1) + i), 1_020_000 + i * 100_000, f"{channel}_{i:03d}.jpg", number(0x900 + c)))
            members.append((f"sensors_train_camera_7/log_a/{channel}/{channel}_{i:03d}.jpg", image(c, i)))
    db.commit()
    db.close()
    (root / "archives" / KEY).write_bytes(make_tar(members))
    for i in (0, 5, 10, 15):
        (root / f"official/log_a/CAM_F0/CAM_F0_{i:03d}.jpg").write_bytes(image(0, i))
    (root / "filter.yaml").write_text(yaml.safe_dump({"num_history_frames": 4, "num_future_frames": 10, "log_names": ["log_a"], "tokens": [number(0x503).hex()]}))
    (root / "train.txt").write_text("File group: 7\nlog_a\n")
    (root / "val.txt").write_text("File group: 1\nlog_z\n")
    (root / "flow.yaml").write_text(yaml.safe_dump({
        "anchor_logs": f"{root}/anchors/*.pkl", "native_logs": f"{root}/native/*.db", "scene_filter": f"{root}/filter.yaml", "train_manifest": f"{root}/train.txt", "val_manifest": f"{root}/val.txt",
        "archive_root": f"{root}/archives", "work_root": f"{root}/work", "existing_root": f"{root}/official", "channels": ",".join(CHANNELS), "checkpoint": 3, "scene_filter_sha256": hashlib.sha256((root / "filter.yaml").read_bytes()).hexdigest(),
    }))
    return root


@pytest.fixture(scope="module")
def done(spark, fleet):
    report = cli.run(["workflow", "--config", f"{fleet}/flow.yaml"], spark)
    assert report["status"] == "pass", report
    return fleet


def test_workflow(spark, done):
    stages = cli.run(["workflow", "--config", f"{done}/flow.yaml", "--stage", "status"], spark)["stages"]
    assert stages == {"plan": "pass", "ledger": "pass", "pack": "pass", "finalize": "pass"}
    assert cli.run(["workflow", "--config", f"{done}/flow.yaml", "--stage", "doctor"], spark)["status"] == "pass"
    assert cli.run(["workflow", "--config", f"{done}/flow.yaml"], spark)["status"] == "pass"  # nothing is done again
    storage = {r["destination"]: r for r in open_product(spark, f"{done}/work/storage", "storage", verify=True)["image_storage"].collect()}
    assert len(storage) == 32 and sum(r["storage_kind"] == "existing" for r in storage.values()) == 4
    packed = (done / "work/packs/train_set/sensors_train_camera_7.pack").read_bytes()
    r = storage["sensor_blobs/log_a/CAM_R0/CAM_R0_007.jpg"]
    assert packed[r["pack_offset"] : r["pack_offset"] + r["payload_size"]] == image(1, 7)
    again = cli.run(["ledger", "--ledger", f"{done}/work/ledger", "--inventory", f"{done}/work/inventory.jsonl"], spark)
    assert (again["status"], again["resumed"]) == ("pass", True)


def test_plan_and_audit_reports(spark, done, tmp_path, capsys):
    base = ["plan", "--anchor-logs", f"{done}/anchors/*.pkl", "--native-logs", f"{done}/native/*.db", "--scene-filter", f"{done}/filter.yaml", "--output", str(tmp_path / "h"), "--channels", "cam_f0,cam_r0"]
    dry = cli.run([*base, "--dry-run", "--report", str(tmp_path / "r.json")], spark)
    assert (dry["status"], dry["anchors"], dry["image_references"], exit_code(dry)) == ("pass", 1, 32, 0) and not (tmp_path / "h").exists()
    assert json.loads((tmp_path / "r.json").read_text())["tool"] == "plan"
    assert cli.run([*base, "--dry-run", "--max-anchors", "1"], spark)["status"] == "partial_pass"
    for wrong in (["--filter-sha256", "0" * 64], ["--cadence-tolerance-us", "-1"], ["--anchor-token", "ff"], ["--inventory", "x.csv"], ["--report", "x.txt"]):
        report = cli.run([*base, "--dry-run", *wrong], spark)
        assert exit_code(report) == 2 and report["error"], wrong
    audit = ["audit", "--index", f"{done}/work/history", "--anchor-logs", f"{done}/anchors/*.pkl", "--scene-filter", f"{done}/filter.yaml"]
    report = cli.run([*audit, "--manifest-jsonl", str(tmp_path / "m.jsonl")], spark)
    assert (report["status"], report["anchors"], report["images_by_channel"], report["frame_counts"]) == ("pass", 1, {"CAM_F0": 16, "CAM_R0": 16}, {"16": 2})
    assert spark.read.text(str(tmp_path / "m.jsonl")).count() == 32
    missing = cli.run([*audit, "--image-listing", f"{done}/official"], spark)
    assert (missing["status"], missing["violations"]) == ("fail", {"file.missing": 32})
    assert cli.main(["finalize", "--states", str(tmp_path / "none")]) == 2
    assert json.loads(capsys.readouterr().out)["status"] == "fail"


def test_loader(spark, done):
    loader = ImageLoader.from_index_path(spark, f"{done}/work/history", f"{done}/work/storage", str(done / "bytes"), decode)
    (done / "bytes").mkdir(exist_ok=True)
    for name, at in (("train_set", "work/packs/train_set"), ("log_a", "official/log_a")):
        if not (done / "bytes" / name).exists():
            (done / "bytes" / name).symlink_to(done / at)
    token = number(0x503).hex()
    with pytest.raises(ImagesUnavailable):  # links lead out of the root
        loader.load_anchor(token).collect()
    import shutil

    for name, at in (("train_set", "work/packs/train_set"), ("log_a", "official/log_a")):
        (done / "bytes" / name).unlink()
        shutil.copytree(done / at, done / "bytes" / name)
    got = {(r["channel"], r["position"]): r for r in loader.load_anchor(f" {token.upper()} ").collect()}
    assert len(got) == 32
    for (channel, position), r in got.items():
        assert (r["height"], r["width"], bytes(r["pixels"])) == (2, 3, bytes([position]) * 18) and r["image_ts_us"] == 1_020_000 + 100_000 * position
    tokens = spark.createDataFrame([(token,)], "token string")
    filled = loader.padded(tokens, 18, ["CAM_F0"]).first()
    assert filled["valid"] == [True] * 16 + [False] * 2 and filled["timestamps_us"][16:] == [-1, -1] and filled["images"][15] == bytes([15]) * 18 and filled["images"][16:] == [None, None]
    loader.decoder = broken_decoder
    with pytest.raises(Exception, match="of shape"):
        loader.load_anchor(token).collect()
    one = retained_references(loader.index.histories(tokens, ["CAM_F0"])).first()
    assert (one["start_reference"]["image_ts_us"], one["end_reference"]["blob_path"]) == (1_020_000, "sensor_blobs/log_a/CAM_F0/CAM_F0_015.jpg")

    class Scenes:
        tokens = [token.upper()]

    assert MetadataAdapter.from_scene_loader(HistoryIndex.open(spark, f"{done}/work/history"), Scenes).anchor(token).count() == 2
    report = cli.run(["visual-audit", "--index", f"{done}/work/history", "--storage", f"{done}/work/storage", "--image-root", str(done / "bytes"), "--output", str(done / "panels"), "--samples", "1", "--decoder", "tests.test_cli:decode"], spark)
    assert report["status"] == "pass" and len(report["panels"][0]["records"]) == 16
    assert (done / "panels" / report["files"][0]["path"]).read_bytes().startswith(b"\x89PNG") and json.loads((done / "panels/manifest.json").read_text())["seed"] == 0


def test_direct_index(spark, done, tmp_path):
    out = cli.run(["direct-export", "--packs", f"{done}/work/pack-state", "--output", str(tmp_path / "direct"), "--base-url", "https://host.example/"], spark)
    assert (out["status"], out["rows"], len(out["shards"])) == ("pass", 32, 1)
    assert cli.run(["direct-export", "--packs", f"{done}/work/pack-state", "--output", str(tmp_path / "d2"), "--base-url", "http://host.example"], spark)["status"] == "fail"
    assert read_shards(spark, str(tmp_path / "direct"), [1]).count() == 32
    for bad in ([2], [1, 1], [0]):
        with pytest.raises(TidewellError):
            read_shards(spark, str(tmp_path / "direct"), bad)
    get = ["direct-download", "--direct", str(tmp_path / "direct"), "--output", str(tmp_path / "images"), "--receipts", str(tmp_path / "receipts"), "--source-root", f"{done}/archives"]
    assert cli.run([*get, "--dry-run", "--provenance", "native"], spark)["jobs"] == 28
    first = cli.run([*get, "--limit", "5"], spark)
    assert (first["status"], first["downloaded"], first["retries"]) == ("pass", 5, 0) and first["requests"] >= 1
    rest = cli.run(get, spark)
    assert (rest["skipped"], rest["downloaded"]) == (5, 27)
    changed = tmp_path / "images/sensor_blobs/log_a/CAM_R0/CAM_R0_003.jpg"
    assert changed.read_bytes() == image(1, 3)
    changed.write_bytes(b"other")
    assert cli.run(get, spark)["downloaded"] == 1 and changed.read_bytes() == image(1, 3)
    shard = next((tmp_path / "direct").rglob("*.gz"))
    shard.with_name(f".{shard.name}.crc").unlink()  # the local file system's own checksum
    shard.write_bytes(shard.read_bytes()[:-1] + b"x")
    with pytest.raises(TidewellError, match="other bytes"):
        read_shards(spark, str(tmp_path / "direct"))


def test_relay_offload_and_finalize(spark, done, tmp_path):
    (tmp_path / "packs").mkdir()
    base = ["relay", "--ledger", f"{done}/work/ledger", "--offsets", f"{done}/work/offsets", "--archive-root", f"{done}/archives", "--pack-root", str(tmp_path / "packs"), "--work-root", str(tmp_path / "relay"), "--existing-root", f"{done}/official"]
    assert cli.run([*base, "--min-free-gb", "1e9"], spark)["status"] == "partial"
    report = cli.run(base, spark)
    assert (report["status"], report["archives"], report["target_total"]) == ("pass", 1, 32), report
    assert json.loads((tmp_path / "relay/complete.json").read_text())["ledger_sha256"] == report["ledger_sha256"]
    assert cli.run(["finalize", "--states", str(tmp_path / "relay/states"), "--archives", "1"], spark)["snapshot"] == "0000"
    assert cli.run(["finalize", "--states", str(tmp_path / "relay/states")], spark)["status"] == "fail"
    move = ["offload", "--packs", str(tmp_path / "relay/states/0000"), "--pack-root", str(tmp_path / "packs"), "--target-root", str(tmp_path / "moved"), "--manifest", str(tmp_path / "offload.json")]
    assert cli.run([*move, "--dry-run"], spark)["reason"] == "packing_complete" and cli.run([*move, "--dry-run", "--force"], spark)["reason"] == "force"
    report = cli.run([*move, "--delete-source"], spark)
    assert report["verified"] and not list((tmp_path / "packs").rglob("*.pack")) and (tmp_path / "moved" / report["packs"][0]["path"]).exists()
    assert json.loads((tmp_path / "offload.json").read_text())["reason"] == "packing_complete"


def test_staging_and_native_databases(spark, done, tmp_path):
    report = cli.run(["ledger", "--ledger", f"{done}/work/ledger", "--operation", "stage", "--archive-root", f"{done}/archives", "--state", str(tmp_path / "scan"), "--stage-root", str(tmp_path / "files"), "--max-headers", "10"], spark)
    assert (report["status"], report["files"]) == ("pass", {"written": 32}) and (tmp_path / "files/sensor_blobs/log_a/CAM_F0/CAM_F0_004.jpg").read_bytes() == image(0, 4)
    part = cli.run(["ledger", "--ledger", f"{done}/work/ledger", "--operation", "offset-index", "--archive-root", f"{done}/archives", "--state", str(tmp_path / "scan2"), "--offsets", str(tmp_path / "o"), "--max-headers", "10", "--max-steps", "1"], spark)
    assert (part["status"], part["indexed"]) == ("partial", 10)
    with zipfile.ZipFile(tmp_path / "dbs.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("data/log_a.db", (done / "native/log_a.db").read_bytes())
        z.writestr("data/log_b.db", b"other")
    base = ["native", "--archive-root", str(tmp_path), "--archives", "dbs.zip", "--scene-filter", f"{done}/filter.yaml", "--output", str(tmp_path / "out")]
    assert cli.run([*base, "--dry-run"], spark)["files"] == {"missing": 1}
    assert cli.run(base, spark)["files"] == {"extracted": 1} and (tmp_path / "out/log_a.db").read_bytes() == (done / "native/log_a.db").read_bytes()
    assert cli.run(base, spark)["files"] == {"validated": 1}
    (tmp_path / "out/log_a.db").write_bytes(b"cut")
    assert cli.run([*base, "--dry-run"], spark)["files"] == {"size_mismatch": 1} and cli.run(base, spark)["files"] == {"extracted": 1}
    assert cli.run([*base, "--allowed", "else.zip"], spark)["status"] == "error"
    (tmp_path / "out/strange.db").write_bytes(b"")
    assert "strange.db" in cli.run(base, spark)["error"]


def test_configuration_faults(spark, fleet, tmp_path):
    good = yaml.safe_load((fleet / "flow.yaml").read_text())
    for change, word in (({"colour": 1}, "unknown key"), ({"checkpoint": "many"}, "checkpoint"), ({"checkpoint": 0}, "checkpoint"), ({"archive_base_url": "http://x"}, "https"), ({"archive_root": "/data/test/x"}, "held-out")):
        (tmp_path / "flow.yaml").write_text(yaml.safe_dump(good | change))
        with pytest.raises(TidewellError, match=word):
            Workflow.load(spark, str(tmp_path / "flow.yaml"))
    (tmp_path / "flow.yaml").write_text(yaml.safe_dump({k: v for k, v in good.items() if k != "scene_filter"}))
    with pytest.raises(TidewellError, match="missing key"):
        Workflow.load(spark, str(tmp_path / "flow.yaml"))
    (tmp_path / "flow.yaml").write_text(yaml.safe_dump(good | {"minimum_free_gb": 1e9, "val_manifest": "/none", "scene_filter_sha256": "0" * 64}))
    report = cli.run(["workflow", "--config", str(tmp_path / "flow.yaml"), "--stage", "doctor"], spark)
    assert report["status"] == "fail" and len(report["errors"]) == 3
    assert R.require_https("https://host.example/a/") == "https://host.example/a"
    for bad in ("http://h", "https://", "https://u:p@h", "https://h?q=1"):
        with pytest.raises(ValueError):
            R.require_https(bad)
