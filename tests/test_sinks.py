"""Packs, extraction and downloads on files; report documents."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.test_archives import make_tar
from tidewell.errors import ArchiveError
from tidewell.plans import reports
from tidewell.plans import rules as R
from tidewell.plans.ledger import plan_packs
from tidewell.schemas import columns, schema
from tidewell.sources.archives import ArchiveMembers
from tidewell.sources.ranges import FileClient
from tidewell.sources.sinks import download, extract_members, safe_target, still_good, write_packs, write_whole

ROOT = "sensors"


def image(n):
    return b"\xff\xd8" + bytes([n]) * (n + 3) + b"\xff\xd9"


@pytest.fixture
def archive(spark, tmp_path):
    key = f"train_set/{ROOT}_train_camera_7.zip"
    (tmp_path / "src/train_set").mkdir(parents=True)
    (tmp_path / "src" / key).write_bytes(make_tar([(f"r/l/CAM_F0/{n}.jpg", image(n)) for n in range(4)]))
    spark.dataSource.register(ArchiveMembers)
    members = spark.read.format("archive_members").options(root=str(tmp_path / "src"), paths=key).load()
    located = members.withColumns({"destination": F.concat(F.lit("sensor_blobs/"), F.regexp_replace("member_name", "^r/", ""))})
    return key, located


def test_packs(spark, tmp_path, archive):
    key, located = archive
    (tmp_path / "have/l/CAM_F0").mkdir(parents=True)
    (tmp_path / "have/l/CAM_F0/1.jpg").write_bytes(image(1))
    existing = spark.createDataFrame([("sensor_blobs/l/CAM_F0/1.jpg", len(image(1)))], "path string, length bigint")
    plan = plan_packs(located, existing)
    stored = write_packs(plan, str(tmp_path / "src"), str(tmp_path / "packs"), str(tmp_path / "have")).select(*columns("member_storage"))
    rows = {r["member_name"]: r for r in stored.collect()}
    pack = (tmp_path / "packs" / f"train_set/{ROOT}_train_camera_7.pack").read_bytes()
    assert pack == image(0) + image(2) + image(3)
    for n in (0, 2, 3):
        r = rows[f"r/l/CAM_F0/{n}.jpg"]
        assert pack[r["pack_offset"] : r["pack_offset"] + r["payload_size"]] == image(n) and r["sha256"] == hashlib.sha256(image(n)).hexdigest()
    assert rows["r/l/CAM_F0/1.jpg"]["storage_kind"] == "existing" and rows["r/l/CAM_F0/1.jpg"]["pack_offset"] is None
    progress = spark.createDataFrame([(key, "u", 9, "e", 0, 4, 4, 4, 3, 1, f"train_set/{ROOT}_train_camera_7.pack", len(pack), "complete")], schema("archive_progress"))
    R.storage_rules(spark, located.select("archive_key", "member_name", "destination"), stored, progress, ROOT).enforce("pack")
    report = reports.pack_report(progress)
    assert (report["status"], report["packed_count"], report["pack_bytes"]) == ("pass", 3, len(pack))
    (tmp_path / "have/l/CAM_F0/1.jpg").write_bytes(b"\xff\xd8" + bytes(len(image(1)) - 2))
    with pytest.raises(Exception, match="not a whole JPEG"):
        write_packs(plan, str(tmp_path / "src"), str(tmp_path / "packs2"), str(tmp_path / "have")).collect()


def test_extraction_and_download(spark, tmp_path, archive):
    key, located = archive
    rows = located.select("archive_key", "member_name", "data_offset", "member_size", F.col("member_name").alias("path"))
    run = lambda: {r["path"]: r["status"] for r in extract_members(rows, str(tmp_path / "src"), str(tmp_path / "out")).collect()}
    assert set(run().values()) == {"written"} and set(run().values()) == {"verified"}
    (tmp_path / "out/r/l/CAM_F0/2.jpg").write_bytes(b"other")
    with pytest.raises(Exception, match="other bytes"):
        run()
    root = str(tmp_path / "src")
    jobs = located.select(F.col("destination").alias("path"), F.col("archive_key").alias("source_url"), F.col("data_offset").alias("offset"), F.col("member_size").alias("size"), F.lit(None).cast("string").alias("sha256"), F.lit("id").alias("identity"))
    receipts = spark.createDataFrame(download(jobs, str(tmp_path / "dl"), lambda: FileClient(root)).collect())
    assert receipts.count() == 4 and (tmp_path / "dl/sensor_blobs/l/CAM_F0/3.jpg").read_bytes() == image(3)
    assert reports.download_report(jobs, receipts) == {"wanted": 4, "downloaded": 4, "bytes": sum(len(image(n)) for n in range(4))}
    good = still_good(receipts, receipts.select("path", F.when(F.col("path").endswith("3.jpg"), "x").otherwise(F.col("sha256")).alias("sha256")))
    assert good.count() == 3
    with pytest.raises(Exception, match="SHA-256 differs"):
        download(jobs.withColumn("sha256", F.lit("0" * 64)), str(tmp_path / "dl2"), lambda: FileClient(root)).collect()


def test_targets_stay_below_their_root(tmp_path):
    (tmp_path / "root").mkdir()
    (tmp_path / "root/link").symlink_to(tmp_path)
    for bad in ("../x", "/x", "link/x", "a/../../x"):
        with pytest.raises(ArchiveError):
            safe_target(str(tmp_path / "root"), bad)

    def broken():
        yield b"half"
        raise OSError("lost")

    with pytest.raises(OSError):
        write_whole(str(tmp_path / "root/file"), broken())
    assert sorted(p.name for p in (tmp_path / "root").iterdir()) == ["link"]


def test_audit_tables(spark):
    frames = [(k, f"t{k}", 1000 + 100 * k, f"p{k}") for k in range(4)]
    histories = spark.createDataFrame([("a", "l", "CAM_F0", 1300, "t0", "t3", frames)], "anchor_token string, log_name string, channel string, anchor_ts_us bigint, start_image_token string, end_image_token string, frames array<struct<stream_index:bigint,image_token:string,image_ts_us:bigint,blob_path:string>>")
    storage = spark.createDataFrame([(f"p{k}", "existing" if k in (0, 3) else "pack", "s") for k in range(4)], "destination string, storage_kind string, sha256 string")
    manifest = reports.audit_manifest(histories, "f").orderBy("stream_index").collect()
    assert [(r["image_offset_us"], r["retained"]) for r in manifest] == [(-300, True), (-200, False), (-100, False), (0, True)]
    records = reports.frame_records(histories, storage)
    assert [(r["position"], r["delta_us"], r["relative_us"]) for r in records.orderBy("position").collect()] == [(0, None, -300), (1, 100, -200), (2, 100, -100), (3, 100, 0)]
    assert reports.audit_panels(records).first()["sound"]
    assert not reports.audit_panels(records.where("position > 0")).first()["sound"]
    assert reports.status(False, True) == "partial_pass" and reports.to_document({"b": 1, "a": None}).startswith('{\n  "a": null')
