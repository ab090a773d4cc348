"""Ledger, packs, storage index, direct index, and one broken row for each rule."""

import pytest
from pyspark.sql import functions as F

from tidewell.errors import RuleViolation, SchemaMismatch, StateConflict, TidewellError
from tidewell.functions import scalars as S
from tidewell.plans import ledger as L
from tidewell.plans import rules as R
from tidewell.plans.publish import export_shards, json_lines, publish, streamed_digest
from tidewell.schemas import FORMATS, columns, metadata_rows, schema, validate_schema
from tidewell.sources import readers

SHA = "b" * 64
PREFIX, ROOT = "public/splits", "sensors"
KEY = f"{PREFIX}/train_set/{ROOT}_train_camera_7.zip"


def inventory(spark, **change):
    rows = [dict(format=FORMATS["inventory"], scene_filter_sha256=SHA, log_name=log, channel="CAM_F0", filename=f"{log}.jpg", image_token="a", image_ts_us=1, camera_token="c", blob_path=f"sensor_blobs/{log}/CAM_F0/{log}.jpg", anchor_reference_count=1) for log in ("log_train", "log_val")]
    rows[0].update(change)
    return spark.createDataFrame([tuple(r[c] for c in columns("inventory")) for r in rows], schema("inventory"))


def groups(spark):
    return spark.createDataFrame([("log_train", 7)], "log_name string, group bigint"), spark.createDataFrame([("log_val", 3)], "log_name string, group bigint")


def broken(rules):
    return {r["rule"] for r in rules.violations().collect()}


def test_targets(spark):
    targets, metadata, rules = L.build_targets(spark, inventory(spark), *groups(spark), PREFIX, ROOT)
    rules.enforce("ledger")
    got = {r["log_name"]: r for r in targets.collect()}
    assert got["log_train"]["archive_key"] == KEY and got["log_train"]["member_name"] == f"{ROOT}_train_camera_7/log_train/CAM_F0/log_train.jpg" and got["log_train"]["status"] == "pending"
    assert {(r["split"], r["group"]) for r in L.archive_groups(targets).collect()} == {("train", 7), ("val", 3)}
    assert L.same_ledger(metadata, inventory(spark))
    with pytest.raises(StateConflict):
        L.same_ledger(metadata, inventory(spark).limit(1))
    assert [r["archive_key"] for r in L.select_archives(targets.select("archive_key"), [KEY]).collect()] == [KEY]
    with pytest.raises(TidewellError):
        L.select_archives(targets.select("archive_key"), ["other"])
    with pytest.raises(TidewellError):
        L.archive_groups(targets.withColumn("archive_key", F.lit("public/train_set/x_train_camera_07.zip")))


@pytest.mark.parametrize("rule, change", [("inventory.filter", dict(scene_filter_sha256="c" * 64)), ("inventory.path", dict(filename="../x.jpg")), ("inventory.split", dict(log_name="log_val", blob_path="x")), ("inventory.split", dict(log_name="other", filename="log_train.jpg"))])
def test_inventory_rules(spark, rule, change):
    train, val = groups(spark)
    if change.get("log_name") == "log_val":
        train = train.unionByName(val)
    assert rule in broken(R.inventory_rules(spark, inventory(spark, **change), train, val))


def state(spark, size=123, offset=0, kind="pack", **row):
    target = spark.createDataFrame([(KEY, "m.jpg", "sensor_blobs/a/CAM_F0/m.jpg", "a", "CAM_F0", "pending", None, None, None, None)], schema("target"))
    held = dict(archive_key=KEY, member_name="m.jpg", destination="sensor_blobs/a/CAM_F0/m.jpg", storage_kind=kind, storage_path=f"train_set/{ROOT}_train_camera_7.pack", pack_offset=offset, payload_size=123, sha256=SHA, header_offset=0, data_offset=512) | row
    storage = spark.createDataFrame([tuple(held[c] for c in columns("member_storage"))], schema("member_storage"))
    progress = spark.createDataFrame([(KEY, "u", 9999, '"e"', 1024, 1, 1, 1, 1, 0, f"train_set/{ROOT}_train_camera_7.pack", size, "complete")], schema("archive_progress"))
    return target, storage, progress


def test_storage_rules(spark):
    assert broken(R.storage_rules(spark, *state(spark), ROOT)) == set()
    for rule, change in (("pack.tiling", dict(size=124)), ("pack.tiling", dict(offset=1)), ("pack.row", dict(data_offset=513)), ("pack.row", dict(sha256="x")), ("pack.kind", dict(kind="existing")), ("pack.coverage", dict(destination="other")), ("pack.kind", dict(storage_path="other.pack"))):
        assert rule in broken(R.storage_rules(spark, *state(spark, **change), ROOT)), (rule, change)
    target, storage, progress = state(spark)
    assert "pack.complete" in broken(R.storage_rules(spark, target, storage, progress.withColumn("status", F.lit("partial")), ROOT))
    assert "pack.path" in broken(R.storage_rules(spark, target, storage, progress.withColumn("pack_path", F.lit("../x.pack")), ROOT))


def test_storage_index(spark):
    target, storage, progress = state(spark)
    sizes = spark.createDataFrame([(f"train_set/{ROOT}_train_camera_7.pack", 123)], "path string, length bigint")
    index, rules = L.build_storage_index(spark, target, storage, progress, sizes, 1)
    rules.enforce("storage")
    assert index.first()["pack_offset"] == 0
    assert "index.bounds" in broken(L.build_storage_index(spark, target, storage, progress, sizes.withColumn("length", F.lit(122)), 1)[1])
    assert "index.archives" in broken(L.build_storage_index(spark, target, storage, progress, sizes, 2)[1])
    target, storage, progress = state(spark, kind="existing", pack_offset=None)
    members = spark.createDataFrame([(KEY, "m.jpg", "d", "supplemental_pack", "s.pack", 4, 50, "d" * 64, "backfilled")], schema("member_verification"))
    archive = spark.createDataFrame([(KEY, "complete", 0, 0)], schema("archive_verification"))
    more = sizes.unionByName(spark.createDataFrame([("s.pack", 54)], "path string, length bigint"))
    index, rules = L.build_storage_index(spark, target, storage, progress, more, 1, archive, members)
    rules.enforce("storage")
    row = index.first()
    assert (row["storage_kind"], row["storage_path"], row["pack_offset"], row["payload_size"], row["sha256"]) == ("supplemental_pack", "s.pack", 4, 50, "d" * 64)
    assert "index.member" in broken(L.build_storage_index(spark, target, storage, progress, more, 1, archive, members.withColumn("status", F.lit("failed")))[1])
    assert "index.verified" in broken(L.build_storage_index(spark, target, storage, progress, more, 1, archive.withColumn("checked_count", F.lit(9)), members)[1])


def test_packs_from_offsets(spark):
    targets, _, _ = L.build_targets(spark, inventory(spark), *groups(spark), PREFIX, ROOT)
    members = targets.select("archive_key", "member_name", F.lit("0").alias("typeflag"), F.lit(42).alias("member_size"), F.lit(1024).alias("header_offset"), F.lit(1536).alias("data_offset"))
    located = L.locate_targets(targets, members)
    index, rules = L.offset_index(spark, located)
    rules.enforce("offsets")
    assert {(r["header_offset"], r["data_offset"], r["member_size"]) for r in index.collect()} == {(1024, 1536, 42)}
    assert "offsets.complete" in broken(L.offset_index(spark, L.locate_targets(targets, members.limit(1)))[1])
    existing = spark.createDataFrame([("sensor_blobs/log_val/CAM_F0/log_val.jpg", 42)], "path string, length bigint")
    packs = {r["destination"][-12:]: r for r in L.plan_packs(located, existing).collect()}
    kinds = {r["storage_kind"]: r for r in packs.values()}
    assert kinds["pack"]["pack_offset"] == 0 and kinds["existing"]["pack_offset"] is None and kinds["existing"]["storage_path"] == "log_val/CAM_F0/log_val.jpg"
    progress = spark.createDataFrame([(KEY, "complete"), ("k2", "complete")], "archive_key string, status string")
    assert L.offsets_complete(located, progress).first()["done"] and not L.offsets_complete(targets, progress).first()["done"]


def test_direct_rows_and_receipts(spark, tmp_path):
    _, storage, _ = state(spark)
    archives = spark.createDataFrame([(KEY, "https://x/y", 9999, 'W/"e"')], "archive_key string, url string, listed_size bigint, etag string")
    rows = L.direct_rows(storage, archives)
    R.export_rules(spark, rows).enforce("export")
    assert "export.bounds" in broken(R.export_rules(spark, rows.withColumn("source_size", F.lit(600))))
    assert rows.first()["etag"] == "e"
    none = spark.createDataFrame([], schema("receipt"))
    todo = L.download_jobs(rows, none)
    receipt = todo.select("path", "identity", "sha256")
    assert todo.count() == 1 and L.download_jobs(rows, receipt).count() == 0
    assert L.download_jobs(rows.withColumn("etag", F.lit("new")), receipt).count() == 1
    assert L.download_jobs(rows, none, "unverified").count() == 0 and L.download_jobs(rows, none, "native", limit=1).count() == 1
    import hashlib
    import json

    r = rows.first()
    want = json.dumps(["https://x/y", "e", 9999, {"offset": r["offset"], "path": r["path"], "sha256": r["sha256"], "size": r["size"]}], sort_keys=True)
    assert todo.first()["identity"] == hashlib.sha256(want.encode()).hexdigest()
    export_shards(rows.select("archive_key", "path", "offset", "size", "sha256"), str(tmp_path / "shards"), "archive_key")
    back = spark.read.text(str(tmp_path / "shards")).select(F.from_json("value", "offset bigint, path string, sha256 string, size bigint").alias("r")).select("r.*")
    assert back.first()["offset"] == 512
    with pytest.raises(Exception, match="(?i)exist"):
        export_shards(rows.select("archive_key", "path", "offset", "size", "sha256"), str(tmp_path / "shards"), "archive_key")


def test_snapshots_and_files(spark):
    rows = [("001", f"k{k}", "running" if k < 3 else "complete", 1, 1) for k in range(5)] + [("002", f"k{k}", "complete", 1, 1) for k in range(5)] + [("003", "k0", "complete", 1, 1)]
    assert L.newest_complete(spark.createDataFrame(rows, "snapshot string, archive_key string, status string, target_total int, target_done int"), 5) == "002"
    members = spark.createDataFrame([("a.db", 1, 5), ("b.db", 1, 5), ("c.db", 1, 5), ("d.db", 1, 5)], "path string, size bigint, crc32 bigint")
    listing = spark.createDataFrame([("b.db", 2, 5), ("c.db", 1, 6), ("d.db", 1, 5), ("x.db", 1, 1), ("x.txt", 1, 1)], "path string, length bigint, crc32 bigint")
    assert {r["path"]: r["reason"] for r in L.existing_files(members, listing).collect()} == {"a.db": "missing", "b.db": "size_mismatch", "c.db": "crc_mismatch", "d.db": "validated"}
    assert [r["path"] for r in L.unexpected_files(listing, members).collect()] == ["x.db"]
    assert broken(R.missing_files(spark, members, listing)) == {"file.missing"}


def test_image_and_listing_rules(spark):
    good = b"\xff\xd8body\xff\xd9"
    rows = [("a.jpg", good, None), ("b.jpg", b"\xff\xd8body", None), ("c.png", good, None), ("d.jpg", good, SHA), ("../e.jpg", good, None), ("f.jpg", b"", None)]
    found = R.image_rules(spark, spark.createDataFrame(rows, "member_name string, content binary, sha256 string")).violations().collect()
    assert {(r["rule"], r["key"]) for r in found} >= {("image.markers", "b.jpg"), ("image.name", "c.png"), ("image.sha256", "d.jpg"), ("image.name", "../e.jpg"), ("image.size", "f.jpg")}
    assert not [r for r in found if r["key"] == "a.jpg"]
    archives = spark.createDataFrame([("a", 5, '"e"'), ("b", 5, '"e"'), ("c", 5, '"e"')], "archive_key string, listed_size bigint, etag string")
    listing = spark.createDataFrame([("a", 5, 'W/"e"'), ("b", 6, '"e"')], "archive_key string, listed_size bigint, etag string")
    assert {(r["rule"], r["key"]) for r in R.listing_rules(spark, archives, listing).violations().collect()} == {("archive.listed", "c"), ("archive.unchanged", "b")}


def test_readers(spark, tmp_path):
    lines = json_lines(inventory(spark))
    lines.coalesce(1).write.text(str(tmp_path / "inv"))
    assert readers.read_inventory(spark, str(tmp_path / "inv")).count() == 2
    for text in ("{}\n\n{}", "nonsense\n", "[1]"):
        (tmp_path / "bad.jsonl").write_text(text)
        with pytest.raises(SchemaMismatch, match="bad.jsonl:1"):
            readers.read_inventory(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "groups.txt").write_text("File group: 7\nlog_train\n\nFile group: 3\nlog-b\nlog.c\n")
    assert {(r["log_name"], r["group"]) for r in readers.read_group_manifest(spark, str(tmp_path / "groups.txt")).collect()} == {("log_train", 7), ("log-b", 3), ("log.c", 3)}
    for text in ("log\nFile group: 1\n", "File group: x\nlog\n", "File group: 1\na\na\n", "File group: 1\na b\n", ""):
        (tmp_path / "groups.txt").write_text(text)
        with pytest.raises(SchemaMismatch):
            readers.read_group_manifest(spark, str(tmp_path / "groups.txt"))
    page = '<ListBucketResult xmlns="http://x"><Contents><Key>a.zip</Key><Size>5</Size><ETag>"e"</ETag></Contents><Contents><Key>b.zip</Key><Size>6</Size><ETag>"f"</ETag></Contents></ListBucketResult>'
    got = readers.parse_listing(spark.createDataFrame([(page,)], "page string")).collect()
    assert [(r["archive_key"], r["listed_size"], r["etag"]) for r in got] == [("a.zip", 5, "e"), ("b.zip", 6, "f")]
    assert list(readers.list_pages(lambda t: ("p", None if t == "2" else "2"))) == ["p", "p"]
    with pytest.raises(TidewellError):
        list(readers.list_pages(lambda t: ("p", "same")))
    import pickle

    with pytest.raises(pickle.UnpicklingError):
        readers.load_plain_pickle(pickle.dumps([len]))
    (tmp_path / "log_a.pkl").write_bytes(pickle.dumps([{"token": b"\x0a", "timestamp": 5, "log_name": "log_a", "log_token": "AB", "scene_token": "c", "lidar_path": "x.pcd", "cams": {"CAM_F0": {"data_path": "p.jpg"}}}]))
    row = readers.read_anchor_logs(spark, str(tmp_path / "log_a.pkl")).first()
    assert (row["log_name"], row["row_index"], row["token"], row["log_token"], row["cams"]["CAM_F0"]["data_path"]) == ("log_a", 0, "0a", "ab", "p.jpg")


def test_native_databases(spark, tmp_path):
    import sqlite3

    db = sqlite3.connect(tmp_path / "log_a.db")
    db.executescript("CREATE TABLE log(token BLOB, logfile TEXT); CREATE TABLE lidar_pc(token BLOB, timestamp INTEGER, scene_token BLOB, filename TEXT); CREATE TABLE camera(token BLOB, channel TEXT); CREATE TABLE image(token BLOB, timestamp INTEGER, filename_jpg TEXT, camera_token BLOB);")
    db.execute("INSERT INTO log VALUES (x'bb', 'log_a')")
    db.execute("INSERT INTO camera VALUES (x'01', 'CAM_F0')")
    db.executemany("INSERT INTO image VALUES (?, ?, ?, x'01')", [(bytes([k]), 100_000 * k, f"{k}.jpg") for k in (3, 1, 2)])
    db.commit()
    native = readers.read_native_logs(spark, [str(tmp_path / "log_a.db")])
    assert native.log.first()["log_name"] == "log_a"
    assert [(r["stream_index"], r["image_token"]) for r in native.stream(["CAM_F0"]).orderBy("stream_index").collect()] == [(0, "01"), (1, "02"), (2, "03")]


def test_schemas_and_metadata(spark):
    df = spark.createDataFrame([("k", "v", 1)], "key string, value string, more int")
    assert validate_schema(df, "metadata").columns == ["key", "value"]
    with pytest.raises(SchemaMismatch):
        validate_schema(df.drop("value"), "metadata")
    with pytest.raises(SchemaMismatch):
        validate_schema(df.withColumn("value", F.lit(1.5)), "metadata")
    assert {r["key"]: r["value"] for r in metadata_rows(spark, {"a": True, "b": 3}).collect()} == {"a": "true", "b": "3"}
    with pytest.raises(TypeError):
        metadata_rows(spark, {"a": [1]})


def test_scalars(spark):
    df = spark.range(1).select(
        S.omitted_frames(F.lit(250_000), 100_000).alias("a"), S.omitted_frames(F.lit(350_000), 100_000).alias("b"), S.omitted_frames(F.lit(50_000), 100_000).alias("c"),
        S.etag_norm(F.lit('W/"x"')).alias("d"), S.etag_norm(F.lit('"x')).alias("e"), S.etag_norm(F.lit('""')).alias("f"), S.truthy(F.lit(" YES ")).alias("g"), S.truthy(F.lit(None).cast("string")).alias("h"),
        S.metadata_int(F.lit(None).cast("string"), 5).alias("i"), S.metadata_int(F.lit("-1"), 5).alias("j"), S.hex_token(F.lit(b"\x0a\xff")).alias("k"), S.tar_number(F.lit(b"\x80" + bytes(9) + b"\x01\x00")).alias("l"),
        S.blob_path(F.lit("l"), F.lit("CAM_F0"), F.lit("CAM_F0/x.JPG")).alias("m"), S.blob_path(F.lit("l"), F.lit("CAM_F0"), F.lit("other/x.jpg")).alias("n"), S.utc_stamp(F.lit(1_000_000)).alias("o"),
        S.trigger_reason(F.lit(False), F.lit(86), F.lit(200), F.lit(False), F.lit(476), F.lit(500)).alias("p"), S.trigger_reason(F.lit(False), F.lit(86), F.lit(200), F.lit(False), F.lit(501), F.lit(500)).alias("q"),
        S.pack_path(F.lit(KEY)).alias("r"), S.is_pack_path(F.lit(f"val_set/{ROOT}_val_camera_1.pack"), ROOT).alias("s"), S.is_pack_path(F.lit(f"val_set/{ROOT}_train_camera_1.pack"), ROOT).alias("t"),
    )
    assert tuple(df.first()) == (1, 3, 0, "x", '"x', None, True, False, 5, None, "0aff", 256, "sensor_blobs/l/CAM_F0/x.JPG", None, "1970-01-01T00:00:01Z", "relay_space_pressure", None, f"train_set/{ROOT}_train_camera_7.pack", True, False)
    for path, safe in (("a/b.jpg", True), ("/a", False), ("a//b", False), ("a/../b", False), ("./a", False), ("a\\b", False), ("", False), ("C:/x", False), ("..a/b", True)):
        assert spark.range(1).select(S.is_safe_path(F.lit(path))).first()[0] is safe, path


def test_driver_side_checks():
    assert R.parse_channels("cam_f0, CAM_B0") == ["CAM_F0", "CAM_B0"]
    for bad in ("", "CAM_F0,CAM_F0", "CAM_X"):
        with pytest.raises(ValueError):
            R.parse_channels(bad)
    R.reject_held_out(["/data/latest/x"])
    with pytest.raises(ValueError):
        R.reject_held_out(["/data/test/x"])


def test_publish_discards_on_violation(spark, tmp_path):
    rows = spark.createDataFrame([(KEY, "m", "d", "pack", "p", 0, 1, SHA)] * 2, "archive_key string, member_name string, destination string, storage_kind string, storage_path string, pack_offset bigint, payload_size bigint, sha256 string")
    with pytest.raises(RuleViolation):
        publish(spark, {"image_storage": rows}, str(tmp_path / "s"), "storage", lambda t: R.unique(R.Rules(spark), "image_storage", t["image_storage"]))
    assert list(tmp_path.iterdir()) == []
    import hashlib

    assert streamed_digest(rows.limit(1), ["destination"], "destination") == hashlib.sha256(b"d\n").hexdigest()


def test_scene_filter_and_listing(spark, tmp_path):
    import hashlib

    text = "num_history_frames: 4\nnum_future_frames: 10\nlog_names: [log_a, log_b]\ntokens: [AB, cd]\n"
    (tmp_path / "f.yaml").write_text(text)
    got = readers.load_scene_filter(spark, str(tmp_path / "f.yaml"), 4, 10)
    assert got["sha256"] == hashlib.sha256(text.encode()).hexdigest() and {r[0] for r in got["tokens"].collect()} == {"ab", "cd"}
    with pytest.raises(SchemaMismatch):
        readers.load_scene_filter(spark, str(tmp_path / "f.yaml"), 3, 10)
    (tmp_path / "files/a").mkdir(parents=True)
    (tmp_path / "files/a/x.jpg").write_bytes(b"123")
    assert [(r["path"], r["length"]) for r in readers.file_listing(spark, str(tmp_path / "files")).collect()] == [("a/x.jpg", 3)]
    assert readers.file_hashes(spark, str(tmp_path / "files/a/x.jpg")).first()["sha256"] == hashlib.sha256(b"123").hexdigest()


def test_audit_rules(spark):
    token = lambda *names: spark.createDataFrame([(n,) for n in names], "token string")
    anchors = spark.createDataFrame([("aa", "l", "bb", "cc", 5, 3)], "anchor_token string, log_name string, log_token string, scene_token string, anchor_ts_us bigint, row_index bigint")
    raw = spark.createDataFrame([("AA", "l", "BB", "CC", 5, 3)], "token string, log_name string, log_token string, scene_token string, ts_us bigint, row_index bigint")
    assert broken(R.audit_rules(spark, token("aa"), token("aa"), token("aa"), anchors, raw, True)) == set()
    found = broken(R.audit_rules(spark, token("aa", "zz"), token("aa", "bb"), token("yy"), anchors, raw.withColumn("ts_us", F.lit(6)), True))
    assert found == {"audit.official", "audit.requested", "audit.full", "audit.provenance"}
