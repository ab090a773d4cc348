"""Command line: ``python -m tidewell TOOL ...``.

Every tool prints one JSON report (and writes it with ``--report``); the exit
code is 0 if its status is pass, partial_pass, partial or dry_run, else 2.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import StateConflict, TidewellError
from .functions import scalars as S
from .operators import joins, ranking
from .plans import ledger as L
from .plans import planner, reports
from .plans import rules as R
from .plans.publish import Scratch, Store, json_lines, open_product, publish, publish_shards, read_shards, row_digest, shared_folder
from .schemas import CHANNELS, TOLERANCE_US, columns, metadata_rows, schema
from .serving import HistoryIndex, ImageLoader
from .sources import readers, sinks
from .sources.archives import ArchiveMembers
from .sources.ranges import FileClient, HttpClient
from .streaming.incremental import Ledger, scan_archives, wait_for, wait_for_space
from .workflow import StageState, Workflow, doctor

TOOLS: dict[str, tuple[Callable, Callable]] = {}


def tool(name: str, arguments: Callable[[argparse.ArgumentParser], None]):
    def add(run: Callable[[SparkSession, argparse.Namespace], dict]):
        TOOLS[name] = arguments, run
        return run

    return add


def flags(*names: str, **more) -> Callable[[argparse.ArgumentParser], None]:
    """Required text flags, and others with their default."""

    def add(parser: argparse.ArgumentParser) -> None:
        for name in names:
            parser.add_argument(f"--{name}", required=True)
        for name, default in more.items():
            flag = "--" + name.replace("_", "-")
            if isinstance(default, bool):
                parser.add_argument(flag, action="store_true")
            elif isinstance(default, list):
                parser.add_argument(flag, action="append", default=[])
            else:
                parser.add_argument(flag, default=default, type=str if default is None else type(default))

    return add


def _found(rules: R.Rules) -> dict[str, dict]:
    return {r["rule"]: {"violations": r["violations"], "shown": r["shown"] or []} for r in rules.summary().collect()}


def _kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    return Scratch(spark, shared_folder(spark)).keep(df, "rows")


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Plain paths of the files that a pattern names."""
    rows = spark.read.format("binaryFile").load(pattern).select(F.regexp_replace("path", "^file:/*", "/").alias("path")).orderBy("path")
    return [r["path"] for r in rows.collect()]


@tool("plan", flags("anchor-logs", "native-logs", "scene-filter", "output", inventory=None, channels=",".join(CHANNELS), anchor_token=[], max_anchors=0, filter_sha256=None, allow_other_filter=False, dry_run=False,
                    cadence_tolerance_us=TOLERANCE_US, retained_tolerance_us=TOLERANCE_US, two_hz_tolerance_us=TOLERANCE_US, history=4, future=10))
def plan(spark: SparkSession, a: argparse.Namespace) -> dict:
    """From anchor logs and native logs to a published history index and its image inventory."""
    tolerances = {k: getattr(a, k) for k in ("cadence_tolerance_us", "retained_tolerance_us", "two_hz_tolerance_us")}
    R.check_arguments(tolerances, {"--inventory": (a.inventory, ".jsonl")}, {"--max-anchors": (a.max_anchors or None, 1, 1 << 31)})
    R.reject_held_out([a.anchor_logs, a.native_logs, a.scene_filter])
    spec = readers.load_scene_filter(spark, a.scene_filter, a.history, a.future)
    if a.filter_sha256 and spec["sha256"] != a.filter_sha256 and not a.allow_other_filter:
        raise TidewellError(f"the scene filter's SHA-256 is {spec['sha256']}")
    tokens = spec["tokens"]
    if a.anchor_token:
        asked = spark.createDataFrame([(t,) for t in a.anchor_token], "token string").select(S.token_norm("token").alias("token"))
        unknown = [r[0] for r in joins.difference(asked, tokens, "token").limit(8).collect()]
        if unknown:
            raise TidewellError(f"tokens that the filter does not have: {unknown}")
        tokens = asked
    rows = readers.read_anchor_logs(spark, a.anchor_logs).join(spec["logs"], "log_name", "left_semi")
    native = readers.read_native_logs(spark, _paths(spark, a.native_logs))
    made = planner.plan_histories(spark, rows, native, tokens, spec["sha256"], R.parse_channels(a.channels), **tolerances, max_anchors=a.max_anchors or None, history=a.history, future=a.future)
    faults = _found(made.rules)
    report = {"status": reports.status(bool(faults), bool(a.max_anchors or a.anchor_token)), "violations": faults, **planner.plan_report(made), "dry_run": a.dry_run}
    if not faults and not a.dry_run:
        report["index"] = publish(spark, made.tables(), a.output, "history")["tables"]
        if a.inventory:
            json_lines(made.inventory.orderBy("blob_path")).write.mode("errorifexists").text(a.inventory)
            report["inventory"] = dict(zip(("rows", "digest"), row_digest(made.inventory)))
    made.drop()
    return report


@tool("audit", flags("index", "anchor-logs", "scene-filter", manifest_jsonl=None, image_listing=None, anchor_token=[], history=4, future=10))
def audit(spark: SparkSession, a: argparse.Namespace) -> dict:
    """An index against the raw anchor logs it claims to come from."""
    R.check_arguments(suffixes={"--manifest-jsonl": (a.manifest_jsonl, ".jsonl")})
    index, spec = HistoryIndex.open(spark, a.index), readers.load_scene_filter(spark, a.scene_filter, a.history, a.future)
    full = index.metadata.get("partial") != "true" and not a.anchor_token
    asked = spark.createDataFrame([(t,) for t in a.anchor_token], "token string").select(S.token_norm("token").alias("token")) if a.anchor_token else index.tokens()
    raw = readers.read_anchor_logs(spark, a.anchor_logs)
    rules = R.audit_rules(spark, index.tokens(), spec["tokens"], asked, index.t["anchor"], raw, full)
    if not rules.violations().isEmpty():
        return reports.audit_report(index.t["anchor"], index.t["anchor_camera"], {k: v["violations"] for k, v in _found(rules).items()}, full)
    histories = index.histories(asked)
    if a.image_listing:
        wanted = histories.select(F.explode("frames.blob_path").alias("path"))
        rules.extend(R.missing_files(spark, wanted, readers.file_listing(spark, a.image_listing)))
    if a.manifest_jsonl:
        json_lines(reports.audit_manifest(histories, spec["sha256"]).orderBy("anchor_token", "channel", "stream_index")).write.mode("errorifexists").text(a.manifest_jsonl)
    chosen = index.t["anchor"].join(asked.withColumnRenamed("token", "anchor_token"), "anchor_token", "left_semi")
    ranges = index.t["anchor_camera"].join(chosen, "anchor_token", "left_semi")
    return reports.audit_report(chosen, ranges, {k: v["violations"] for k, v in _found(rules).items()}, full)


@tool("native", flags("archive-root", "archives", "scene-filter", "output", allowed=[], dry_run=False, history=4, future=10))
def native(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Log databases of the filter's logs, extracted from ZIP archives and checked."""
    spark.dataSource.register(ArchiveMembers)
    keys = sorted(k for k in a.archives.split(",") if k)
    spec = readers.load_scene_filter(spark, a.scene_filter, a.history, a.future)
    members = spark.read.format("archive_members").options(kind="zip", root=a.archive_root, paths=",".join(keys)).load().where(S.has_suffix("member_name", ".db"))
    if a.allowed:
        sizes = spark.createDataFrame([(k, FileClient(a.archive_root).fetch(k, 0, 0).total) for k in keys], "archive_key string, listed_size bigint")
        R.archive_list_rules(spark, sizes, a.allowed).enforce("archives")
    wanted = spec["logs"].select(F.concat("log_name", F.lit(".db")).alias("file"))
    matched = joins.unique_match(wanted, members.select(S.basename("member_name").alias("file"), F.struct("archive_key", "member_name", "member_size", "crc32").alias("m")), "file", "m")
    lost = [r["file"] for r in matched.where("hits <> 1").orderBy("file").limit(8).collect()]
    if lost:
        return {"status": "fail", "error": f"databases that are not in exactly one archive: {lost}"}
    selected = matched.select("match.*").withColumnRenamed("member_size", "size")
    present = _databases(spark, a.output)
    listed = spark.createDataFrame([(name,) for name in Store(spark, a.output).list(a.output)], "path string")  # empty files too
    strange = [r["path"] for r in L.unexpected_files(listed, wanted.select(F.col("file").alias("path"))).orderBy("path").limit(8).collect()]
    if strange:
        return {"status": "fail", "error": f"databases that nobody asked for: {strange}"}
    if a.dry_run:
        return {"status": "dry_run", **reports.native_report(selected, L.existing_files(selected.withColumn("path", S.basename("member_name")), present).withColumnRenamed("reason", "status"), {"archives": keys})}
    done = _kept(spark, sinks.extract_databases(selected, a.archive_root, a.output))
    return {"status": "pass", **reports.native_report(selected, done, {"archives": keys})}


def _databases(spark: SparkSession, folder: str) -> DataFrame:
    if not Store(spark, folder).exists(folder):
        return spark.createDataFrame([], "path string, length bigint, crc32 bigint")
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.db").load(folder).select(S.basename("path").alias("path"), "length", F.crc32("content").alias("crc32"))


@tool("ledger", flags("ledger", operation="initialize", inventory=None, train_manifest=None, val_manifest=None, prefix="public", root_name="sensors", archive_root=None, state=None, offsets=None, stage_root=None, archive_key=[], max_headers=1000, max_steps=1 << 20, dry_run=False, take_over=False))
def ledger(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The target ledger: made from an inventory; its members located (offset-index) or staged as files."""
    if a.operation == "initialize":
        inventory = readers.read_inventory(spark, a.inventory)
        if Store(spark, a.ledger).exists(a.ledger):
            held = open_product(spark, a.ledger, "ledger")
            L.same_ledger(held["metadata"], inventory)
            return {"status": "pass", "targets": held["target"].count(), "resumed": True}
        targets, metadata, rules = L.build_targets(spark, inventory, readers.read_group_manifest(spark, a.train_manifest), readers.read_group_manifest(spark, a.val_manifest), a.prefix, a.root_name)
        faults = _found(rules)
        if faults or a.dry_run:
            return {"status": "fail" if faults else "dry_run", "violations": faults, "targets": targets.count()}
        publish(spark, {"target": targets, "metadata": metadata}, a.ledger, "ledger")
        return {"status": "pass", "targets": targets.count(), "resumed": False}
    if a.operation not in ("stage", "offset-index"):
        raise TidewellError(f"unknown operation {a.operation!r}")
    targets = open_product(spark, a.ledger, "ledger")["target"]
    keys = [r["archive_key"] for r in L.select_archives(L.archive_groups(targets), a.archive_key).collect()]
    targets = targets.where(F.col("archive_key").isin(keys))
    if a.dry_run:
        return {"status": "dry_run", "archives": keys, "targets": targets.count()}
    state = Ledger(spark, a.state, {"archives": {k: FileClient(a.archive_root).fetch(k, 0, 0).etag for k in keys}})
    done = False
    for _ in range(a.max_steps):
        if done := scan_archives(spark, a.archive_root, keys, state, a.max_headers, a.take_over):
            break
    located = L.locate_targets(targets, state.rows())
    progress = spark.createDataFrame([(k, "complete" if done else "partial") for k in keys], "archive_key string, status string")
    report = {"status": "pass" if done else "partial", **reports.offsets_report(located, progress)}
    if not done:
        return report
    index, rules = L.offset_index(spark, located)
    if a.operation == "offset-index":
        faults = _found(rules)
        if faults:
            return {**report, "status": "fail", "violations": faults}
        report["index"] = publish(spark, {"offset_index": index}, a.offsets, "offsets")["tables"]
        return report
    rows = index.select("archive_key", "member_name", "data_offset", "member_size", F.col("blob_path").alias("path"))
    written = sinks.extract_members(rows, a.archive_root, a.stage_root)
    counts = {r["status"]: r["count"] for r in written.groupBy("status").count().collect()}
    return {**report, "files": counts}


@tool("pack", flags("ledger", "offsets", "archive-root", "pack-root", "output", existing_root=None, existing_prefix="sensor_blobs", root_name="sensors", archive_key=[], checkpoint=sinks.CHECKPOINT, dry_run=False))
def pack(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Packs of all targets (official files are kept in place), verified and published with their state."""
    R.check_arguments(counts={"--checkpoint": (a.checkpoint, 1, 1 << 30)})
    targets, index = open_product(spark, a.ledger, "ledger")["target"], open_product(spark, a.offsets, "offsets")["offset_index"]
    keys = [r["archive_key"] for r in L.select_archives(L.archive_groups(targets), a.archive_key).collect()]
    targets = targets.where(F.col("archive_key").isin(keys))
    found = index.select("archive_key", "member_name", F.col("member_size").alias("s"), F.col("header_offset").alias("h"), F.col("data_offset").alias("d"))
    located = targets.drop("member_size", "header_offset", "data_offset").join(found, ["archive_key", "member_name"]).withColumnsRenamed({"s": "member_size", "h": "header_offset", "d": "data_offset"})
    have = spark.createDataFrame([], "path string, length bigint")
    if a.existing_root:
        have = readers.file_listing(spark, a.existing_root).select(F.concat(F.lit(a.existing_prefix + "/"), "path").alias("path"), "length")
    planned = L.plan_packs(located, have)
    if a.dry_run:
        return {"status": "dry_run", "archives": keys, "kinds": {r["storage_kind"]: r["count"] for r in planned.groupBy("storage_kind").count().collect()}}
    facts = spark.createDataFrame([(k, *_facts(a.archive_root, k)) for k in keys], "archive_key string, source_size bigint, etag string")
    stored = sinks.write_packs(planned.join(facts, "archive_key"), a.archive_root, a.pack_root, a.existing_root or a.pack_root, checkpoint=a.checkpoint).select(*columns("member_storage"))
    stored = _kept(spark, stored)  # written once: evaluating it moves bytes
    sums = stored.groupBy("archive_key").agg(
        F.count(F.lit(1)).alias("target_done"), F.count_if(F.col("storage_kind") == "pack").alias("packed_count"), F.count_if(F.col("storage_kind") == "existing").alias("existing_count"),
        F.coalesce(F.sum(F.when(F.col("storage_kind") == "pack", F.col("payload_size"))), F.lit(0)).cast("bigint").alias("pack_bytes"), F.max(F.col("data_offset") + F.col("payload_size")).alias("next_header_offset"),
    )
    wanted = targets.groupBy("archive_key").agg(F.count(F.lit(1)).alias("target_total"))
    progress = wanted.join(sums, "archive_key", "left").join(facts.withColumnRenamed("source_size", "listed_size"), "archive_key")
    progress = progress.withColumns({"pack_path": S.pack_path("archive_key"), "url": F.col("archive_key"), "headers_scanned": F.col("target_done"), "status": F.when(F.col("target_done") == F.col("target_total"), "complete").otherwise("partial")}).select(*columns("archive_progress"))
    faults = _found(R.storage_rules(spark, targets, stored, progress, a.root_name))
    report = {**reports.pack_report(progress), "violations": faults}
    if faults:
        return {**report, "status": "fail"}
    report["tables"] = publish(spark, {"member_storage": stored, "archive_progress": progress}, a.output, "pack")["tables"]
    return {**report, "status": "partial" if a.archive_key else report["status"]}


def _facts(root: str, key: str) -> tuple[int, str | None]:
    probe = FileClient(root).fetch(key, 0, 0)
    return probe.total, probe.etag


@tool("storage-index", flags("ledger", "packs", "pack-root", "output", existing_policy="trusted", archive_verification=None, member_verification=None))
def storage_index(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Where each image is stored, from the pack state of all archives and, for files in place, their native check."""
    checks = (a.archive_verification, a.member_verification)
    if a.existing_policy not in ("trusted", "verified") or (a.existing_policy == "verified") != all(checks) or any(checks) != all(checks):
        raise TidewellError("'verified' needs both verification tables, 'trusted' takes none")
    targets, held = open_product(spark, a.ledger, "ledger")["target"], open_product(spark, a.packs, "pack")
    sizes = readers.file_listing(spark, a.pack_root).select("path", "length")
    tables = [spark.read.parquet(p) if p else None for p in checks]
    index, rules = L.build_storage_index(spark, targets, held["member_storage"], held["archive_progress"], sizes, targets.select("archive_key").distinct().count(), *tables)
    faults = _found(rules)
    if faults:
        return {"status": "fail", "violations": faults}
    facts = metadata_rows(spark, {"format": "tidewell_image_storage_v1", "existing_policy": a.existing_policy, "archives": targets.select("archive_key").distinct().count()})
    return {"status": "pass", "tables": publish(spark, {"image_storage": index, "metadata": facts}, a.output, "storage")["tables"]}


def _callable(name: str) -> Callable:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


@tool("visual-audit", flags("index", "storage", "image-root", "output", samples=6, seed=0, camera_channel="CAM_F0", decoder=None))
def visual_audit(spark: SparkSession, a: argparse.Namespace) -> dict:
    """A seeded sample of histories: every frame's bytes are checked, and drawn if a decoder (module:function) is given."""
    R.check_arguments(counts={"--samples": (a.samples, 1, 200)})
    loader = ImageLoader.from_index_path(spark, a.index, a.storage, a.image_root, _callable(a.decoder) if a.decoder else None)
    ranges = loader.index.t["anchor_camera"].where(F.col("channel") == a.camera_channel).join(loader.index.t["anchor"].select("anchor_token", "log_name"), "anchor_token")
    tokens = spark.createDataFrame([(r["anchor_token"],) for r in ranking.sample_logs(ranges, a.samples, a.seed).collect()], "token string")
    records = reports.frame_records(loader.index.histories(tokens, [a.camera_channel]), loader.storage)
    report = reports.visual_manifest(reports.audit_panels(records), records, a.seed)
    images = loader.load(tokens, [a.camera_channel])
    if a.decoder:
        report["files"] = [r.asDict() for r in sinks.draw_panels(images, a.output).orderBy("path").collect()]
    else:
        report["images"] = images.count()
    store = Store(spark, a.output)
    store.replace_text(f"{a.output.rstrip('/')}/manifest.json", reports.to_document(report))
    return report


@tool("direct-export", flags("packs", "output", "base-url"))
def direct_export(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The direct index: where each image lies in its source archive."""
    held = open_product(spark, a.packs, "pack")
    archives = held["archive_progress"].withColumn("url", F.concat(F.lit(R.require_https(a.base_url) + "/"), "archive_key"))
    rows = L.direct_rows(held["member_storage"], archives)
    faults = _found(R.export_rules(spark, rows))
    if faults:
        return {"status": "fail", "violations": faults}
    facts = rows.select("archive_key", "source_url", "source_size", "etag").distinct()
    return {"status": "pass", **publish_shards(spark, rows, a.output, facts)}


@tool("direct-download", flags("direct", "output", "receipts", shard=[], provenance="all", limit=0, source_root=None, dry_run=False))
def direct_download(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Images of a direct index, fetched by ranges; what a receipt and the file itself vouch for is skipped."""
    rows = read_shards(spark, a.direct, [int(n) for n in a.shard] or None)
    if a.source_root:  # archives that lie in a folder, by their key
        rows = rows.withColumn("source_url", F.col("archive_key"))
    none = spark.createDataFrame([], schema("receipt"))
    held = spark.read.schema(schema("receipt")).parquet(a.receipts) if Store(spark, a.receipts).exists(a.receipts) else none
    if not held.isEmpty():
        root = a.output.rstrip("/")
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root) if Store(spark, root).exists(root) else None
        held = none if files is None else sinks.still_good(held, files.select(F.substring_index("path", root.rstrip("/") + "/", -1).alias("path"), F.sha2("content", 256).alias("sha256")))
    jobs = L.download_jobs(rows, held, a.provenance, a.limit or None)
    report = {"wanted": rows.count(), "skipped": held.count(), "jobs": jobs.count()}
    if a.dry_run:
        return {"status": "dry_run", **report}
    source = a.source_root
    got = sinks.download(jobs, a.output, (lambda: FileClient(source)) if source else HttpClient)
    got = _kept(spark, got)
    got.select(*columns("receipt")).write.mode("append").parquet(a.receipts)
    stats = got.agg(F.count(F.lit(1)), F.coalesce(F.sum("requests"), F.lit(0)), F.coalesce(F.sum("retries"), F.lit(0))).first()
    size = jobs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return {"status": "pass", **report, "downloaded": stats[0], "requests": stats[1], "retries": stats[2], "bytes": size}


@tool("offload", flags("packs", "pack-root", "target-root", "manifest", threshold_gb=200.0, floor_gb=100.0, poll_seconds=300.0, polls=1, watch=False, force=False, delete_source=False, dry_run=False))
def offload(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Complete packs moved to another store when a trigger holds: forced, size, packing done, or little space."""
    held = open_product(spark, a.packs, "pack")
    progress, store = held["archive_progress"], Store(spark, a.pack_root)
    listing = readers.file_listing(spark, a.pack_root).where("path like '%.pack'")
    ready = progress.where("status = 'complete'").select(F.col("pack_path").alias("path")).join(listing, "path").select("path", "length")
    total = reports.pack_report(progress)

    def reason() -> str | None:
        stored = ready.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("stored"))
        free = F.lit(store.free_bytes(a.pack_root))
        why = S.trigger_reason(F.lit(a.force), F.col("stored"), F.lit(a.threshold_gb * 1e9), F.lit(total["status"] == "pass"), free, F.lit(a.floor_gb * 1e9))
        return stored.select(why.alias("why")).first()["why"]

    if not wait_for(lambda: reason() is not None, a.poll_seconds, max(1, a.polls if a.watch else 1), time.sleep):
        return {"status": "partial", "reason": None, "packs": []}
    why = reason()
    if a.dry_run:
        return {"status": "dry_run", "reason": why, "packs": [r["path"] for r in ready.orderBy("path").collect()]}
    moved = _kept(spark, sinks.move_packs(ready, a.pack_root, a.target_root, a.delete_source))
    report = reports.offload_manifest(moved, why or "force")
    store.replace_text(a.manifest, reports.to_document(report))
    return {"status": "pass" if report["verified"] else "fail", **report}


@tool("finalize", flags("states", archives=55))
def finalize(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The newest snapshot of pack states (folders of a folder) in which all archives are complete."""
    store, all_ = Store(spark, a.states), None
    for name in store.list(a.states):
        part = open_product(spark, f"{a.states.rstrip('/')}/{name}", "pack")["archive_progress"].withColumn("snapshot", F.lit(name))
        all_ = part if all_ is None else all_.unionByName(part)
    newest = L.newest_complete(all_, a.archives) if all_ is not None else None
    return {"status": "pass" if newest else "fail", "snapshot": newest}


@tool("relay", flags("ledger", "offsets", "archive-root", "pack-root", "work-root", root_name="sensors", existing_root=None, archives_per_batch=8, min_free_gb=0.0, resume_min_free_gb=0.0, poll_seconds=300.0, polls=1, checkpoint=sinks.CHECKPOINT, dry_run=False))
def relay(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Packs in batches of archives, each when there is space; a marker is written once all are complete."""
    products = open_product(spark, a.ledger, "ledger")
    keys = [r["archive_key"] for r in L.archive_groups(products["target"]).orderBy("archive_key").collect()]
    batches = [keys[k : k + a.archives_per_batch] for k in range(0, len(keys), a.archives_per_batch)]
    if a.dry_run:
        return {"status": "dry_run", "batches": batches}
    store, work, states = Store(spark, a.work_root), a.work_root.rstrip("/"), []
    for number, batch in enumerate(batches):
        state, begun = f"{work}/states/{number:04d}", f"{work}/begun-{number:04d}"
        if not store.exists(state):
            if not wait_for_space(store, a.pack_root, int(a.min_free_gb * 1e9), int(a.resume_min_free_gb * 1e9), store.exists(begun), a.poll_seconds, a.polls, time.sleep):
                return {"status": "partial", "batches": len(states), "waiting_for": batch}
            store.replace_text(begun, json.dumps(batch))
            report = run(["pack", "--ledger", a.ledger, "--offsets", a.offsets, "--archive-root", a.archive_root, "--pack-root", a.pack_root, "--output", state, "--root-name", a.root_name, "--checkpoint", str(a.checkpoint), *(["--existing-root", a.existing_root] if a.existing_root else []), *(x for k in batch for x in ("--archive-key", k))], spark)
            if reports.exit_code(report):
                return {"status": "fail", "batch": batch, "report": report}
        states.append(state)
    whole = None
    for state in states:
        part = open_product(spark, state, "pack")["archive_progress"]
        whole = part if whole is None else whole.unionByName(part)
    marker = reports.completion_marker(whole, products["metadata"], row_digest(products["target"])[1], states)
    store.replace_text(f"{work}/complete.json", reports.to_document(marker))
    return {"status": "pass", **marker}


@tool("workflow", flags("config", stage="all"))
def workflow(spark: SparkSession, a: argparse.Namespace) -> dict:
    """doctor, status, a stage (plan, ledger, pack, finalize), or all stages that are not done."""
    flow = Workflow.load(spark, a.config)
    state = StageState(spark, flow)
    if a.stage == "doctor":
        return doctor(spark, flow)
    if a.stage == "status":
        return {"status": "pass", "stages": {k: v.get("status") for k, v in state.read().items()}}
    at = flow.at
    steps = {
        "plan": [["plan", "--anchor-logs", flow.anchor_logs, "--native-logs", flow.native_logs, "--scene-filter", flow.scene_filter, "--output", at("history"), "--inventory", at("inventory.jsonl"),
                  *(["--channels", flow.channels] if flow.channels else []), *(["--filter-sha256", flow.scene_filter_sha256] if flow.scene_filter_sha256 else [])]],
        "ledger": [["ledger", "--ledger", at("ledger"), "--inventory", at("inventory.jsonl"), "--train-manifest", flow.train_manifest, "--val-manifest", flow.val_manifest, "--prefix", flow.prefix, "--root-name", flow.root_name],
                   ["ledger", "--ledger", at("ledger"), "--operation", "offset-index", "--archive-root", flow.archive_root, "--state", at("scan"), "--offsets", at("offsets")]],
        "pack": [["pack", "--ledger", at("ledger"), "--offsets", at("offsets"), "--archive-root", flow.archive_root, "--pack-root", at("packs"), "--output", at("pack-state"), "--root-name", flow.root_name, "--checkpoint", str(flow.checkpoint),
                  *(["--existing-root", flow.existing_root] if flow.existing_root else [])]],
        "finalize": [["storage-index", "--ledger", at("ledger"), "--packs", at("pack-state"), "--pack-root", at("packs"), "--output", at("storage")]],
    }
    chosen = list(steps) if a.stage == "all" else [a.stage]
    if unknown := [s for s in chosen if s not in steps]:
        raise TidewellError(f"unknown stage {unknown[0]!r}")
    out = {}
    for name in chosen:
        def stage(name=name) -> dict:
            report: dict = {}
            for step in steps[name]:
                report = run(step, spark)
                if report["status"] != "pass":
                    break
            return {k: v for k, v in report.items() if k in ("status", "error", "violations", "targets", "anchors", "packed_count", "tables")}

        out[name] = state.run(name, stage)
        if out[name]["status"] != "pass":
            return {"status": "fail", "stages": out}
    return {"status": "pass", "stages": out}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidewell", description=__doc__)
    parts = top.add_subparsers(dest="tool", required=True)
    for name, (arguments, body) in TOOLS.items():
        one = parts.add_parser(name, help=(body.__doc__ or "").strip())
        arguments(one)
        one.add_argument("--report")
    return top


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    """The report of a tool; what it refuses is a report too."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tidewell-{a.tool}").getOrCreate()
    try:
        R.check_arguments(suffixes={"--report": (a.report, ".json")})
        report = TOOLS[a.tool][1](spark, a)
    except (TidewellError, ValueError) as error:
        report = {"status": "fail" if isinstance(error, (StateConflict, ValueError)) else "error", "error": str(error)}
    report = {"tool": a.tool, **report}
    if a.report and a.report.lower().endswith(".json"):
        Store(spark, a.report).replace_text(a.report, reports.document_parts(report))
    return report


def main(argv: list[str]) -> int:
    report = run(argv)
    sys.stdout.writelines(reports.document_parts(report))
    print()
    return reports.exit_code(report)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
