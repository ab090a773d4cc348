"""Target ledger, packs, storage index and direct index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StateConflict, TidewellError
from ..functions import scalars as S
from ..operators import joins, ranking
from ..schemas import columns, metadata_rows, schema
from . import rules as R


def build_targets(spark: SparkSession, inventory: DataFrame, train: DataFrame, val: DataFrame, prefix: str, root: str) -> tuple[DataFrame, DataFrame, R.Rules]:
    """(targets, metadata, rules): where each image of the inventory lies.  A log's split and group come from exactly one manifest."""
    groups = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    placed = inventory.select("log_name", "channel", "blob_path").distinct().join(groups, "log_name")
    key = S.archive_key("split", "group", prefix, root)
    targets = placed.select(
        key.alias("archive_key"), F.concat_ws("/", F.regexp_replace(S.basename(key), r"\.zip$", ""), S.strip_first_part("blob_path")).alias("member_name"), F.col("blob_path").alias("destination"), "log_name", "channel",
        F.lit("pending").alias("status"), *(F.lit(None).cast(schema("target")[c].dataType).alias(c) for c in ("member_size", "sha256", "header_offset", "data_offset")),
    )
    rules = R.inventory_rules(spark, inventory, train, val)
    R.unique(rules, "target", targets)
    facts = inventory.agg(F.min("scene_filter_sha256").alias("h"), F.count(F.lit(1)).alias("n")).first()
    return targets.select(*columns("target")), metadata_rows(spark, {"scene_filter_sha256": facts["h"] or "", "target_total": facts["n"]}), rules


def same_ledger(metadata: DataFrame, inventory: DataFrame) -> bool:
    """Whether a ledger was made from this inventory (then a second run has nothing to do); another inventory's ledger is a conflict."""
    held = {r["key"]: r["value"] for r in metadata.collect()}
    now = inventory.agg(F.min("scene_filter_sha256").alias("h"), F.count(F.lit(1)).alias("n")).first()
    if held.get("scene_filter_sha256") != now["h"] or int(held.get("target_total", -1)) != now["n"]:
        raise StateConflict("the ledger belongs to another inventory")
    return True


def archive_groups(targets: DataFrame) -> DataFrame:
    """(split, group) of the ledger's archives; a key in another form is an error."""
    out = targets.select("archive_key").distinct().withColumns({"split": S.archive_split("archive_key"), "group": S.archive_group("archive_key")})
    bad = out.where("split is null or group is null").limit(1).collect()
    if bad or out.isEmpty():
        raise TidewellError(f"malformed archive key {bad[0]['archive_key']!r}" if bad else "the ledger has no archives")
    return out


def select_archives(archives: DataFrame, keys: list[str] | None) -> DataFrame:
    """The archives with these keys (all if none are named), in order; an unknown key is an error."""
    if not keys:
        return archives.orderBy("archive_key")
    unknown = sorted(set(keys) - {r[0] for r in archives.where(F.col("archive_key").isin(keys)).select("archive_key").collect()})
    if unknown:
        raise TidewellError(f"unknown archives {unknown[:8]}")
    return archives.where(F.col("archive_key").isin(keys)).orderBy("archive_key")


def locate_targets(targets: DataFrame, members: DataFrame) -> DataFrame:
    """Targets with the offsets that archive members have; a target without a member stays without."""
    found = members.where("typeflag in ('0', '\\0')").select("archive_key", "member_name", F.col("member_size").alias("s"), F.col("header_offset").alias("h"), F.col("data_offset").alias("d"))
    out = targets.join(found, ["archive_key", "member_name"], "left")
    return out.withColumns({"member_size": F.coalesce("s", "member_size"), "header_offset": F.coalesce("h", "header_offset"), "data_offset": F.coalesce("d", "data_offset")}).select(*columns("target"))


def offset_index(spark: SparkSession, targets: DataFrame) -> tuple[DataFrame, R.Rules]:
    """TAR-offset index of all targets, and the rule that none is left without."""
    index = targets.where("data_offset is not null").select(F.col("destination").alias("blob_path"), "archive_key", "member_name", "header_offset", "data_offset", "member_size", "log_name", "channel")
    rules = R.Rules(spark).add("offsets.complete", targets.where("data_offset is null or member_size is null or member_size <= 0"), R.text_key("archive_key", "member_name"))
    return index, R.unique(rules, "offset_index", index)


def plan_packs(located: DataFrame, existing: DataFrame) -> DataFrame:
    """member_storage without hashes: a target whose destination exists with the member's size is kept there, the others are laid out in their pack in archive order."""
    side = existing.select(F.col("path").alias("destination"), F.col("length").alias("have"))
    rows = located.where("data_offset is not null").join(side, "destination", "left").withColumn("kept", F.coalesce(F.col("have") == F.col("member_size"), F.lit(False)))
    packed = ranking.pack_offsets(rows.where("not kept"), ["archive_key"], ["header_offset"], "member_size")
    pack = packed.select("archive_key", "member_name", "destination", F.lit("pack").alias("storage_kind"), S.pack_path("archive_key").alias("storage_path"), "pack_offset", F.col("member_size").alias("payload_size"), "header_offset", "data_offset")
    keep = rows.where("kept").select("archive_key", "member_name", "destination", F.lit("existing").alias("storage_kind"), S.strip_first_part("destination").alias("storage_path"), F.lit(None).cast("bigint").alias("pack_offset"), F.col("member_size").alias("payload_size"), "header_offset", "data_offset")
    return pack.unionByName(keep)


def pack_summary(progress: DataFrame) -> DataFrame:
    """Six sums over all archives in one pass, and states."""
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return progress.agg(
        F.count(F.lit(1)).alias("archives"), F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "partial").alias("partial"),
        *(zero(c) for c in ("target_total", "target_done", "packed_count", "existing_count", "pack_bytes", "headers_scanned")),
    )


def offsets_complete(targets: DataFrame, progress: DataFrame) -> DataFrame:
    """One row: whether the offset scan is over (all targets indexed, all archives complete)."""
    t = targets.agg(F.count(F.lit(1)).alias("total"), F.count("data_offset").alias("indexed"), F.count_if(F.col("data_offset").isNotNull() & (F.col("data_offset") != F.col("header_offset") + 512)).alias("malformed"), F.countDistinct("archive_key").alias("archives"))
    p = progress.agg(F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") != "complete").alias("open"))
    done = "total > 0 and indexed = total and malformed = 0 and complete = archives and open = 0"
    return t.join(p, F.lit(True)).withColumn("done", F.expr(done))


def build_storage_index(
    spark: SparkSession, targets: DataFrame, storage: DataFrame, progress: DataFrame, pack_sizes: DataFrame, archives: int,
    archive_verification: DataFrame | None = None, member_verification: DataFrame | None = None,
) -> tuple[DataFrame, R.Rules]:
    """(image_storage, rules).  Rows kept in place take their place and native hash from the verification, unless none is given (then they are trusted)."""
    rows = targets.select("archive_key", "member_name", "destination").join(storage.drop("destination"), ["archive_key", "member_name"])
    rules = R.Rules(spark)
    covered = joins.coverage(targets.select(*columns("target")[:3]), storage.select(*columns("target")[:3]), ["archive_key", "member_name"], ["destination"])
    rules.add("index.coverage", covered.where("class <> 'both'"), R.text_key("archive_key", "member_name"), F.col("class"))
    if member_verification is not None:
        checked = member_verification.select("archive_key", "member_name", "effective_kind", "effective_path", "effective_offset", F.col("payload_size").alias("checked_size"), "native_sha256", F.col("status").alias("checked"))
        side = rows.where("storage_kind = 'existing'").join(checked, ["archive_key", "member_name"], "left")
        rules.add("index.member", side.where("checked is null or checked not in ('certified_equal', 'backfilled') or checked_size is null or checked_size <= 0"), "destination", F.col("checked"))
        rows = _override_existing(rows, checked)
    index = rows.select(*columns("image_storage"))
    state = archive_verification.select("archive_key", F.col("status").alias("v_status"), "checked_count") if archive_verification is not None else None
    return index, rules.extend(R.storage_index_rules(spark, index, progress, pack_sizes, archives, state))


def _override_existing(rows: DataFrame, checked: DataFrame) -> DataFrame:
    joined = rows.join(checked, ["archive_key", "member_name"], "left")
    use = (F.col("storage_kind") == "existing") & F.col("checked").isNotNull()
    # a verified row takes all its fields from the verification, so that an offset may also become null
    pick = {"storage_path": "effective_path", "pack_offset": "effective_offset", "payload_size": "checked_size", "sha256": "native_sha256", "storage_kind": "effective_kind"}
    return joined.select("archive_key", "member_name", "destination", *(F.when(use, F.col(v)).otherwise(F.col(k)).alias(k) for k, v in pick.items()))


def direct_rows(storage: DataFrame, archives: DataFrame) -> DataFrame:
    """Rows of the direct index: where each image lies in its source archive.  The hash of a row kept in place is of another file, so it is left out."""
    source = archives.select("archive_key", F.col("url").alias("source_url"), F.col("listed_size").alias("source_size"), S.etag_norm("etag").alias("etag"))
    return storage.where(F.col("storage_kind").isin("pack", "existing")).join(source, "archive_key").select(
        F.col("destination").alias("path"), F.col("data_offset").alias("offset"), F.col("payload_size").alias("size"), F.when(F.col("storage_kind") == "pack", F.col("sha256")).alias("sha256"),
        "header_offset", "archive_key", "source_url", "source_size", "etag",
    )


def download_jobs(rows: DataFrame, receipts: DataFrame, provenance: str = "all", limit: int | None = None) -> DataFrame:
    """Rows still to fetch, in path order: filtered by hash provenance (native, unverified, all), without those whose receipt carries the same identity."""
    if provenance not in ("native", "unverified", "all"):
        raise TidewellError(f"unknown provenance {provenance!r}")
    chosen = rows if provenance == "all" else rows.where(F.col("sha256").isNotNull() if provenance == "native" else F.col("sha256").isNull())
    row = F.concat(F.lit('{"offset": '), F.col("offset"), F.lit(', "path": "'), "path", F.lit('", "sha256": '), F.coalesce(F.concat(F.lit('"'), "sha256", F.lit('"')), F.lit("null")), F.lit(', "size": '), F.col("size"), F.lit("}"))
    wanted = chosen.withColumn("identity", S.identity_digest("source_url", "etag", "source_size", row))
    todo = joins.to_fetch(wanted, receipts)
    return ranking.prefix(todo, ["path"], limit) if limit is not None else todo


def newest_complete(states: DataFrame, archives: int) -> str | None:
    """Latest snapshot in which all archives are complete, each once (column ``snapshot`` beside the progress columns)."""
    good = states.groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("archive_key").alias("keys"), F.bool_and((F.col("status") == "complete") & (F.col("target_done") == F.col("target_total"))).alias("done")
    )
    row = good.where((F.col("n") == archives) & (F.col("keys") == archives) & F.col("done")).agg(F.max("snapshot")).first()
    return row[0]


def existing_files(members: DataFrame, listing: DataFrame) -> DataFrame:
    """Why a file has to be fetched again: missing, size_mismatch, crc_mismatch; or validated.  ``listing`` has path, length and crc32."""
    side = listing.select("path", F.col("length").alias("have"), F.col("crc32").alias("crc_have"))
    out = members.join(side, "path", "left")
    return out.withColumn("reason", F.when(F.col("have").isNull(), "missing").when(F.col("have") != F.col("size"), "size_mismatch").when(F.col("crc_have") != F.col("crc32"), "crc_mismatch").otherwise("validated")).drop("have", "crc_have")


def unexpected_files(listing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Database files in a folder that no request names."""
    return listing.where(S.has_suffix("path", ".db")).join(wanted.select("path"), "path", "left_anti")
