"""Report documents: one-row aggregates, and the tables they are made of."""

from __future__ import annotations

import json
import struct
import tempfile
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import FORMATS
from .ledger import offsets_complete, pack_summary


def status(failed: bool, partial: bool) -> str:
    return "fail" if failed else "partial_pass" if partial else "pass"


def one_row(df: DataFrame) -> dict:
    return df.first().asDict(recursive=True)


class Histogram(Mapping):
    """Counts by integer, of a table (value, count) of any size, in the order of the values' text.

    The table is read once, a partition at a time, into a temporary file of the
    driver with 16 bytes an entry; so it outlives what it was made of.
    """

    ENTRY = struct.Struct("<qq")

    def __init__(self, table: DataFrame):
        self.file, self.size = tempfile.TemporaryFile(), 0
        value = table.columns[0]
        for row in table.orderBy(F.col(value).cast("string")).toLocalIterator():
            self.file.write(self.ENTRY.pack(*row))
            self.size += 1

    def _at(self, i: int) -> tuple[str, int]:
        self.file.seek(i * self.ENTRY.size)
        value, count = self.ENTRY.unpack(self.file.read(self.ENTRY.size))
        return str(value), count

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        return (key for key, _ in self.entries())

    def __getitem__(self, key: str) -> int:
        lo, hi = 0, self.size
        while lo < hi:
            mid = (lo + hi) // 2
            found, count = self._at(mid)
            if found == key:
                return count
            lo, hi = (mid + 1, hi) if found < key else (lo, mid)
        raise KeyError(key)

    def entries(self, block: int = 4096) -> Iterator[tuple[str, int]]:
        """All entries, read by blocks."""
        for lo in range(0, self.size, block):
            self.file.seek(lo * self.ENTRY.size)
            for value, count in self.ENTRY.iter_unpack(self.file.read(block * self.ENTRY.size)):
                yield str(value), count


def document_parts(report: dict) -> Iterator[str]:
    """The document in parts of bounded size: JSON with sorted keys; a histogram is never held as a whole."""
    for i, key in enumerate(sorted(report)):
        yield f"{',' if i else '{'}\n  {json.dumps(key)}: "
        value = report[key]
        if isinstance(value, Histogram):
            for j, (k, n) in enumerate(value.entries()):
                yield f'{"," if j else "{"}\n    "{k}": {n}'
            yield "\n  }" if len(value) else "{}"
        else:
            yield json.dumps(value, sort_keys=True, indent=2).replace("\n", "\n  ")
    yield "\n}" if report else "{}"


def to_document(report: dict) -> str:
    return "".join(document_parts(report))


def ledger_report(targets: DataFrame, progress: DataFrame) -> dict:
    counts = {r["status"]: r["count"] for r in targets.groupBy("status").count().collect()}
    return {"format": FORMATS["ledger"], "targets": counts, "archives": {r["status"]: r["count"] for r in progress.groupBy("status").count().collect()}, "target_archives": targets.agg(F.countDistinct("archive_key")).first()[0]}


def pack_report(progress: DataFrame) -> dict:
    total = one_row(pack_summary(progress))
    done = total["archives"] > 0 and total["complete"] == total["archives"]
    return {"format": FORMATS["pack"], "status": "pass" if done else "partial", **total}


def offsets_report(targets: DataFrame, progress: DataFrame) -> dict:
    return {"format": FORMATS["offsets"], **one_row(offsets_complete(targets, progress))}


def selection_report(members: DataFrame) -> DataFrame:
    """Per archive: members and bytes selected."""
    return members.groupBy("archive_key").agg(F.count(F.lit(1)).alias("members"), F.sum("size").cast("bigint").alias("bytes"))


def audit_manifest(histories: DataFrame, scene_filter_sha256: str) -> DataFrame:
    """One record for each anchor, channel and image, with its offset from the anchor."""
    each = histories.select("anchor_token", "log_name", "channel", "anchor_ts_us", "start_image_token", "end_image_token", F.inline("frames"))
    return each.select(
        F.lit(scene_filter_sha256).alias("scene_filter_sha256"), "anchor_token", "log_name", "channel", "stream_index", "image_token", "image_ts_us", "anchor_ts_us",
        (F.col("image_ts_us") - F.col("anchor_ts_us")).alias("image_offset_us"), "blob_path", F.col("image_token").isin(F.col("start_image_token"), F.col("end_image_token")).alias("retained"),
    )


def frame_records(histories: DataFrame, storage: DataFrame) -> DataFrame:
    """Visual-audit records: position, time relative to the anchor, step from the frame before (null first), and how it is stored."""
    each = histories.select("anchor_token", "channel", "anchor_ts_us", F.inline("frames"))
    w = W.partitionBy("anchor_token", "channel").orderBy("stream_index")
    placed = each.withColumns({"position": (F.row_number().over(w) - 1).cast("bigint"), "delta_us": F.col("image_ts_us") - F.lag("image_ts_us").over(w), "relative_us": F.col("image_ts_us") - F.col("anchor_ts_us")})
    return placed.join(storage.select(F.col("destination").alias("blob_path"), "storage_kind", "sha256"), "blob_path", "left")


def audit_panels(records: DataFrame) -> DataFrame:
    """(anchor_token, channel, ...) with what a panel must have: every frame stored with a hash, two official frames at least and one added, official at both ends."""
    official = F.col("storage_kind") == "existing"
    return records.groupBy("anchor_token", "channel").agg(
        F.count(F.lit(1)).alias("frames"), F.count_if(official).alias("official"), F.count_if(~official).alias("added"), F.bool_and(F.col("sha256").isNotNull()).alias("hashed"),
        F.coalesce(F.min_by(official, "position"), F.lit(False)).alias("starts_official"), F.coalesce(F.max_by(official, "position"), F.lit(False)).alias("ends_official"),
    ).withColumn("sound", F.expr("hashed and official >= 2 and added >= 1 and starts_official and ends_official"))


def download_report(jobs: DataFrame, receipts: DataFrame) -> dict:
    both = jobs.select("path", "size").join(receipts.select("path", F.lit(True).alias("there")), "path", "left")
    return one_row(both.agg(F.count(F.lit(1)).alias("wanted"), F.count("there").alias("downloaded"), F.coalesce(F.sum(F.when(F.col("there"), F.col("size"))), F.lit(0)).cast("bigint").alias("bytes")))


#: Statuses with which a tool ends well.
GOOD = frozenset({"pass", "partial_pass", "partial", "dry_run"})


def exit_code(report: dict) -> int:
    return 0 if report.get("status") in GOOD else 2


def native_report(selected: DataFrame, files: DataFrame, settings: dict) -> dict:
    """Native databases: what was selected by archive, how each was resumed, and a digest of the selection in order."""
    import hashlib

    per = {r["archive_key"]: {"members": r["members"], "bytes": r["bytes"]} for r in selection_report(selected).orderBy("archive_key").collect()}
    digest = hashlib.sha256()
    for r in selected.select("archive_key", "member_name").orderBy("archive_key", "member_name").toLocalIterator():
        digest.update(f"{r[0]}\t{r[1]}\n".encode())
    return {
        "format": FORMATS["native"], "archives": per, "files": {r["status"]: r["count"] for r in files.groupBy("status").count().collect()}, "members": sum(x["members"] for x in per.values()),
        "bytes": sum(x["bytes"] for x in per.values()), "selection_sha256": digest.hexdigest(), "settings": settings,
    }


def audit_report(anchors: DataFrame, ranges: DataFrame, violations: dict[str, int], full: bool) -> dict:
    """Lineage audit: anchors, images by channel, frame counts, logs and databases referenced."""
    by_channel = ranges.groupBy("channel").agg(F.sum("frame_count").cast("bigint").alias("images")).orderBy("channel").collect()
    counts = ranges.groupBy("frame_count").count().orderBy("frame_count").collect()
    return {
        "status": status(bool(violations), not full), "anchors": anchors.count(), "logs": anchors.select("log_name").distinct().count(), "images_by_channel": {r["channel"]: r["images"] for r in by_channel},
        "frame_counts": {str(r["frame_count"]): r["count"] for r in counts}, "violations": violations,
    }


def completion_marker(progress: DataFrame, metadata: DataFrame, ledger_sha256: str, states: list[str]) -> dict:
    """Written by a relay when every archive is complete; refused before."""
    total = one_row(pack_summary(progress))
    if not total["archives"] or total["complete"] != total["archives"]:
        raise ValueError("archives are not complete")
    return {"format": FORMATS["relay"], **total, "metadata": {r["key"]: r["value"] for r in metadata.collect()}, "ledger_sha256": ledger_sha256, "states": sorted(states)}


def offload_manifest(moved: DataFrame, reason: str) -> dict:
    packs = [r.asDict() for r in moved.orderBy("path").collect()]
    return {"format": FORMATS["offload"], "reason": reason, "packs": packs, "bytes": sum(p["length"] for p in packs), "verified": all(p["verified"] for p in packs)}


def visual_manifest(panels: DataFrame, records: DataFrame, seed: int) -> dict:
    """Panels with their frame records; sound ones only make a manifest that passes."""
    frames: dict[tuple, list] = {}
    for r in records.orderBy("anchor_token", "channel", "position").collect():
        frames.setdefault((r["anchor_token"], r["channel"]), []).append({k: r[k] for k in ("position", "stream_index", "image_token", "image_ts_us", "relative_us", "delta_us", "storage_kind", "sha256")})
    found = [{**r.asDict(), "records": frames.get((r["anchor_token"], r["channel"]), [])} for r in panels.orderBy("anchor_token", "channel").collect()]
    return {"format": FORMATS["visual"], "seed": seed, "status": "pass" if found and all(p["sound"] for p in found) else "fail", "panels": found}
