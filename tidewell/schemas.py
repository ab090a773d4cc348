"""Fixed schemas of all tables, their format tags, and the check against them.

Reads never infer: a table either has the columns listed here or is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import SchemaMismatch

#: Camera channels, in report order (fixed values).
CHANNELS = ("CAM_F0", "CAM_L0", "CAM_L1", "CAM_L2", "CAM_R0", "CAM_R1", "CAM_R2", "CAM_B0")
#: Microseconds (fixed values).
NOMINAL_INTERVAL_US = 100_000
RETAINED_INTERVAL_US = 500_000
TOLERANCE_US = 50_000
#: Rows of an anchor's history (itself included) and of its future (fixed values).
HISTORY_ROWS, FUTURE_ROWS = 4, 10
MAX_IMAGE_BYTES = 64 << 20
TAR_BLOCK = 512


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind.rstrip("!")), not kind.endswith("!")) for name, kind in columns.items()])


_SPECS = {
    "metadata": dict(key="string!", value="string"),
    "source_log": dict(log_name="string!", log_token="string!", native_db_relative_path="string!"),
    "anchor": dict(
        anchor_token="string!", log_name="string!", log_token="string!", scene_token="string!", anchor_ts_us="bigint!", row_index="bigint!",
        history_start_ts_us="bigint!", lidar_token="string!", lidar_ts_us="bigint!", lidar_scene_token="string!", lidar_filename="string!", mapping_method="string!",
    ),
    "native_image": dict(
        log_name="string!", channel="string!", stream_index="bigint!", image_token="string!", image_ts_us="bigint!", filename="string!", camera_token="string!",
        blob_path="string!", anchor_reference_count="bigint",
    ),
    "anchor_camera": dict(
        anchor_token="string!", channel="string!", start_image_token="string!", start_image_ts_us="bigint!", end_image_token="string!", end_image_ts_us="bigint!",
        history_start_ts_us="bigint!", history_end_ts_us="bigint!", first_stream_index="bigint!", last_stream_index="bigint!", frame_count="bigint!",
    ),
    "anchor_row": dict(
        log_name="string!", row_index="bigint!", token="string!", ts_us="bigint!", row_log_name="string", log_token="string", scene_token="string", lidar_path="string",
        cams="map<string,struct<data_path:string>>",
    ),
    "log": dict(log_name="string!", token="binary", logfile="string"),
    "lidar": dict(log_name="string!", token="binary", ts_us="bigint", scene_token="binary", filename="string"),
    "camera": dict(log_name="string!", token="binary", channel="string"),
    "image": dict(log_name="string!", token="binary", ts_us="bigint", filename="string", camera_token="binary"),
    "inventory": dict(
        format="string", scene_filter_sha256="string", log_name="string", channel="string", filename="string", image_token="string", image_ts_us="bigint",
        camera_token="string", blob_path="string", anchor_reference_count="bigint",
    ),
    "target": dict(
        archive_key="string!", member_name="string!", destination="string!", log_name="string!", channel="string!", status="string!", member_size="bigint",
        sha256="string", header_offset="bigint", data_offset="bigint",
    ),
    "archive_progress": dict(
        archive_key="string!", url="string", listed_size="bigint", etag="string", next_header_offset="bigint", headers_scanned="bigint", target_total="bigint",
        target_done="bigint", packed_count="bigint", existing_count="bigint", pack_path="string", pack_bytes="bigint", status="string",
    ),
    "member_storage": dict(
        archive_key="string!", member_name="string!", destination="string!", storage_kind="string!", storage_path="string!", pack_offset="bigint",
        payload_size="bigint!", sha256="string!", header_offset="bigint!", data_offset="bigint!",
    ),
    "image_storage": dict(
        destination="string!", archive_key="string!", member_name="string!", storage_kind="string!", storage_path="string!", pack_offset="bigint", payload_size="bigint!", sha256="string!",
    ),
    "archive_verification": dict(archive_key="string!", status="string", source_existing_count="bigint", checked_count="bigint"),
    "member_verification": dict(
        archive_key="string!", member_name="string!", destination="string", effective_kind="string", effective_path="string", effective_offset="bigint", payload_size="bigint",
        native_sha256="string", status="string",
    ),
    "offset_index": dict(
        blob_path="string!", archive_key="string!", member_name="string!", header_offset="bigint!", data_offset="bigint!", member_size="bigint!", log_name="string", channel="string",
    ),
    "receipt": dict(path="string!", identity="string", sha256="string"),
    "shard_row": dict(path="string!", offset="bigint!", size="bigint!", sha256="string"),
    "manifest_frame": dict(
        scene_filter_sha256="string", anchor_token="string", log_name="string", channel="string", stream_index="bigint", image_token="string", image_ts_us="bigint",
        anchor_ts_us="bigint", image_offset_us="bigint", blob_path="string", retained="boolean",
    ),
}

SCHEMAS: dict[str, T.StructType] = {}
#: Key columns; each is a uniqueness rule.
KEYS = {
    "metadata": ["key"], "source_log": ["log_name"], "anchor": ["anchor_token"], "native_image": ["log_name", "channel", "image_token"], "anchor_camera": ["anchor_token", "channel"],
    "target": ["archive_key", "member_name"], "archive_progress": ["archive_key"], "member_storage": ["archive_key", "member_name"], "image_storage": ["destination"],
    "offset_index": ["blob_path"], "receipt": ["path"], "shard_row": ["path"],
}
FORMATS = {
    "history": "tidewell_history_index_v1", "inventory": "tidewell_inventory_v1", "ledger": "tidewell_ledger_v1", "pack": "tidewell_pack_state_v1",
    "storage": "tidewell_image_storage_v1", "offsets": "tidewell_tar_offsets_v1", "direct": "tidewell_direct_v1", "native": "tidewell_native_report_v1",
    "relay": "tidewell_relay_complete_v1", "offload": "tidewell_offload_v1", "visual": "tidewell_visual_audit_v1",
}


def schema(name: str) -> T.StructType:
    """The schema of a table, made on first use (types are parsed with a session at hand)."""
    if name not in SCHEMAS:
        SCHEMAS[name] = _schema(**_SPECS[name])
    return SCHEMAS[name]


def columns(name: str) -> list[str]:
    return list(_SPECS[name])


def validate_schema(df: DataFrame, name: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """The table with exactly its columns, in order; optional ones that are missing become null.  Raises SchemaMismatch."""
    wanted, have = _SPECS[name], dict(df.dtypes)
    missing = [c for c in wanted if c not in have and c not in optional]
    if missing:
        raise SchemaMismatch(f"{name}: missing columns {missing[:8]}")
    wrong = [c for c in wanted if c in have and have[c] != wanted[c].rstrip("!") and not (have[c] == "int" and wanted[c].rstrip("!") == "bigint")]
    if wrong:
        raise SchemaMismatch(f"{name}: columns of other types {[(c, have[c], wanted[c]) for c in wrong[:8]]}")
    return df.select(*(F.col(c).cast(k.rstrip("!")).alias(c) if c in have else F.lit(None).cast(k.rstrip("!")).alias(c) for c, k in wanted.items()))


def check_format(metadata: DataFrame, product: str) -> None:
    """Raises unless the metadata table carries the product's format tag exactly once."""
    tags = [r["value"] for r in metadata.where(F.col("key") == "format").limit(2).collect()]
    if tags != [FORMATS[product]]:
        raise SchemaMismatch(f"format is {tags}, not {FORMATS[product]}")


def metadata_rows(spark, values: dict) -> DataFrame:
    """Key/value table; booleans are ``true``/``false``, numbers plain, anything not scalar is refused."""
    rows = []
    for key, value in values.items():
        if isinstance(value, bool):
            value = "true" if value else "false"
        elif not isinstance(value, (str, int, float)):
            raise TypeError(f"metadata {key!r} is not scalar")
        rows.append((key, str(value)))
    return spark.createDataFrame(sorted(rows), schema("metadata"))
