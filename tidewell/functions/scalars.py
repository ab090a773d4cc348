"""Scalar functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def token_norm(x: Col) -> Column:
    """Requested token: blanks stripped, lower-cased; an empty one is null."""
    return F.nullif(F.lower(F.trim(_c(x))), F.lit(""))


def hex_token(x: Col) -> Column:
    """Opaque binary token as lowercase hex; null is empty."""
    return F.coalesce(F.lower(F.hex(_c(x))), F.lit(""))


def basename(x: Col) -> Column:
    return F.substring_index(_c(x), "/", -1)


def parts(x: Col) -> Column:
    return F.split(_c(x), "/")


def strip_first_part(x: Col) -> Column:
    return F.regexp_replace(_c(x), "^[^/]*/", "")


def is_safe_path(x: Col) -> Column:
    """Relative POSIX path: no empty, ``.`` or ``..`` part, drive, backslash or NUL."""
    x = _c(x)
    return (
        x.isNotNull() & (F.length(x) > 0) & ~x.rlike(r"[\\\x00]") & ~x.rlike(r"^[A-Za-z]:") & ~x.rlike(r"(^|/)(\.{1,2})?(/|$)")
    )


def has_suffix(x: Col, suffix: str) -> Column:
    return F.lower(_c(x)).endswith(suffix)


def etag_norm(x: Col) -> Column:
    """ETag without a weak mark, and without quotes when both ends have one; empty is null."""
    bare = F.regexp_replace(F.trim(_c(x)), "^W/", "")
    inner = F.when((F.length(bare) >= 2) & bare.startswith('"') & bare.endswith('"'), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
    return F.nullif(inner, F.lit(""))


def is_sha256(x: Col) -> Column:
    return F.coalesce(_c(x).rlike("^[0-9a-f]{64}$"), F.lit(False))


def sha256(x: Col) -> Column:
    return F.sha2(_c(x).cast("binary"), 256)


def crc32(x: Col) -> Column:
    return F.crc32(_c(x).cast("binary"))


def is_jpeg(x: Col) -> Column:
    """Start and end markers of a JPEG stream."""
    return F.startswith(_c(x), F.unhex(F.lit("FFD8"))) & F.endswith(_c(x), F.unhex(F.lit("FFD9")))


def tar_number(field: Col) -> Column:
    """Numeric TAR header field (binary): octal text, or base-256 when the first bit is set (up to 64 bits)."""
    field = _c(field)
    text = F.regexp_extract(F.decode(field, "ISO-8859-1"), r"^[ \x00]*([0-7]*)", 1)
    octal = F.conv(F.when(F.length(text) > 0, text).otherwise("0"), 8, 10).cast("bigint")
    marked = F.conv(F.hex(F.substring(field, 1, 1)), 16, 10).cast("int") >= 128
    return F.when(marked, F.conv(F.right(F.hex(field), F.lit(14)), 16, 10).cast("bigint")).otherwise(octal)


def padded_size(size: Col, block: int = 512) -> Column:
    return (F.ceil(_c(size) / block) * block).cast("bigint")


def next_header(header: Col, size: Col, block: int = 512) -> Column:
    return _c(header) + block + padded_size(size, block)


def omitted_frames(delta_us: Col, nominal_us: int) -> Column:
    """Nominal frames that a gap skipped; halves round to even."""
    return F.greatest(F.lit(0), F.bround(_c(delta_us) / F.lit(float(nominal_us))).cast("bigint") - 1).cast("bigint")


def archive_key(split: Col, group: Col, prefix: str, root: str) -> Column:
    """``prefix/<split>_set/<root>_<split>_camera_<group>.zip``."""
    split = _c(split)
    return F.concat(F.lit(prefix + "/"), split, F.lit(f"_set/{root}_"), split, F.lit("_camera_"), _c(group).cast("bigint").cast("string"), F.lit(".zip"))


_KEY = r"^.*?([a-z]+)_set/[^/]*_\1_camera_(0|[1-9]\d*)\.zip$"


def archive_split(key: Col) -> Column:
    """Split of an archive key; null unless the key is in canonical form."""
    split = F.regexp_extract(_c(key), _KEY, 1)
    return F.when(split.isin("train", "val"), split)


def archive_group(key: Col) -> Column:
    return F.when(archive_split(key).isNotNull(), F.regexp_extract(_c(key), _KEY, 2).cast("bigint"))


def pack_path(key: Col) -> Column:
    """``<split>_set/<archive name>.pack``."""
    return F.concat(archive_split(key), F.lit("_set/"), F.regexp_replace(basename(key), r"\.zip$", ".pack"))


def is_pack_path(x: Col, root: str) -> Column:
    return F.coalesce(_c(x).rlike(rf"^(train_set/{root}_train_camera_\d+|val_set/{root}_val_camera_\d+)\.pack$"), F.lit(False))


def blob_path(log_name: Col, channel: Col, filename: Col) -> Column:
    """``sensor_blobs/<log>/<channel>/<file>`` for the three accepted spellings of a file name; else null."""
    log_name, channel, filename = _c(log_name), _c(channel), _c(filename)
    name = basename(filename)
    accepted = is_safe_path(filename) & has_suffix(filename, ".jpg") & filename.isin(name, F.concat_ws("/", channel, name), F.concat_ws("/", log_name, channel, name))
    return F.when(accepted & (F.length(log_name) > 0) & ~log_name.rlike(r"[/\\]"), F.concat_ws("/", F.lit("sensor_blobs"), log_name, channel, name))


def identity_digest(url: Col, etag: Col, size: Col, row: Col) -> Column:
    """SHA-256 of the JSON array [url, etag, size, row] as Python writes it; ``row`` is JSON text already."""
    def quoted(x: Col) -> Column:
        return F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(_c(x), r"\\", r"\\\\\\\\"), '"', r'\\\\"'), F.lit('"'))

    return F.sha2(F.concat(F.lit("["), quoted(url), F.lit(", "), quoted(etag), F.lit(", "), _c(size).cast("string"), F.lit(", "), _c(row), F.lit("]")), 256)


def utc_stamp(ts_us: Col) -> Column:
    """UTC second stamp of a microsecond count."""
    return F.date_format(F.timestamp_micros(_c(ts_us)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def truthy(x: Col) -> Column:
    return F.coalesce(F.lower(F.trim(_c(x))).isin("1", "true", "yes"), F.lit(False))


def metadata_int(x: Col, default: int) -> Column:
    """Non-negative integer text; null is the default, anything else is null (a violation)."""
    n = F.try_to_number(F.trim(_c(x)), F.lit("999999999999999999")).cast("bigint")
    return F.when(_c(x).isNull(), F.lit(default).cast("bigint")).when(n >= 0, n)


def gigabytes(x: Col) -> Column:
    """Decimal gigabytes."""
    return _c(x) / F.lit(1e9)


def trigger_reason(force: Col, stored: Col, threshold: Col, complete: Col, free: Col, floor: Col) -> Column:
    """Why stored bytes are moved now: the first condition that holds, else null."""
    return (
        F.when(_c(force), "force").when(_c(stored) >= _c(threshold), "size_threshold").when(_c(complete), "packing_complete").when(_c(free) < _c(floor), "relay_space_pressure")
    )


def cam_path(cams: Col, channel: Col) -> Column:
    """Path of a channel in the anchor row's map; a missing channel is null, which a rule reports."""
    return F.try_element_at(_c(cams), _c(channel))["data_path"]


def offset_us(ts: Col, anchor: Col) -> Column:
    """Time of an image from its anchor, in microseconds."""
    return _c(ts) - _c(anchor)


def offset_seconds(ts: Col, anchor: Col) -> Column:
    return offset_us(ts, anchor) / F.lit(1e6)


def uint64(x: Col) -> Column:
    """Little-endian unsigned 64-bit field (binary of 8 bytes) as a decimal, which holds what a long cannot."""
    digits = F.hex(_c(x))
    return F.conv(F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8)))), 16, 10).cast("decimal(20,0)")
