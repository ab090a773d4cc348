"""Reading a history index: from anchor tokens to histories, their bytes, and padded arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import ImagesUnavailable, IndexError_
from .functions import scalars as S
from .operators import histories as H
from .plans import rules as R
from .plans.publish import open_product
from .schemas import NOMINAL_INTERVAL_US, TOLERANCE_US, check_format, validate_schema


class HistoryIndex:
    """A published history index.  Questions take tables of tokens and answer with tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], expected_frames: int | None = None):
        if expected_frames is not None and expected_frames < 1:
            raise ValueError("expected_frames must be positive")
        self.spark, self.expected = spark, expected_frames
        self.t = {name: validate_schema(df, name, ("anchor_reference_count",)) for name, df in tables.items()}
        check_format(self.t["metadata"], "history")
        self.metadata = {r["key"]: r["value"] for r in self.t["metadata"].collect()}

    @classmethod
    def open(cls, spark: SparkSession, path: str, expected_frames: int | None = None) -> HistoryIndex:
        return cls(spark, open_product(spark, path, "history"), expected_frames)

    @property
    def native_jpegs_verified(self) -> bool:
        return (self.metadata.get("native_jpegs_verified") or "").strip().lower() in ("1", "true", "yes")

    @property
    def cadence_tolerance_us(self) -> int:
        return int(self.metadata.get("cadence_tolerance_us", TOLERANCE_US))

    @property
    def preserves_gaps(self) -> bool:
        """An index that does not say so is read strictly: gaps are errors."""
        return self.metadata.get("source_capture_gaps_preserved") == "true"

    def tokens(self) -> DataFrame:
        return self.t["anchor"].select(F.col("anchor_token").alias("token"))

    def has(self, tokens: DataFrame) -> DataFrame:
        """(token, found).  Requests are normalised, the stored column is not, so that it can be looked up as it is."""
        want = tokens.select("token", S.token_norm("token").alias("anchor_token"))
        there = self.t["anchor"].select("anchor_token", F.lit(True).alias("there"))
        return want.join(there, "anchor_token", "left").select("token", F.coalesce("there", F.lit(False)).alias("found"))

    def anchors(self, tokens: DataFrame) -> DataFrame:
        """The anchors asked for, with their log; an unknown token is an error."""
        want = tokens.select(S.token_norm("token").alias("anchor_token")).distinct()
        missing = want.join(self.t["anchor"], "anchor_token", "left_anti").limit(8).collect()
        if missing:
            raise IndexError_(f"unknown anchors {[r[0] for r in missing]}")
        return self.t["anchor"].join(want, "anchor_token").join(self.t["source_log"].select("log_name", "native_db_relative_path"), "log_name")

    def histories(self, tokens: DataFrame, channels: list[str] | None = None, check: bool = True) -> DataFrame:
        """One row per anchor and channel with its ordered ``frames``; fails closed on any inconsistency."""
        anchors = self.anchors(tokens)
        ranges = self.t["anchor_camera"] if channels is None else self.t["anchor_camera"].where(F.col("channel").isin(channels))
        base = anchors.select("anchor_token", "log_name", "anchor_ts_us", F.col("history_start_ts_us").alias("anchor_start_ts_us")).join(ranges, "anchor_token")
        images = self.t["native_image"].select("log_name", "channel", "stream_index", "image_token", "image_ts_us", "blob_path")
        # ranges are exploded to positions and meet images on equality: no band join, and a range of any length is spread
        each = base.where("last_stream_index >= first_stream_index").select("anchor_token", "log_name", "channel", "first_stream_index", "last_stream_index")
        frames = H.expand_ranges(each, images, ["log_name", "channel"]).groupBy("anchor_token", "channel").agg(
            F.array_sort(F.collect_list(F.struct("stream_index", "image_token", "image_ts_us", "blob_path"))).alias("frames")
        )
        out = base.join(frames, ["anchor_token", "channel"], "left")
        out = out.withColumn("frames", F.coalesce("frames", F.array().cast(frames.schema["frames"].dataType)))
        if check:
            rules = R.history_rules(self.spark, out, self.cadence_tolerance_us, self.expected)
            if channels is not None:
                want = anchors.select("anchor_token", F.explode(F.array(*map(F.lit, channels))).alias("channel"))
                rules.add("history.channel", want.join(ranges, ["anchor_token", "channel"], "left_anti"), R.text_key("anchor_token", "channel"))
            if not self.preserves_gaps:
                rules.add("history.gaps", with_gaps(out, self.cadence_tolerance_us).where(F.size("gap_deltas_us") > 0), R.text_key("anchor_token", "channel"))
            try:
                rules.enforce("history index")
            except Exception as error:
                raise IndexError_(str(error)) from error
        return out

    def availability(self, tokens: DataFrame, files: DataFrame, check: bool = True) -> DataFrame:
        """(anchor_token, total, present, missing, missing_paths): distinct images with and without a file, and the paths of those without, sorted."""
        paths = self.histories(tokens, check=check).select("anchor_token", F.explode("frames.blob_path").alias("path")).distinct()
        there = paths.join(files.select("path").distinct().withColumn("there", F.lit(True)), "path", "left")
        return there.groupBy("anchor_token").agg(
            F.count(F.lit(1)).alias("total"), F.count("there").alias("present"), F.count_if(F.col("there").isNull()).alias("missing"), F.array_sort(F.collect_list(F.when(F.col("there").isNull(), F.col("path")))).alias("missing_paths")
        )


def with_gaps(histories: DataFrame, tolerance: int = TOLERANCE_US) -> DataFrame:
    """Adds ``deltas_us`` and ``gap_deltas_us``, the steps beyond nominal."""
    n = F.greatest(F.size("frames") - 1, F.lit(0))
    deltas = F.zip_with(F.slice("frames", 1, n), F.slice("frames", 2, n), lambda a, b: b["image_ts_us"] - a["image_ts_us"])
    return histories.withColumn("deltas_us", deltas).withColumn("gap_deltas_us", F.filter("deltas_us", lambda d: d > NOMINAL_INTERVAL_US + tolerance))


def padded(histories: DataFrame, size: int | None = None) -> DataFrame:
    """(anchor_token, channel, timestamps_us, valid): padded with -1, by default to the anchor's longest channel; a smaller size is an error."""
    rows = histories.select("anchor_token", "channel", F.col("frames.image_ts_us").alias("timestamps_us"))
    if size is not None and not rows.where(F.size("timestamps_us") > size).isEmpty():
        raise IndexError_(f"a history is longer than {size} frames")
    return H.pad_histories(rows, "anchor_token", "timestamps_us", size)


def load_images(spark: SparkSession, histories: DataFrame, storage: DataFrame, root: str) -> DataFrame:
    """Frames with their bytes: (anchor_token, channel, stream_index, destination, content).

    Each image is read once however many anchors share it.  Marker and hash
    are checked; a missing or differing image is an error.
    """
    each = histories.select("anchor_token", "channel", F.inline("frames"))
    places = each.select(F.col("blob_path").alias("destination")).distinct().join(storage, "destination", "left")
    lost = places.where("storage_path is null").limit(3).collect()
    if lost:
        raise ImagesUnavailable(f"no storage row for {[r['destination'] for r in lost]}")

    def read(batches):
        import os

        import pandas as pd

        for batch in batches:
            for k in range(0, len(batch), 16):
                part, data = batch.iloc[k : k + 16], []
                for r in part.itertuples():
                    path = os.path.realpath(os.path.join(root, r.storage_path))
                    if not path.startswith(os.path.realpath(root) + os.sep):
                        data.append(None)
                        continue
                    try:
                        with open(path, "rb") as f:
                            f.seek(0 if r.storage_kind == "existing" else int(r.pack_offset))
                            data.append(f.read(int(r.payload_size)))
                    except OSError:
                        data.append(None)
                yield pd.DataFrame({"destination": part["destination"], "sha256": part["sha256"], "content": data})

    content = places.select("destination", "storage_kind", "storage_path", "pack_offset", "payload_size", "sha256").mapInPandas(read, "destination string, sha256 string, content binary")
    checked = content.withColumn("ok", F.coalesce(S.is_jpeg("content") & (S.sha256("content") == F.col("sha256")), F.lit(False)))
    bad = checked.where("not ok").select("destination").limit(3).collect()
    if bad:
        raise ImagesUnavailable(f"missing or differing bytes: {[r['destination'] for r in bad]}")
    return each.select("anchor_token", "channel", "stream_index", F.col("blob_path").alias("destination")).join(checked.select("destination", "content"), "destination")


def decode_images(images: DataFrame, decoder: Callable[[bytes], object]) -> DataFrame:
    """Adds (height, width, pixels): rows of RGB bytes, as ``decoder`` makes them of the encoded image.

    The engine has no decoder of its own.  One that does not give height by
    width by 3 unsigned bytes, or raises, makes the image unavailable.
    """

    def decode(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for k in range(0, len(batch), 4):
                part, out = batch.iloc[k : k + 4], []
                for r in part.itertuples():
                    try:
                        pixels = np.asarray(decoder(bytes(r.content)))
                    except Exception as error:
                        raise ImagesUnavailable(f"{r.destination}: {error}") from error
                    if pixels.dtype != np.uint8 or pixels.ndim != 3 or pixels.shape[2] != 3 or 0 in pixels.shape:
                        raise ImagesUnavailable(f"{r.destination}: decoded to {pixels.dtype} of shape {pixels.shape}")
                    out.append((pixels.shape[0], pixels.shape[1], pixels.tobytes()))
                yield pd.concat([part.drop(columns="content").reset_index(drop=True), pd.DataFrame(out, columns=["height", "width", "pixels"])], axis=1)

    kept = images.drop("content")
    fields = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return images.select(*kept.columns, "content").mapInPandas(decode, f"{fields}, height int, width int, pixels binary")


class ImageLoader:
    """Histories with their images, from an index, a storage index and the folder of packs and files."""

    def __init__(self, index: HistoryIndex, storage: DataFrame, root: str, decoder: Callable[[bytes], object] | None = None):
        self.index, self.storage, self.root, self.decoder = index, validate_schema(storage, "image_storage"), root, decoder

    @classmethod
    def from_index_path(cls, spark: SparkSession, index: str, storage: str, root: str, decoder: Callable[[bytes], object] | None = None) -> ImageLoader:
        tables = open_product(spark, storage, "storage")
        return cls(HistoryIndex.open(spark, index), tables["image_storage"], root, decoder)

    def load(self, tokens: DataFrame, channels: list[str] | None = None) -> DataFrame:
        """One row an image: (anchor_token, channel, stream_index, position, image_ts_us, destination, content or pixels)."""
        histories = self.index.histories(tokens, channels)
        if self.decoder and histories.isEmpty():
            raise IndexError_("no histories")
        frames = histories.select("anchor_token", "channel", F.posexplode("frames").alias("position", "f")).select("anchor_token", "channel", "position", "f.stream_index", "f.image_ts_us")
        images = load_images(self.index.spark, histories, self.storage, self.root)
        if self.decoder:
            once = images.select("destination", "content").dropDuplicates(["destination"])
            images = images.drop("content").join(decode_images(once, self.decoder), "destination")
        return images.join(frames, ["anchor_token", "channel", "stream_index"])

    def load_anchor(self, token: str, channels: list[str] | None = None) -> DataFrame:
        return self.load(self.index.spark.createDataFrame([(token,)], "token string"), channels)

    def padded(self, tokens: DataFrame, size: int | None = None, channels: list[str] | None = None) -> DataFrame:
        """(anchor_token, channel, timestamps_us, valid, images): arrays of one length; an image that is only padding is null."""
        histories = self.index.histories(tokens, channels)
        arrays = padded(histories, size)
        value = "pixels" if self.decoder else "content"
        images = self.load(tokens, channels).groupBy("anchor_token", "channel").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", value))), lambda x: x[value]).alias("images"))
        filled = F.concat("images", F.array_repeat(F.lit(None).cast("binary"), F.size("timestamps_us") - F.size("images")))
        return arrays.join(images, ["anchor_token", "channel"]).withColumn("images", filled)


def retained_references(histories: DataFrame) -> DataFrame:
    """Adds ``start_reference`` and ``end_reference``: the official images at a history's ends, each with token, time and path."""

    def pick(token: str) -> Column:
        f = F.try_element_at(F.filter("frames", lambda f: f["image_token"] == F.col(token)), F.lit(1))
        return F.struct(*(f[c].alias(c) for c in ("image_token", "image_ts_us", "blob_path")))

    return histories.withColumns({"start_reference": pick("start_image_token"), "end_reference": pick("end_image_token")})


class MetadataAdapter:
    """Binds a scene loader's tokens to an index."""

    def __init__(self, index: HistoryIndex, tokens: DataFrame):
        self.index, self.wanted = index, tokens.select(S.token_norm("token").alias("token")).distinct()

    @classmethod
    def from_scene_loader(cls, index: HistoryIndex, loader) -> MetadataAdapter:
        """Of any object with a list ``tokens``."""
        return cls(index, index.spark.createDataFrame([(str(t),) for t in loader.tokens], "token string"))

    def tokens(self) -> DataFrame:
        return self.wanted.join(self.index.tokens(), "token", "left_semi")

    def anchor(self, token: str) -> DataFrame:
        one = self.index.spark.createDataFrame([(token,)], "token string")
        if one.select(S.token_norm("token").alias("token")).join(self.wanted, "token", "left_semi").isEmpty():
            raise IndexError_(f"token {token!r} is not one of the loader's")
        return self.index.histories(one)
