"""Resumable processing with Structured Streaming.

A batch's rows are written below their batch number and then committed by a
marker file; a batch that is run again after a crash replaces its own rows, so
every row counts once.  A run is bound to its source's identity: with another
source the stored state is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StateConflict
from ..plans.publish import Store


class Ledger:
    """Batches below a folder; only those with a marker count.

    One writer at a time: ``locked`` holds a lock file that only one can
    create.  A lock that a crash has left is taken over on request.
    """

    def __init__(self, spark: SparkSession, path: str, identity: dict):
        self.spark, self.path, self.store = spark, path.rstrip("/"), Store(spark, path)
        bound, text = f"{self.path}/_identity.json", json.dumps(identity, sort_keys=True)
        if not self.store.exists(bound):
            try:
                self.store.write_text(bound, text)
            except Exception:  # another has just written it: it must say the same
                if not self.store.exists(bound):
                    raise
        if self.store.read_text(bound) != text:
            raise StateConflict(f"{path} belongs to another source")

    @contextmanager
    def locked(self, take_over: bool = False) -> Iterator[None]:
        lock, owner = f"{self.path}/_lock", uuid.uuid4().hex
        try:
            self.store.write_text(lock, owner, overwrite=take_over)
        except Exception as error:
            raise StateConflict(f"{self.path} has another writer, or one that crashed (take_over=True takes its lock)") from error
        try:
            yield
        finally:
            if self.store.exists(lock) and self.store.read_text(lock) == owner:
                self.store.delete(lock)

    def write(self, batch: DataFrame, number: int, note: Callable[[DataFrame], dict] | None = None) -> None:
        """Rows, then the marker, which keeps what ``note`` makes of the written rows."""
        marker = f"{self.path}/commits/{number}"
        if self.store.exists(marker):
            return  # done before a crash
        folder = f"{self.path}/batches/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        kept = note(self.spark.read.schema(batch.schema).parquet(folder)) if note else {}
        self.store.replace_text(marker, json.dumps(kept, sort_keys=True))

    def note(self, number: int) -> dict:
        return json.loads(self.store.read_text(f"{self.path}/commits/{number}") or "{}")

    def committed(self) -> list[int]:
        folder = self.store._path(f"{self.path}/commits")
        if not self.store.fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self.store.fs.listStatus(folder) if s.getPath().getName().isdigit())

    def rows(self) -> DataFrame | None:
        done = self.committed()
        if not done:
            return None
        return self.spark.read.option("basePath", f"{self.path}/batches").parquet(*(f"{self.path}/batches/batch={n}" for n in done)).drop("batch")


def run_available(stream: DataFrame, ledger: Ledger, transform: Callable[[DataFrame], DataFrame] = lambda df: df, take_over: bool = False) -> None:
    """Process all that is there now, in batches, and stop; a later call goes on where this one ended."""
    with ledger.locked(take_over):
        query = (
            stream.writeStream.foreachBatch(lambda df, n: ledger.write(transform(df), n)).option("checkpointLocation", f"{ledger.path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()


def scan_archives(spark: SparkSession, root: str, paths: list[str], ledger: Ledger, max_headers: int = 1000, take_over: bool = False) -> bool:
    """One bounded step through every TAR archive, from where the last committed step ended; True when all are at their end.

    Archives are walked in parallel, a task each.  What a crashed step wrote
    without its marker is written again by the next.  A marker keeps where
    each archive goes on, so a step reads one marker and no rows.
    """
    from ..sources.archives import walk_on

    with ledger.locked(take_over):
        done = ledger.committed()
        at = ledger.note(done[-1]) if done else {}
        start = spark.createDataFrame([(p, at.get(p, 0)) for p in paths], "archive_key string, next_header_offset bigint")
        counts: dict[str, int] = {}

        def note(rows: DataFrame) -> dict:
            ends = rows.groupBy("archive_key").agg(F.max("next_header_offset").alias("at"), F.count(F.lit(1)).alias("n")).collect()
            counts.update({r["archive_key"]: r["n"] for r in ends})
            return at | {r["archive_key"]: r["at"] for r in ends}

        ledger.write(walk_on(start.repartition(max(1, len(paths)), "archive_key"), root, max_headers), max(done, default=-1) + 1, note)
        return all(n < max_headers for n in counts.values())


def sessions(events: DataFrame, key: str, ts: str, gap: str, watermark: str) -> DataFrame:
    """Gap-free stretches of a stream as session windows: a step equal to the gap merges, a longer one splits."""
    return events.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))


def wait_for(ready: Callable[[], bool], seconds: float, most: int, sleep: Callable[[float], None]) -> bool:
    """Poll until ``ready`` (space is there, a trigger holds), at most ``most`` times."""
    for k in range(most):
        if ready():
            return True
        if k + 1 < most:
            sleep(seconds)
    return False


def wait_for_space(store: Store, path: str, new_floor: int, resume_floor: int, resuming: bool, seconds: float, most: int, sleep: Callable[[float], None]) -> bool:
    """Back-pressure: a new batch waits for ``new_floor`` free bytes, one that goes on for ``resume_floor``."""
    floor = resume_floor if resuming else new_floor
    return wait_for(lambda: store.free_bytes(path) >= floor, seconds, most, sleep)
