"""Session plumbing shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test layout, opened by Spark's own reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``.  Only a local-mode session (one
    machine, as in tests) may fall back on a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    own = spark.conf.get("spark.tidewell.local.work", None)
    if own:
        return own
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tidewell-")
    spark.conf.set("spark.tidewell.local.work", own)
    return own


_open: list[Workspace] = []


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Deletes, on success, all tables of workspaces that were opened inside: for steps whose result has been written elsewhere."""
    before = len(_open)
    yield
    for work in _open[before:]:
        if work.spark is spark and work.names:
            work.drop()
    del _open[before:]


class Workspace:
    """Tables that one operator run writes once and reads back.

    Writing cuts the lineage: if an executor is lost afterwards, the written
    table is read again instead of being recomputed from the input.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        _open.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write and read back; ``by`` is a column that gets a folder for each value."""
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.path(name))
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more; without names, all that are left."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [self.path(n) for n in names] if names else [self.root]:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        self.names -= set(names) if names else set(self.names)


def filter_rows(df: DataFrame, text_col: str, make_judge: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows whose text is judged true, with all their columns, in place: nothing is shuffled or joined.

    ``make_judge`` is called once a task; a judge maps a column of texts to booleans.
    """
    at, names = df.columns.index(text_col), df.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make_judge()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names).filter(pa.array(judge(batch.column(at)), pa.bool_()))

    return df.mapInArrow(keep, df.schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def no_null(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
