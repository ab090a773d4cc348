"""The corpus pipeline: five stages over ``documents``, each a corpus operator.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns each kept document's token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.bpe import bpe_encode, load_ranks
from tidewell.llm.common import Workspace, swept, table
from tidewell.llm.decontaminate import drop_leaks
from tidewell.llm.line_dedup import line_dedup
from tidewell.llm.ngram_join import ngram_join
from tidewell.llm.quality import fit_quality, keep_good
from tidewell.llm.queries import THRESHOLD, VOCABULARY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return keep_good(docs.select(*COLUMNS), model, THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; ``n_chars`` follows the text."""
    kept = line_dedup(docs, keep=("lang", "source"))
    return kept.select(F.col("id").alias("doc_id"), "text", "rest.lang", "rest.source", F.length("text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the least id stays."""
    work = Workspace(spark, "near-duplicates")
    # written, so that its size is known when the join is planned: small, it is broadcast and no text moves
    drop = work.keep(ngram_join(docs, work=work).where(F.col("id") != F.col("component")).select(F.col("id").alias("doc_id")).distinct(), "dropped")
    return docs.select(*COLUMNS).join(drop, "doc_id", "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids) with ids as little-endian unsigned 32-bit integers."""
    import public_tokenizers

    encoded = bpe_encode(docs, load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", "token_ids")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("tokens", tokens)]

#: Boosting, nearest neighbours and byte-pair merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``.  A stage's intermediates go when it has been written, its result when the next has."""
    work = Workspace(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with swept(spark):
            docs = work.keep(stage(spark, docs, sf_dir), name)
        if last:
            work.drop(last)
        last = name
    return docs
