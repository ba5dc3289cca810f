"""Training-data pipeline over ``documents``: the stages and their run.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan.llm import decontaminate, ordinal_quality, pieces, rtree_join, sanitise
from relayplan.llm.common import table
from relayplan.session import configure, scratch_path


def stage(fn):
    """A stage works by itself: the library's session settings first (adaptive
    joins, bounded Arrow batches, the package on the workers)."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier accepts."""
    return ordinal_quality.select_good(docs, table(spark, sf_dir, "labels"))


@stage
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return rtree_join.drop_duplicates(docs)


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what reveals it taken out."""
    return sanitise.sanitise(docs)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces, and whether these give back the text."""
    v = pieces.load()
    return pieces.encode(docs, v, check=True).select(
        "doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_pieces"), "exact")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("SentencePiece encoding and decoding", tokens),
]

#: A fitted model and encoded pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{k}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
