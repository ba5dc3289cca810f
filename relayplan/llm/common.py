"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan.session import shared_dir

# fixed values: word patterns of the contracts (ASCII separators; every other
# code point belongs to a word)
WORD_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_SPACE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column, pattern: str = WORD_ALNUM) -> Column:
    """Words of a text in order; null text has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0))


def text_key(text: str) -> Column:
    """32 bytes that tell texts apart; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, lineage cut. Lost
    executors cost only the tasks they ran."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def aside(docs: DataFrame, *own: str):
    """``docs`` with all columns but ``own`` named by position, so that no
    column of a caller clashes with one an operator adds, and a function that
    selects them back under their names, with more columns if given."""
    inner = [c if c in own else f"c{i}" for i, c in enumerate(docs.columns)]

    def back(df: DataFrame, *more: str) -> DataFrame:
        return df.select(*[F.col(a).alias(b) for a, b in zip(inner, docs.columns, strict=True)], *more)

    return docs.toDF(*inner), back


def scan_partitions(df: DataFrame) -> int:
    """Input splits of ``df``, the measure by which exchanges are sized."""
    return max(1, df.rdd.getNumPartitions())
