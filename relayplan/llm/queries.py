"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan.llm import decontaminate, hilbert_shard, license_scan, line_dedup, oracles, ordinal_quality, pieces, pivot_search, rlz_dedup, rtree_join, sanitise, spelling, suffix_dedup, token_align
from relayplan.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_suffix_dedup", oracles.OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = lambda s: s["stop"] - s["start"]
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + span(s)).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_hilbert_shard", oracles.OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shard.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


@query("op1_license_scan", oracles.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op7_decontaminate", oracles.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_rlz_dedup", oracles.OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_sanitise", oracles.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = sanitise.scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        i = sanitise.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}")

    return per.select("doc_id", *map(count, sanitise.KINDS),
                      F.sha2(sanitise.span_text(F.col("base")), 256).alias("base_sha256"),
                      sanitise.span_text(F.col("spans")).alias("spans"))


@query("op4_pivot_search", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
               FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    WHERE rank <= 10""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pivot_search.quantise(table(spark, sf_dir, "embeddings"))
    return pivot_search.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query("op5_ordinal_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_rtree_join", oracles.OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree_join.link(table(spark, sf_dir, "documents"))


@query("op9_pieces")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = pieces.load()
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), v, check=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"),
                        F.xxhash64("ids").alias("ids_hash"), "exact")


@query("op11_spelling", oracles.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


@query("op12_line_dedup", oracles.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_token_align")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
