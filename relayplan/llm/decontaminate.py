"""Benchmark decontamination: containment search for test items in documents.

Items are sets of word shingles (five words; an item of fewer words is one
shingle of its whole sequence) and are partitioned by set size. Each size
partition has its own signature length: the k smallest shingle hashes
(bottom-k MinHash) with ``k = floor((1 - threshold) * u) + 1`` for the largest
size u of the partition. An item of which at least ``threshold`` is contained
in a document lacks at most ``floor((1 - threshold) * n)`` of its shingles
there, so at least one value of its signature is among the document's
shingles: the search by signatures loses nothing, however long the document.
Candidate pairs are then verified by exact containment of the shingle texts.

Defined cases: null and empty texts have no shingles; items without words are
never found; rows with the same ``doc_id`` (``item_id``) count as one document
(item) with all their shingles; null ids are an id of their own; an empty
table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayplan.llm.common import aside, kept, text_key, words

WIDTH = 5
# a side of at most so many bytes is broadcast, a larger one is joined by shuffle
BROADCAST_BYTES = 32 << 20


def shingles(w: Column, width: int) -> Column:
    """All runs of ``width`` words, joined by a blank, in order, repeated ones
    too; none if there are fewer words."""
    return F.when(F.size(w) >= width, F.transform(
        F.sequence(F.lit(1), F.size(w) - (width - 1)),
        lambda i: F.array_join(F.slice(w, i, width), " "))).otherwise(F.array().cast("array<string>"))


def shingle_hashes(w: Column, width: int) -> Column:
    return F.when(F.size(w) >= width, F.transform(
        F.sequence(F.lit(1), F.size(w) - (width - 1)),
        lambda i: F.xxhash64(F.lit(width), F.slice(w, i, width)))).otherwise(F.array().cast("array<bigint>"))


def checked(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A materialised side: broadcast if its values, as text and 16 bytes each,
    take at most ``limit`` bytes. Without that, what it is joined with, the
    shingles of all documents, would be exchanged before Spark knows its size."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df


def item_shingles(items: DataFrame, threshold: float) -> DataFrame:
    """Per item and distinct shingle: text, hash, set size, and whether the
    hash belongs to the signature of the item's size partition."""
    w = items.select("item_id", words(F.lower("text")).alias("_w")).filter(F.size("_w") > 0)
    width = F.least(F.size("_w"), F.lit(WIDTH))
    one = (w.select("item_id", width.alias("width"), F.explode(F.when(
        F.size("_w") >= WIDTH, shingles(F.col("_w"), WIDTH)).otherwise(
            F.array(F.array_join("_w", " ")))).alias("shingle"))
        .distinct()
        .withColumn("h", F.xxhash64("width", F.split("shingle", " "))))
    per = one.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"),
                                     F.sort_array(F.collect_set("h")).alias("_hs"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double"))) + 1).cast("long") - 1
    k = F.floor(F.round(F.lit(1 - threshold), 9) * largest).cast("int") + 1
    sig = per.select(F.col("item_id").alias("_i"), "n", F.slice("_hs", 1, k).alias("_sig"))
    return (one.join(sig, F.col("item_id").eqNullSafe(F.col("_i")))
            .select("item_id", "n", "width", "shingle", "h",
                    F.array_contains("_sig", F.col("h")).alias("in_signature")))


def search(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, item_id, n_item, n_found, containment`` of every pair with
    ``containment >= threshold``."""
    parts = kept(item_shingles(items, threshold))
    # at most WIDTH different widths
    widths = sorted(r["width"] for r in parts.select("width").distinct().collect()) or [WIDTH]
    w = docs.select("doc_id", words(F.lower("text")).alias("_w"))
    hashes = F.concat(*[shingle_hashes(F.col("_w"), k) for k in widths])
    sig = checked(parts.filter("in_signature").select("h", "item_id"))
    candidates = kept(w.select("doc_id", F.explode(hashes).alias("h"))
                      .join(sig, "h").select("doc_id", "item_id").distinct())
    ids = checked(candidates.select(F.col("doc_id").alias("_id")).distinct())
    # a shingle's text tells its width: words hold no blanks
    texts = F.concat(*[shingles(F.col("_w"), k) for k in widths])
    some = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(
        "doc_id", words(F.lower("text")).alias("_w"))
    held = (some.select("doc_id", F.explode(F.array_distinct(texts)).alias("shingle"))
            .join(checked(parts.select("item_id", "n", "shingle")), "shingle"))
    mine = candidates.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"))
    found = (held.groupBy("doc_id", "item_id", "n").agg(F.countDistinct("shingle").alias("n_found"))
             .join(mine, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("item_id").eqNullSafe(F.col("_i")),
                   "left_semi"))
    return (found.filter(F.col("n_found") >= F.lit(threshold) * F.col("n") - 1e-9)
            .select("doc_id", "item_id", F.col("n").alias("n_item"), "n_found",
                    (F.col("n_found") / F.col("n")).alias("containment")))


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they are. Rows of
    one id are one document; a row without an id is a document of its own."""
    inner, back = aside(docs, "doc_id", "text")
    own = inner.withColumn("_key", F.when(F.col("doc_id").isNull(), text_key("text")))
    named = own.select(F.struct("doc_id", "_key").alias("doc_id"), "text")
    bad = kept(search(named, items, threshold).select("doc_id").distinct().select(
        F.col("doc_id.doc_id").alias("_bad"), F.col("doc_id._key").alias("_of")))
    same = F.col("doc_id").eqNullSafe(F.col("_bad")) & F.col("_key").eqNullSafe(F.col("_of"))
    return back(own.join(checked(bad), same, "left_anti"))
