"""Line dedup by range-partitioned hashes.

Texts are cut at line feeds. A line's key is the line without blanks at both
ends, A-Z lower-cased. Keys of at least ``MIN_CHARS`` code points found in at
least ``MIN_DOCS`` documents lose all their lines except in the document of
the largest id.

1. Each long line sends the hash of its key (128 bits), its document and its
   place, no text. These rows are partitioned by ranges of (hash, document) and
   sorted by document and position within. The lines of one key lie side by
   side in that order; as a range may end at any document, a key that a third
   of all documents hold is cut into as many ranges as its rows need.
2. The first line of each (key, document) is found while the sorted rows stream
   by. Per key, their number and the largest id are summed up in each range
   first, so that a hot key gives one row per range.
3. Lines that go become one bit each. Per document, 64 lines make a word; words
   without a lost line are left out. Only these keep bitmaps are returned;
   applying them to the texts is a step of its own.

A bitmap belongs to an id and a text (its 64-bit hash), not to a row, so that
nothing depends on the order in which rows are read.

Defined cases: null and empty texts are one empty line; rows of the same id
are one document when documents are counted, equal rows get equal results; null
ids count as one document, smaller than all others; lines of no key that counts
stay as they are, blanks and all; an empty table gives no rows; only ``doc_id``
and ``text`` are read, and ``drop_lines`` keeps all columns, of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relayplan.llm.common import ascii_lower, aside, kept

MIN_CHARS = 40
MIN_DOCS = 5
#: Lines in a word of a bitmap.
WORD = 64
BLANKS = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Long lines: hash of the key in two numbers, document, place."""
    bare = F.trim(F.col("line"), F.lit(BLANKS))
    # the built-in lower-casing is faster and the same where all letters are ASCII
    key = F.when(F.octet_length("bare") == F.length("bare"), F.lower("bare")).otherwise(ascii_lower(F.col("bare")))
    return (docs.select("doc_id", _digest(F.col("text")).alias("digest"),
                        F.posexplode(lines(F.col("text"))).alias("pos", "line"))
            .select("doc_id", "digest", "pos", bare.alias("bare")).filter(F.length("bare") >= min_chars)
            .select("doc_id", "digest", "pos", key.alias("key"))
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                    "doc_id", "digest", "pos"))


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per id and text with a line that goes: ``doc_id``, ``digest``,
    ``n_dropped`` and ``keep``, an array of (word, bits): bit ``i`` of word
    ``w`` tells whether line ``64 * w + i`` stays. Words that are left out
    keep all their lines."""
    rows = kept(occurrences(docs, min_chars).repartitionByRange("h1", "h2", "doc_id")
                .sortWithinPartitions("h1", "h2", "doc_id", "pos"))
    turn = F.row_number().over(Window.partitionBy("h1", "h2", "doc_id").orderBy("pos"))
    shared = (rows.withColumn("turn", turn).filter(F.col("turn") == 1)
              .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
              .filter(F.col("n") >= min_docs).select("h1", "h2", "last"))
    gone = rows.join(shared, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    return (gone.groupBy("doc_id", "digest", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
            .agg(F.bit_or(bit).alias("gone"))
            .groupBy("doc_id", "digest").agg(
                F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
                F.sum(F.bit_count("gone")).cast("long").alias("n_dropped")))


def dropped(keep: Column) -> Column:
    """Places of the lines that a keep bitmap drops."""
    return F.flatten(F.transform(keep, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(w["bits"], i) == 0),
        lambda i: w["word"] * WORD + i)))


def applied(text: Column, keep: Column) -> Column:
    """A text's lines that stay, joined. Lines and places are bound once."""
    cut = lines(text)
    both = F.struct(cut.alias("line"), F.array_except(
        F.sequence(F.lit(0), F.size(cut) - 1), dropped(keep)).alias("stay"))
    return F.get(F.transform(F.array(both), lambda b: F.array_join(
        F.transform(b["stay"], lambda i: F.get(b["line"], i)), "\n")), F.lit(0))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    maps = bitmaps.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "keep", "n_dropped")
    return docs.join(maps, F.col("doc_id").eqNullSafe(F.col("_id")) & (_digest(F.col("text")) == F.col("_digest")),
                     "left")


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines``, ``n_dropped``, ``keep`` (null where
    all lines stay) and the text that is ``kept``."""
    docs = docs.select("doc_id", "text")
    out = with_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars))
    text = F.col("text")
    return out.select(
        "doc_id", F.size(lines(text)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep",
        F.when(F.col("keep").isNull(), F.coalesce(text, F.lit(""))).otherwise(applied(text, F.col("keep"))).alias("kept"))


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that go; null texts stay null."""
    docs, back = aside(docs, "doc_id", "text")
    out = with_bitmaps(docs, keep_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars))
    text = F.when(F.col("keep").isNull(), F.col("text")).otherwise(applied(F.col("text"), F.col("keep")))
    return back(out.withColumn("text", text))
