"""Sharding by Hilbert-curve order.

Several metadata dimensions (language, source, size) are quantised in their own
order to a few bits each, by shares of rows, so that cells are ranges of values
and hold similar row counts; the cells are ordered along a Hilbert curve, so that rows near each
other on the curve are near in every dimension, and the ordered rows are cut
into runs of equal row counts. Each run covers a small box of every dimension,
which is what lets a reader skip files by their min/max values.

Law: ``rows``. Shard sizes are at most one row apart.

Ranks are computed without one global sort: rows are counted per (cell,
slice), where a slice is a hash of the row key that splits hot cells; running
sums over the cells (at most 2**(dims*bits) of them, whatever the input) give
each slice its first rank, and only within a slice are rows numbered.

Defined cases: null text has no bytes (size 1) and checksum 0; null language
or source comes before all values; equal rows are numbered in any order; an
empty table gives no rows; columns beyond the used ones pass through
``place_rows`` unless they carry one of its output names, then they are
replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relayplan.llm.common import kept

SLICES = 256


def curve_index(cell: Sequence[int], bits: int) -> int:
    """Position of a cell on the Hilbert curve through a cube of
    ``2**bits`` cells a side: the axes are turned into the transposed index
    (undo the excess work from the top bit down, then Gray-encode) and the
    bits are interleaved."""
    x = list(cell)
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    h = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            h = (h << 1) | (((x[i] ^ t) >> b) & 1)
    return h


def curve_table(dims: int, bits: int) -> list[int]:
    """Curve index of each cell; a cell's number has ``bits`` bits per axis."""
    side = 1 << bits
    return [curve_index([(c >> (bits * (dims - 1 - i))) & (side - 1) for i in range(dims)], bits)
            for c in range(side ** dims)]


def cell_starts(df: DataFrame, column: str, bits: int) -> list[tuple[object, int]]:
    """``(least value, cell)`` of each used cell of a column, in order: a value's
    cell is the share of rows with smaller values (nulls first), in steps of
    ``1 / 2**bits``. At most ``2**bits`` pairs, whatever the input.

    Rows are counted per value; ranges of values are summed apart and running
    sums over the ranges give each its first rank."""
    value, side = F.col(column).asc_nulls_first(), 1 << bits
    counts = kept(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).repartitionByRange(value)
                  .withColumn("_part", F.spark_partition_id()))
    run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("_part").agg(F.sum("_n").alias("_in")).select(  # a row per range
        "_part", F.coalesce(F.sum("_in").over(run), F.lit(0)).alias("_first"),
        F.sum("_in").over(Window.partitionBy()).alias("_all"))
    within = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_first") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    cells = (counts.join(parts, "_part").withColumn("_before", before)
             .withColumn("_cell", F.expr(f"cast((_before * {side}) div _all as int)")))
    starts = cells.filter(F.col(column).isNotNull()).groupBy("_cell").agg(F.min(column).alias("_start"))
    return [(r["_start"], r["_cell"]) for r in starts.orderBy("_cell").collect()]


def quantise(c: Column, starts: list[tuple[object, int]]) -> Column:
    """The cell of a value, by the starts of the cells; null is in cell 0."""
    cell = F.lit(0)
    for start, number in starts:
        cell = F.when(c >= F.lit(start), F.lit(number)).otherwise(cell)
    return F.when(c.isNull(), F.lit(0)).otherwise(cell)


def slice_of(key: Column) -> Column:
    """One of ``SLICES`` (256) parts of the rows of a cell: the first byte of
    the MD5 of the key's text."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key["text_crc32"].cast("string"),
                                                key["doc_id"].cast("string"))), 1, 2), 16, 10).cast("int")


def place_rows(df: DataFrame, dims: Sequence[Column], key: Column, shards: int = 8,
               bits: int = 4) -> DataFrame:
    """``df`` with ``curve`` (Hilbert index), ``shard`` and ``slot``.

    ``dims`` are int columns already quantised to ``bits`` bits, ``key`` is a
    struct of ``text_crc32`` and ``doc_id``. Rows are ordered by (curve, slice
    of ``key``, key) and cut into ``shards`` runs whose row counts differ by one
    at most.
    """
    lookup = F.array(*[F.lit(h) for h in curve_table(len(dims), bits)])
    cell = dims[0]
    for d in dims[1:]:
        cell = cell * (1 << bits) + d
    used = [c for c in df.columns if c not in ("curve", "shard", "slot")]
    rows = (df.withColumn("_cell", cell)
            .withColumn("_curve", F.get(lookup, F.col("_cell")))
            .withColumn("_key", key)
            .withColumn("_slice", slice_of(F.col("_key")))
            .select(*used, "_curve", "_key", "_slice"))
    counts = rows.groupBy("_curve", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # cells: at most 2**(dims*bits) rows, so one task may sum them up
    per_cell = counts.groupBy("_curve").agg(F.sum("_n").alias("_n"))
    run = Window.orderBy("_curve").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    cells = per_cell.select(
        "_curve", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"),
        F.sum("_n").over(total).alias("_all"))
    in_cell = (Window.partitionBy("_curve").orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    first = (counts.withColumn("_in", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
             .join(cells, "_curve")
             .select("_curve", "_slice", (F.col("_before") + F.col("_in")).alias("_first"), "_all"))
    numbered = rows.withColumn("_no", F.row_number().over(
        Window.partitionBy("_curve", "_slice").orderBy("_key")) - 1)
    ranked = numbered.join(first, ["_curve", "_slice"])
    rank = F.col("_first") + F.col("_no")
    # exact integers: shard s starts at ceil(s * n / shards)
    shard = F.expr(f"cast(((_first + _no) * {shards}) div _all as int)")
    start = F.expr(f"(_shard * _all + {shards} - 1) div {shards}")
    return (ranked.withColumn("_shard", shard)
            .select(*used, F.col("_curve").alias("curve"), F.col("_shard").alias("shard"),
                    (rank - start).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 8, bits: int = 4) -> DataFrame:
    """Documents' keys, sizes, checksums, ``lang`` and ``source`` with their
    place on the curve through (language, source, size)."""
    text = F.col("text").cast("binary")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    base = kept(docs.select(  # texts are read once
        "doc_id", size.alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), "lang", "source"))
    dims = [quantise(F.col(c), cell_starts(base, c, bits)) for c in ("lang", "source", "size")]
    return place_rows(base, dims, F.struct("text_crc32", "doc_id"), shards, bits)


def manifest(placed: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per shard: rows and the least and greatest value of each dimension, for
    skipping files."""
    return placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order inside each file."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(path))
