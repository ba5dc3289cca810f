"""Hilbert sharding: the curve, the row law, places, edge rows."""

import itertools
import random
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from relayplan.llm import hilbert_shard as H

SCHEMA = "doc_id long, text string, lang string, source string, shard int, size string, _cell int"


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4), (4, 2)])
def test_curve_visits_all_cells_in_unit_steps(dims, bits):
    side = 1 << bits
    place = {}
    for cell in itertools.product(range(side), repeat=dims):
        place[H.curve_index(cell, bits)] = cell
    assert sorted(place) == list(range(side ** dims))
    for i in range(1, side ** dims):
        assert sum(abs(a - b) for a, b in zip(place[i], place[i - 1], strict=True)) == 1


def rows(n, seed=1):
    rnd = random.Random(seed)
    out = [(0, None, None, None), (1, "", "en", "src0"), (1, "", "en", "src0"), (None, "é" * 70_000, "de", None)]
    for i in range(n):
        hot = rnd.random() < 0.4
        out.append((10 + i, "same text" if hot else "x" * rnd.randrange(5000), "en" if hot else rnd.choice(["en", "fr"]),
                    "src0" if hot else f"src{rnd.randrange(9)}"))
    return out


def check(got, docs, shards=8):
    n = len(docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d[0]), len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    per = [[r for r in got if r.shard == s] for s in range(shards)]
    assert max(map(len, per)) - min(map(len, per)) <= 1 and sum(map(len, per)) == n
    for p in per:
        assert sorted(r.slot for r in p) == list(range(len(p)))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)  # runs of the curve


@pytest.mark.parametrize("n", [0, 3, 8, 500])
def test_law_and_slots(spark, n):
    docs = rows(n)
    df = spark.createDataFrame([(*d, 5, "z", 7) for d in docs], SCHEMA).repartition(3)
    check(H.shard_documents(df).collect(), docs)


def test_files_and_pruning(spark, sf_small):
    t = pq.read_table(f"{sf_small}/documents.parquet").to_pylist()
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    placed = H.shard_documents(df)
    check(placed.collect(), [(r["doc_id"], r["text"]) for r in t])
    boxes = H.manifest(placed, ["lang", "source", "size"]).collect()
    assert sum(b.rows for b in boxes) == len(t)
    # a reader of one source, language or size skips files by the least and greatest values
    for column in ("lang", "source", "size"):
        values = [r["size"] if column == "size" else r[column] for r in placed.select(column).collect()]
        shard = [(b[f"min_{column}"], b[f"max_{column}"]) for b in boxes]
        unsorted = [(min(v), max(v)) for v in (values[i::8] for i in range(8))]
        read = [sum(low <= v <= high for v in values for low, high in x) / len(values) for x in (shard, unsorted)]
        assert read[0] < 0.75 * read[1], (column, read)


def cells(values, bits):
    """Cells by plain counts: the share of rows with smaller values."""
    rank = {v: sum(w is None and v is not None or w is not None and v is not None and w < v for w in values)
            for v in set(values)}
    return {v: (r << bits) // len(values) for v, r in rank.items()}


@pytest.mark.parametrize("bits", [2, 4])
def test_cells_keep_order(spark, bits):
    rnd = random.Random(4)
    lang = ["en"] * 40 + [None] * 7 + [rnd.choice(["é", "Z", "a", "fr", ""]) for _ in range(30)]
    df = spark.createDataFrame([(v, len(v or "") * 7 + i % 5) for i, v in enumerate(lang)], "v string, n long")
    for c in ("v", "n"):
        got = df.repartition(3).select(c, H.quantise(F.col(c), H.cell_starts(df, c, bits)).alias("q")).distinct().collect()
        assert {r[c]: r.q for r in got} == cells([r[c] for r in df.collect()], bits)
    assert H.cell_starts(df.filter("false"), "v", bits) == []
    assert H.cell_starts(df.filter("v is null"), "v", bits) == []


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(*d, 5, "z", 7) for d in rows(100)], SCHEMA)
    H.write_shards(H.shard_documents(df), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 104 and back.select("shard").distinct().count() == 8


def test_nothing(spark):
    assert H.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
