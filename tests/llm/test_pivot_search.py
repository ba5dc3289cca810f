"""Pivot-distance search against brute force."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from relayplan.llm import pivot_search

SCHEMA = "vec_id long, embedding array<float>, rank int, pivot string"


def cut(x, size):
    return max(-size, min(x, size if size < 1 << 63 else size - 1))


def brute(rows, k=10, every=100):
    ok = [(i, [cut(math.floor(1024 * float(np.float32(x))), 1 << 62) for x in v]) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i is not None and i % every == 0:
            s = sorted((-cut(sum(a * b for a, b in zip(q, v, strict=True)), 1 << 63), j)
                       for j, v in ok if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s[:k])]
    return sorted(out)


def got(spark, rows, every=100):
    df = spark.createDataFrame([(i, v, 1, "p") for i, v in rows], SCHEMA).repartition(3)
    v = pivot_search.quantise(df)
    return sorted(tuple(r) for r in pivot_search.top_k(v, v.filter(f"vec_id % {every} = 0")).collect())


def vectors(n, dim, seed, kind):
    rnd = np.random.default_rng(seed)
    if kind == "hot":  # a third are the same vector
        rows = [(i, ([0.5] * dim if i % 3 == 0 else rnd.normal(size=dim).tolist())) for i in range(n)]
    elif kind == "clusters":
        c = rnd.normal(size=(5, dim)) * 10
        rows = [(i, (c[i % 5] + rnd.normal(size=dim) * 0.1).tolist()) for i in range(n)]
    else:
        rows = [(i, (rnd.normal(size=dim) * 10.0 ** rnd.integers(-3, 4)).tolist()) for i in range(n)]
    return rows


@pytest.mark.parametrize("kind,n,dim", [("hot", 900, 8), ("clusters", 700, 16), ("scales", 500, 5), ("hot", 7, 3)])
def test_search_is_brute_force(spark, monkeypatch, kind, n, dim):
    monkeypatch.setattr(pivot_search, "CELL_ROWS", 50)
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 8)
    rows = vectors(n, dim, 1, kind)
    every = 20 if n > 100 else 2
    assert got(spark, rows, every) == brute(rows, every=every)


def test_bad_vectors_take_no_part(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.random() for _ in range(4)]) for i in range(40)]
    rows += [(40, None), (41, []), (42, [1.0, None, 1.0, 1.0]), (100, [float("nan"), 1.0, 1.0, 1.0]),
             (43, [float("inf"), 0.0, 0.0, 0.0])]
    assert got(spark, rows, 20) == brute(rows, every=20)


def test_widths_and_large_components(spark, monkeypatch):
    """Each width is searched by itself, also one that the sample misses;
    components of any finite size take part."""
    monkeypatch.setattr(pivot_search, "SAMPLE", 60)
    monkeypatch.setattr(pivot_search, "CELL_ROWS", 20)
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 4)
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=4 if i % 3 else 8) * 10.0 ** rnd.integers(-2, 3)).tolist()) for i in range(400)]
    rows += [(400 + i, rnd.normal(size=3).tolist()) for i in range(0, 50, 5)]  # few rows of a third width
    rows += [(1000 + i, [float(x) for x in rnd.choice([-1e17, -3e12, 0.0, 2e16, 5e30], 4)]) for i in range(0, 60, 5)]
    assert got(spark, rows, 20) == brute(rows, every=20)


def test_cells_are_sent_to_the_blocks_that_visit_them(spark):
    """Rows of the index meet the blocks of their ring only."""
    rows = vectors(600, 6, 3, "clusters")
    df = spark.createDataFrame([(i, v, 1, "p") for i, v in rows], SCHEMA)
    v = pivot_search.quantise(df)
    pivots = pivot_search.choose_pivots(v)
    index, stats = pivot_search.build_index(v.withColumn("is_query", pivot_search.F.lit(False)), pivots)
    q = index.filter("vec_id < 5").select("vec_id", "v", "dim").toPandas()
    first = next(pivot_search.visits(pivots, stats, 10, False)(iter([q])))
    assert index.count() == 600 and first["query_id"].nunique() == 5
    seen = first[["dim", "pivot", "ring"]].drop_duplicates().merge(stats)["n"].sum()
    assert seen < 300  # of 600 rows, by five queries


def test_nothing(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0, 2.0])]) == []
    assert got(spark, [(0, [1.0, 2.0])]) == []


def test_files(spark, sf_small):
    t = pq.read_table(f"{sf_small}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in t]
    assert got(spark, rows) == brute(rows)


def test_large_components_are_exact():
    a = np.array([[1 << 40, 3]], np.int64)
    assert pivot_search.inner(a, np.array([[5, 7]], np.int64))[0, 0] == (5 << 40) + 21
    assert pivot_search.inner(a, a)[0, 0] == np.iinfo(np.int64).max


def test_search_over_many_partitions(spark):
    """Cells and the queries that visit them meet, however many partitions the
    exchange has."""
    key, rows = "spark.sql.adaptive.coalescePartitions.enabled", vectors(300, 6, 4, "hot")
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert got(spark, rows, 20) == brute(rows, every=20)
    finally:
        spark.conf.set(key, before)
