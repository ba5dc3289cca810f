"""Exact top-k search by inner product with a pivot-distance index.

Vectors are integers: ``floor(SCALE * x)`` of each component. Pivots are chosen
from a bounded sample (farthest first). Every vector is keyed by its nearest
pivot and its distance from it; the sorted distances of a pivot's vectors are
cut into rings (annuli), rings into cells of bounded size.

For a query q at distance d(q, p) from a pivot, a vector x in a ring of p has
``|q - x| >= gap``, the distance from d(q, p) to the ring's range of d(x, p)
(triangle inequality), and so ``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2`` is at
most ``(|q|^2 + max |x|^2 - gap^2) / 2``. Round one searches the rings with the
greatest bounds until they hold enough candidates, which gives a k-th score to
beat; round two searches exactly those other rings whose bound reaches it.
Nothing else can be in the result, so it is exact.

Each width (number of components) has pivots and rings of its own, as products
are defined within a width only; a width that the sample misses has the zero
vector as its pivot. Ring statistics are at most ``PIVOTS * RINGS`` rows a
width, whatever the number of vectors. A hot vector fills one ring; its cells
are still bounded, queries meet each cell in blocks, and a cell is sent once
for each block of the queries that visit its ring.

Defined cases: vectors that are null, empty or hold null, infinite or undefined
components take no part; a query's candidates are the rows of its width; ties
go to the smaller id, null ids last; with fewer than k candidates all are
returned; products that may leave 64 bits are summed in exact integers and
scores cut to 64 bits; quantised components are cut at 2**62 in size, which
matters for values above 4.5e15 only; an empty table gives no rows. ``vec_id`` is taken as unique: a
query's candidates are the rows with another id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relayplan.llm.common import kept

SCALE = 1024
PIVOTS = 32
RINGS = 32
CELL_ROWS = 2048
QUERY_BLOCK = 2048
SAMPLE = 4096
#: Greatest size of a quantised component.
LARGEST = 1 << 62
#: Pivot, ring and the vector as bytes of 64-bit integers.
KEYED = "vec_id long, v binary, dim int, pivot int, dist double, norm double, is_query boolean"
HITS = "query_id long, vec_id long, score long"


def quantise(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, the integer vector; rows that take part only."""
    x, limit = F.transform("embedding", lambda c: c.cast("double")), F.lit(float(LARGEST))
    ok = (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.filter(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, limit), -limit)).cast("long")).alias("v"))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Pivots by width: farthest-first choice among the ``SAMPLE`` rows of least
    id hash."""
    pools: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect():
        pools.setdefault(len(r["v"]), []).append(r["v"])
    return {dim: farthest_first(np.array(pool, np.float64), count) for dim, pool in pools.items()}


def farthest_first(pool: np.ndarray, count: int) -> np.ndarray:
    picked, gap = [0], np.linalg.norm(pool - pool[0], axis=1)
    while len(picked) < min(count, len(pool)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(pool - pool[picked[-1]], axis=1))
    return pool[picked]


def pivots_of(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return pivots[dim] if dim in pivots else np.zeros((1, dim))


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    for i, p in enumerate(pivots):
        out[:, i] = np.linalg.norm(x - p, axis=1)
    return out


def key_batches(pivots: dict[int, np.ndarray]):
    def run(batches):
        for b in batches:
            for dim, part in b.groupby(b["v"].map(len)):
                x = np.array(part["v"].tolist(), np.int64)
                d = distances(x.astype(np.float64), pivots_of(pivots, dim))
                near = d.argmin(axis=1)
                yield pd.DataFrame({
                    "vec_id": part["vec_id"], "v": [r.tobytes() for r in x], "dim": np.int32(dim),
                    "pivot": near.astype(np.int32), "dist": d[np.arange(len(x)), near],
                    "norm": (x.astype(np.float64) ** 2).sum(axis=1), "is_query": part["is_query"]})
    return run


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(len(column), -1)


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, exact."""
    big = max(int(np.abs(q).max(initial=0)), int(np.abs(x).max(initial=0)))
    if big * big * q.shape[1] < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if big * big * q.shape[1] < 1 << 63:
        return q @ x.T
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.clip(q.astype(object) @ x.astype(object).T, low, high).astype(np.int64)


def search_cell(k: int):
    """The best ``k`` rows of a cell for each query of a block."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        left = left.sort_values("vec_id")
        ids, qid = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        x, out = matrix(left["v"]), []
        for s in range(0, len(right), 256):
            score = inner(matrix(right["q"].iloc[s:s + 256]), x)
            for i, row in enumerate(score):
                other = np.flatnonzero(ids != qid[s + i])
                best = other[np.argsort(-row[other].astype(np.float64), kind="stable")[:k]]
                if len(other) > k:  # all ties of the last score, then the smaller ids
                    least = np.partition(row[other], len(other) - k)[len(other) - k]
                    above = other[row[other] > least]
                    best = np.concatenate((above, other[row[other] == least][:k - len(above)]))
                out.append(pd.DataFrame({"query_id": qid[s + i], "vec_id": ids[best], "score": row[best]}))
        return pd.concat(out)
    return run


def visits(pivots: dict[int, np.ndarray], stats: pd.DataFrame, k: int, beyond: bool):
    """The rings each query visits: in round one those of the greatest bounds
    that together hold more than ``k`` rows; ``beyond``: all others whose
    bound reaches the ``need`` of round one."""
    rings = dict(tuple(stats.groupby("dim")))

    def visited(b: pd.DataFrame, dim: int) -> pd.DataFrame:
        at = rings[dim]
        q = matrix(b["v"]).astype(np.float64)
        d, norm = distances(q, pivots_of(pivots, dim)), (q ** 2).sum(axis=1)
        near = d[:, at["pivot"].to_numpy()]
        gap = np.maximum(0, np.maximum(at["low"].to_numpy() - near, near - at["high"].to_numpy()))
        bound = (norm[:, None] + at["norm"].to_numpy() - gap ** 2) / 2
        bound += 1 + 1e-9 * (norm[:, None] + at["norm"].to_numpy())  # rounding of distances
        order = np.argsort(-bound, axis=1, kind="stable")
        held = np.cumsum(at["n"].to_numpy()[order], axis=1)
        early = np.zeros(bound.shape, bool)
        np.put_along_axis(early, order, np.concatenate(
            (np.ones((len(q), 1), bool), held[:, :-1] <= k), axis=1), axis=1)
        want = early
        if beyond:
            need = b["need"].astype(float).fillna(-np.inf).to_numpy()
            need = np.where(need <= -2.0 ** 63, -np.inf, need)  # a score that was cut
            want = ~early & (bound >= need[:, None])
        rows, ring = np.nonzero(want)
        return pd.DataFrame({
            "query_id": b["vec_id"].to_numpy()[rows], "q": b["v"].to_numpy()[rows], "dim": np.int32(dim),
            "pivot": at["pivot"].to_numpy()[ring].astype(np.int32),
            "ring": at["ring"].to_numpy()[ring].astype(np.int32)})

    def run(batches):
        for b in batches:
            for dim, part in b.groupby("dim"):
                if dim in rings:
                    yield visited(part, dim)
    return run


def best(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` hits of each query, ranked."""
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def build_index(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> tuple[DataFrame, pd.DataFrame]:
    """Keyed vectors with ring and cell, and the statistics of the rings."""
    keyed = kept(vectors.mapInPandas(key_batches(pivots), KEYED))
    # ring borders: quantiles of each pivot's distances
    edge = keyed.groupBy("dim", "pivot").agg(F.percentile_approx(
        "dist", [i / RINGS for i in range(1, RINGS)], 1000).alias("_edge"))
    ringed = keyed.join(edge, ["dim", "pivot"]).withColumn(
        "ring", F.size(F.filter("_edge", lambda e: e < F.col("dist")))).drop("_edge")
    stats = ringed.groupBy("dim", "pivot", "ring").agg(
        F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("norm").alias("norm"),
        F.count(F.lit(1)).alias("n"))
    stats = stats.withColumn("cells", F.ceil(F.col("n") / CELL_ROWS).cast("int"))
    # at most PIVOTS * RINGS rows a width
    return ringed, stats.toPandas().sort_values(["dim", "pivot", "ring"]).reset_index(drop=True)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` of
    greatest inner product with each row of ``queries``, itself excluded.
    Both have ``vec_id`` and the integer array ``v``."""
    spark = vectors.sparkSession
    pivots = choose_pivots(vectors)
    if not pivots:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index, stats = build_index(vectors.withColumn("is_query", F.lit(False)), pivots)
    asked = kept(queries.withColumn("is_query", F.lit(True))
                 .mapInPandas(key_batches(pivots), KEYED).select("vec_id", "v", "dim"))
    # both sides of the cogroup need keys of one type: an int and a long of the
    # same value fall into different partitions
    cells = spark.createDataFrame(stats[["dim", "pivot", "ring", "cells"]]).select(
        *[F.col(c).cast("int").alias(c) for c in ("dim", "pivot", "ring", "cells")])
    schema = "query_id long, q binary, dim int, pivot int, ring int"
    ring = ["dim", "pivot", "ring"]

    def search(asked: DataFrame, beyond: bool) -> DataFrame:
        visit = asked.mapInPandas(visits(pivots, stats, k, beyond), schema)
        # blocks of queries by ring: rings that nobody visits are not sent
        parts = kept(visit.groupBy(*ring).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("parts"))
                     .join(cells, ring))
        by = (*ring, "cell", "part")
        met = (visit.join(parts, ring)
               .withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
               .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))))
        data = (index.select("vec_id", "v", *ring).join(parts, ring)
                .withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
        return (data.select("vec_id", "v", *by).groupBy(*by)
                .cogroup(met.select("query_id", "q", *by).groupBy(*by))
                .applyInPandas(search_cell(k), HITS))

    early = kept(best(search(asked, False), k))
    need = early.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("need"))
    left = asked.join(need, F.col("vec_id") == F.col("_q"), "left").select("vec_id", "v", "dim", "need")
    late = search(kept(left), True)
    return best(early.drop("rank").unionByName(late), k).select("query_id", "rank", "vec_id", "score")
