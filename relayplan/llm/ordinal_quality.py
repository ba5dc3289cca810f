"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are ordered grades, here 0 (toxic), 1 (not toxic, poor) and 2 (good).
One weight vector over hashed text features is shared by all cut points:
``P(grade >= j) = sigmoid(w.x + b_j)`` with ``b_1 >= b_2 >= ...``. A document
gets its expected grade and the tail probability of the best grade; those
below ``ACCEPT`` are rejected.

Features: the rate of each hashed token (runs of letters, digits and other
non-ASCII, lower-cased, and runs of punctuation) on a square-root scale, and a
few shape figures (case, punctuation, digits, repetition, word length) in bins,
hashed likewise.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled documents of
least id hash, in one task that holds their sparse features only. Scoring runs
over all documents, each from its whole text.

Defined cases: null text counts as empty and has shape features only; labels
with nulls are not used; a document with several labels takes the lowest; rows
of equal id are scored each for itself; with no labels every document gets the
best grade, with labels of one grade that grade; an empty table gives no rows;
``select_good`` keeps all columns, of any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from relayplan.llm.blocks import pack, tidy, unpack, word_codes
from relayplan.llm.common import aside

GRADES = 3
BITS = 17
SAMPLE = 16_000
STEPS = 1500  # mini-batches, at least
EPOCHS = 24  # passes, at least
BATCH = 128
RATE = 0.25
DECAY = 2e-6
ACCEPT = 0.6
PIECE = 4 << 20

FEATURES = "grade int, data binary"
MODEL = "data binary"
SCORES = ("expected_grade", "p_good", "p_clean")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 white space and control, 1 letters, digits and non-ASCII, 2 punctuation
_KIND = np.full(256, 2, np.uint8)
_KIND[:33] = 0
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = 1
_KIND[127:] = 1


def pieces(texts: list) -> Iterator[list[bytes]]:
    """Texts as bytes, in pieces of bounded size; null is empty."""
    out, size = [], 0
    for t in texts:
        t = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if out and size + len(t) > PIECE:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: row starts (one more than rows), columns, values."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    kind = _KIND[text]
    edge = np.ones(len(text), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[offsets[:-1][offsets[:-1] < len(text)]] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(text))
    solid = kind[begin] > 0
    begin, end = begin[solid], end[solid]
    n, mask = len(texts), np.uint64((1 << BITS) - 1)
    doc = np.searchsorted(offsets, begin, "right") - 1
    col = (word_codes(_LOWER[text], begin, end) & mask).astype(np.int64)
    total = np.bincount(doc, minlength=n)
    cell, count = np.unique((doc << BITS) | col, return_counts=True)
    row, col = cell >> BITS, cell & ((1 << BITS) - 1)
    value = np.sqrt(count * (100.0 / np.maximum(total, 1)[row]))
    # shape: figures between 0 and 1 in ten bins, one column per figure and bin
    sums = lambda m: np.diff(np.concatenate(([0], np.cumsum(m)))[offsets])
    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(sums((text | 32) - np.uint8(97) < 26), 1)
    distinct = np.bincount(row, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, row, count)
    shape = [sums((text >= 65) & (text <= 90)) / letters, sums(kind == 2) / size,
             sums((text >= 48) & (text <= 57)) / size, distinct / np.maximum(total, 1),
             top / np.maximum(total, 1), np.minimum(size / np.maximum(total, 1) / 20, 1),
             np.minimum(np.log2(size) / 24, 1)]
    bins = np.stack([np.minimum((x * 20).astype(np.int64), 19) + 20 * i for i, x in enumerate(shape)], axis=1)
    extra = (word_codes(np.arange(256, dtype=np.uint8), np.arange(140), np.arange(140) + 1, 7) & mask)[bins]
    row = np.concatenate((row, np.repeat(np.arange(n), bins.shape[1])))
    col = np.concatenate((col, extra.ravel().astype(np.int64)))
    value = np.concatenate((value, np.full(bins.size, 2.0)))
    by = np.argsort(row, kind="stable")
    starts = np.searchsorted(row[by], np.arange(n + 1))
    return starts, col[by].astype(np.int32), value[by].astype(np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def tails(score: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade >= j) for j = 0 .. grades, one column each."""
    inner = sigmoid(score[:, None] + cuts)
    return np.concatenate((np.ones((len(score), 1)), inner, np.zeros((len(score), 1))), axis=1)


def fit(grades: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], n_grades: int = GRADES):
    """Weights and cut points by mini-batches with per-weight step sizes."""
    rnd = np.random.default_rng(1)
    share = np.array([(grades >= j).mean() for j in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    # cuts stay ordered: the first one and positive gaps
    cut = np.concatenate((first[:1], np.log(np.maximum(first[:-1] - first[1:], 1e-2))))
    w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    cut_seen = np.full(len(cut), 1.0)
    size = np.array([len(c) for c, _ in rows])
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(rows)))):
        order = rnd.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            col = np.concatenate([rows[i][0] for i in pick])
            val = np.concatenate([rows[i][1] for i in pick])
            own = np.repeat(np.arange(len(pick)), size[pick])
            score = np.bincount(own, w[col] * val, minlength=len(pick))
            cuts = cut[0] - np.concatenate(([0], np.cumsum(np.exp(cut[1:]))))
            tail, y = tails(score, cuts), grades[pick]
            at_y, beyond = tail[np.arange(len(y)), y], tail[np.arange(len(y)), y + 1]
            slope = -(1 - at_y - beyond) / len(y)  # of the loss by the score
            p = np.maximum(at_y - beyond, 1e-9)
            by_cut = np.zeros(len(cuts))
            np.add.at(by_cut, y[y > 0] - 1, -(at_y * (1 - at_y) / p)[y > 0])
            np.add.at(by_cut, y[y < n_grades - 1], (beyond * (1 - beyond) / p)[y < n_grades - 1])
            by_cut /= len(y)
            step = np.concatenate(([by_cut.sum()], [-by_cut[j:].sum() * np.exp(cut[j]) for j in range(1, len(cut))]))
            cut_seen += step ** 2
            cut -= 0.1 * step / np.sqrt(cut_seen)
            used, inverse = np.unique(col, return_inverse=True)
            g = np.bincount(inverse, slope[own] * val) + DECAY * w[used]
            seen[used] += g ** 2
            w[used] -= RATE * g / np.sqrt(seen[used])
    return w.astype(np.float32), cut[0] - np.concatenate(([0], np.cumsum(np.exp(cut[1:]))))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the labelled documents, the lowest of each."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return (labels.dropna(subset=["doc_id", "quality", "toxic"]).select(
        F.col("doc_id").alias("_id"), grade.alias("grade")).groupBy("_id").agg(F.min("grade").alias("grade")))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and cut points, from at most ``sample`` labelled documents."""
    picked = graded(labels).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    some = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))

    def extract(batches):
        for b in batches:
            at = 0
            for piece in pieces(b["text"].tolist()):
                starts, col, val = features(piece)
                yield pd.DataFrame({
                    "grade": b["grade"].iloc[at:at + len(piece)].to_numpy(),
                    "data": [pack(col[s:e], val[s:e]) for s, e in zip(starts[:-1], starts[1:], strict=True)]})
                at += len(piece)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["grade", "data"])  # the same model whatever the order of arrival
        grades = pdf["grade"].to_numpy()
        w, cuts = fit(grades, [tuple(unpack(d)) for d in pdf["data"]])
        tidy()
        return pd.DataFrame({"data": [pack(w, cuts, np.unique(grades).astype(np.int64))]})

    # documents may repeat an id: the bound holds for rows too
    rows = some.select("grade", "text").mapInPandas(extract, FEATURES)
    row_no = F.row_number().over(Window.partitionBy("_all").orderBy(F.xxhash64("data"), "data"))
    bounded = rows.withColumn("_all", F.lit(0)).withColumn("_no", row_no).filter(F.col("_no") <= sample)
    out = bounded.select("_all", "grade", "data").groupBy("_all").applyInPandas(learn, MODEL).collect()
    if not out:
        return None
    w, cuts, seen = unpack(bytes(out[0]["data"]))
    if len(seen) == 1:  # nothing to tell apart
        return np.zeros_like(w), np.where(np.arange(1, GRADES) <= seen[0], 40.0, -40.0)
    return w, cuts


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_good`` (best grade) and
    ``p_clean`` (above the lowest); these replace columns of their names."""
    own = [c for c in docs.columns if c not in SCORES]
    kept_types = docs.select(*own).dtypes
    # integers travel as text: with nulls pandas would make them floats
    schema = StructType([StructField(f.name, StringType() if t in ("bigint", "int") else f.dataType)
                         for f, (_, t) in zip(docs.select(*own).schema, kept_types, strict=True)]
                        + [StructField(c, DoubleType()) for c in SCORES])
    w, cuts = model if model is not None else (None, np.full(GRADES - 1, 40.0))

    def run(batches):
        for b in batches:
            parts = []
            for piece in pieces(b["text"].tolist()):
                starts, col, val = features(piece)
                row = np.repeat(np.arange(len(piece)), np.diff(starts))
                s = np.bincount(row, w[col] * val if w is not None else None, minlength=len(piece))
                parts.append(tails(s if w is not None else np.zeros(len(piece)), cuts))
            tail = np.concatenate(parts) if parts else np.zeros((0, GRADES + 1))
            yield b.assign(expected_grade=tail[:, 1:].sum(axis=1), p_good=tail[:, GRADES - 1],
                           p_clean=tail[:, 1])
        tidy()

    as_text = [F.col(c).cast("string").alias(c) if t in ("bigint", "int") else F.col(c) for c, t in kept_types]
    got = docs.select(*as_text).mapInPandas(run, schema)
    return got.select(*[F.col(c).cast(t).alias(c) for c, t in kept_types], *SCORES)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, expected grade, tail probabilities, decision."""
    got = score(docs.select("doc_id", "text"), train(docs, labels))
    return got.select("doc_id", "expected_grade", "p_good", "p_clean",
                      (F.col("p_good") >= ACCEPT).alias("accepted"))


def select_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected ones, all columns as they are."""
    model = train(docs, labels)
    inner, back = aside(docs, "text")
    return back(score(inner, model).filter(F.col("p_good") >= ACCEPT))
