"""Ordinal classifier: held-out accuracy, edge cases, gradients."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from relayplan.llm import ordinal_quality as q

SCHEMA = "doc_id long, text string, p_good string, n_chars long, c1 int"


def corpus(n=600, seed=1):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(30, 400))]
        kind = rnd.choice(["toxic", "junk", "good", "good", "good"])
        if kind == "toxic":
            for _ in range(max(2, len(w) // 15)):
                w[rnd.randrange(len(w))] = rnd.choice(["vile", "idiot", "scum"])
        if kind == "junk":
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), "x", len(w), i))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, SCHEMA).repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(2400)
    d, lab = frames(spark, docs, labels)
    model = q.train(d, lab.filter("doc_id % 2 = 0"))
    rows = q.score(d.filter("doc_id % 2 = 1"), model).collect()
    want = {i: 0 if t else 1 + g for i, g, t in labels}
    good = {r.doc_id: r.p_good >= q.ACCEPT for r in rows}
    assert len(rows) == 1200
    assert np.mean([good[i] == (want[i] == 2) for i in good]) > 0.95
    mean = lambda g: np.mean([r.expected_grade for r in rows if want[r.doc_id] == g])
    assert mean(0) < mean(1) < mean(2)


def test_held_out_accuracy_of_files(spark):
    sf = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = q.train(docs, lab.filter("pmod(xxhash64(doc_id, 1), 3) < 2"))
    held = lab.filter("pmod(xxhash64(doc_id, 1), 3) = 2")
    got = (q.score(docs, model).join(held, "doc_id")
           .groupBy(((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
           .agg(F.avg((F.col("p_good") >= q.ACCEPT).cast("double")).alias("kept")).collect())
    kept = {r.good: r.kept for r in got}
    assert kept[True] > 0.98 and kept[False] < 0.2


def test_same_model_each_time(spark):
    d, lab = frames(spark, *corpus(120))
    a, b = q.train(d, lab), q.train(d.repartition(5), lab)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_edges(spark):
    docs, labels = corpus(80)
    odd = [(None, None, "x", None, None), (1000, None, "y", 1, None), (1001, "", "z", 2, 1), (1001, "", "z", 2, 1),
           (1002, "\0 \x7f é 😀" * 50, "z", 2, 1), (1003, "a" * 100_000, "z", 2, 1)]
    d, lab = frames(spark, docs + odd, labels + [(None, 1, 1), (5, None, 0), (6, 1, None), (7, 0, 1)])
    got = q.rate(d, lab).collect()
    assert len(got) == 86 and all(0 <= r.p_good <= r.p_clean <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    left = q.select_good(d, lab)
    assert left.dtypes == d.dtypes
    ok = sorted(str(r.doc_id) for r in got if r.accepted)
    assert sorted(str(r.doc_id) for r in left.collect()) == ok
    both = {(r.doc_id, r.text, r.n_chars, r.c1) for r in left.collect()}
    assert both <= {(a, b, c, e) for a, b, _, c, e in docs + odd}


def test_no_labels_or_one_grade(spark):
    docs, labels = corpus(20)
    d, lab = frames(spark, docs, labels)
    assert {r.expected_grade for r in q.rate(d, lab.limit(0)).collect()} == {2.0}
    one = spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {round(r.expected_grade, 6) for r in q.rate(d, one).collect()} == {1.0}
    assert q.rate(d.limit(0), lab).count() == 0


def test_tails_are_ordered_probabilities():
    t = q.tails(np.array([-50.0, -1, 0, 1, 50]), np.array([2.0, -3.0]))
    assert (np.diff(t, axis=1) <= 0).all() and (t[:, 0] == 1).all() and (t[:, 3] == 0).all()


def plain_features(text):
    """Columns and values of one text, by loops: runs of one kind of bytes,
    hashed, by the root of their share; seven figures in bins."""
    raw = (text or "").encode()
    kinds = [int(q._KIND[b]) for b in raw]
    low = bytes(int(q._LOWER[b]) for b in raw)
    tokens, at = [], 0
    for i in range(1, len(raw) + 1):
        if i == len(raw) or kinds[i] != kinds[at]:
            if kinds[at]:
                tokens.append(low[at:i])
            at = i
    def column(data, salt=0):
        a = np.frombuffer(data, np.uint8)
        return int(q.word_codes(a, np.array([0]), np.array([len(a)]), salt)[0]) & ((1 << q.BITS) - 1)

    count = {}
    for t in tokens:
        count[column(t)] = count.get(column(t), 0) + 1
    total, size = max(len(tokens), 1), max(len(raw), 1)
    letters = max(sum(97 <= (b | 32) <= 122 for b in raw), 1)
    shape = [sum(65 <= b <= 90 for b in raw) / letters, kinds.count(2) / size, sum(48 <= b <= 57 for b in raw) / size,
             len(count) / total, max(count.values(), default=0) / total, min(size / total / 20, 1),
             min(math.log2(size) / 24, 1)]
    out = [(c, math.sqrt(n * 100 / total)) for c, n in count.items()]
    return out + [(column(bytes([min(int(x * 20), 19) + 20 * i]), 7), 2.0) for i, x in enumerate(shape)]


def test_score_is_brute_force(spark, sf_small):
    """Expected grade and tails of a given model, text by text, in plain loops."""
    rnd = np.random.default_rng(5)
    w, cuts = rnd.normal(0, 0.02, 1 << q.BITS).astype(np.float32), np.array([0.7, -0.4])
    rows = pq.read_table(f"{sf_small}/documents.parquet").to_pylist()[:120]
    texts = [r["text"] for r in rows] + [None, "", " ", "A1!é", "x" * 5000, "a b " * 2000, "\x00\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in q.score(df, (w, cuts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        s = sum(float(w[c]) * np.float32(v) for c, v in plain_features(t))
        tail = [1 / (1 + math.exp(-(s + c))) for c in cuts]
        assert abs(got[i].p_clean - tail[0]) < 1e-5 and abs(got[i].p_good - tail[1]) < 1e-5
        assert abs(got[i].expected_grade - sum(tail)) < 2e-5
