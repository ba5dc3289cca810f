"""Suffix-array dedup against brute force, and the loser tree against sort."""

import random

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from relayplan.llm import blocks, suffix_dedup

SCHEMA = "doc_id long, text string, spans string, n int"


def brute(docs, length=50):
    first = {}
    big = blocks.NULL_ID
    raw = [(big if i is None else i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = True
        s, e = blocks.runs(gone)
        out.append((-1 if i == big else i, len(b), list(zip(s.tolist(), e.tolist(), strict=True)),
                    np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


def got(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(4)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.spans],
                   bytes(r.kept)) for r in suffix_dedup.dedup(df).collect())


def copied(seed, n=60):
    rnd = random.Random(seed)
    letters = "abcdeé \n\0"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.choice([10, 49, 50, 51, 120, 700]))) for _ in range(8)]
    docs = [(0, None), (1, ""), (2, "z" * 50), (3, "z" * 49), (4, "z" * 300), (None, "z" * 60), (None, "q" * 70)]
    for i in range(n):
        t = list("".join(rnd.choice(base) for _ in range(rnd.randrange(1, 5))))
        for _ in range(rnd.choice([0, 1, 3])):
            t[rnd.randrange(len(t))] = rnd.choice(letters)
        s = rnd.randrange(0, max(1, len(t) // 3))
        docs.append((10 + rnd.randrange(n), "".join(t[s:])))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_is_brute_force(spark, seed):
    docs = copied(seed)
    assert got(spark, docs) == brute(docs)


def test_dedup_of_files(spark, sf_small):
    rows = pq.read_table(f"{sf_small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs = [(r["doc_id"], r["text"]) for r in rows]
    assert got(spark, docs) == brute(docs)


def test_small_blocks(spark, monkeypatch):
    """Many blocks, so that runs meet in the merge."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 500)
    docs = copied(3, 90)
    assert got(spark, docs) == brute(docs)


def test_hot_anchors():
    """A passage in many surroundings, judged block by block on both paths."""
    rnd = random.Random(6)
    line = "this line stands in very many documents, with other words around it."
    docs = [(i, "".join(rnd.choice("abc ") for _ in range(rnd.randrange(30))) + line
             + "".join(rnd.choice("xyz ") for _ in range(rnd.randrange(40)))) for i in range(120)]
    want = {i: spans for i, _, spans, _ in brute(docs)}
    for hot in (4096, 1):
        data = [blocks.pack(np.array([i for i, _ in part], np.int64), np.array([len(t) for _, t in part], np.int64),
                            np.frombuffer("".join(t for _, t in part).encode(), np.uint8))
                for part in (docs[:50], docs[50:80], docs[80:])]
        suffix_dedup.HOT, old = hot, suffix_dedup.HOT
        try:
            asked = pd.concat(suffix_dedup.ask(enumerate(data), 3))
            status = pd.concat([suffix_dedup.settle(g) for _, g in asked.groupby("bucket")])
        finally:
            suffix_dedup.HOT = old
        left = [pd.DataFrame({"block": [i], "data": [d]}) for i, d in enumerate(data)]
        sent = pd.concat([suffix_dedup.send_open(3)(x, status[status.block == i]) for i, x in enumerate(left)])
        back = pd.concat([status, *[suffix_dedup.receive(3)(g) for _, g in sent.groupby("bucket")]])
        rows = pd.concat([suffix_dedup.remove(3)(x, back[back.block == i]) for i, x in enumerate(left)])
        spans = {r.doc_id: [(s["start"], s["stop"]) for s in r.spans] for r in rows.itertuples()}
        assert spans == want
        assert (sent["bucket"].max() >= 3) == (hot == 1)


def test_dedup_of_nothing(spark):
    assert got(spark, []) == []


def test_loser_tree_sorts():
    rnd = random.Random(4)
    for k in (1, 2, 3, 7, 16):
        runs = []
        for _ in range(k):
            s = sorted({bytes(rnd.choice(b"ab\0") for _ in range(6)) for _ in range(rnd.randrange(0, 30))})
            runs.append(np.array([list(x) for x in s], np.uint8).reshape(len(s), 6))
        coded = [suffix_dedup.front_code(r) for r in runs]
        for r, (lcp, tails) in zip(runs, coded, strict=True):
            assert (suffix_dedup.front_decode(lcp, tails, 6) == r).all()
        strings = [[bytes(x) for x in r] for r in runs]
        run, place, lcp = suffix_dedup.merge_runs(strings, [c[0].tolist() for c in coded], 6)
        merged = [strings[a][b] for a, b in zip(run, place, strict=True)]
        assert merged == sorted(x for s in strings for x in s)
        for i in range(1, len(merged)):
            a, b = merged[i - 1], merged[i]
            assert lcp[i] == next((j for j in range(6) if a[j] != b[j]), 6)


def test_key_ranges_are_even():
    """An anchor is the least of its neighbours; key ranges are even all the same."""
    rnd = np.random.default_rng(8)
    text = rnd.integers(97, 123, 400_000).astype(np.uint8)
    data = blocks.pack(np.array([1], np.int64), np.array([len(text)], np.int64), text)
    key = suffix_dedup.Judged(data).entries()[0]
    sizes = [s.stop - s.start for _, s in suffix_dedup.sections(key, 64, 48)]
    assert len(sizes) == 64 and max(sizes) < 1.3 * len(key) / 64
