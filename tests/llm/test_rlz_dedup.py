"""Relative Lempel-Ziv dedup against brute force."""

import random
import re

import pyarrow.parquet as pq
import pytest

from relayplan.llm import blocks, rlz_dedup

SCHEMA = "doc_id long, text string, factors string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, length=20):
    big = blocks.NULL_ID
    rows = [(big if i is None else i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in rows:
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, w in rows:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < (i, p):
                gone[p:p + length] = [True] * length
        out.append((-1 if i == big else i, len(w), sum(gone),
                    " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


def got(spark, docs, texts=None):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(4)
    rows = rlz_dedup.dedup(df).collect()
    by = {i: WORD.findall(t or "") for i, t in docs}
    for r in rows:
        assert r.n_removed == len({x for f in r.factors for x in range(f.start, f.stop)})
        for f in r.factors:
            assert f.stop - f.start >= 20
            if texts is not None and len(docs) == len(by):  # each factor is a copy of its reference
                n = f.stop - f.start
                assert by[r.doc_id][f.start:f.stop] == by[f.ref_doc][f.ref_start:f.ref_start + n]
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode())
                  for r in rows)


def copied(seed, n=60, repeat=True):
    rnd = random.Random(seed)
    vocab = ["a", "bé", "c", "d d", "e"]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([5, 19, 20, 21, 60, 400]))] for _ in range(8)]
    docs = [(0, None), (1, ""), (2, " \n\t"), (3, "z " * 20), (4, " z\n" * 90), (5, "z " * 19)]
    for i in range(n):
        w = [x for _ in range(rnd.randrange(1, 5)) for x in rnd.choice(base)]
        for _ in range(rnd.choice([0, 1, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        sep = rnd.choice([" ", "\n", "  \t"])
        docs.append((10 + (rnd.randrange(n) if repeat else i), rnd.choice(["", " "]) + sep.join(w[rnd.randrange(3):])))
    return docs + ([(None, docs[-1][1]), (None, "q " * 30)] if repeat else [])


@pytest.mark.parametrize("seed,repeat", [(1, True), (2, False), (3, False)])
def test_dedup_is_brute_force(spark, seed, repeat):
    docs = copied(seed, repeat=repeat)
    assert got(spark, docs, True) == brute(docs)


def test_dedup_of_files(spark, sf_small):
    rows = pq.read_table(f"{sf_small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs = [(r["doc_id"], r["text"]) for r in rows]
    assert got(spark, docs, True) == brute(docs)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 500)
    docs = copied(4, 90, False)
    assert got(spark, docs, True) == brute(docs)


def test_dedup_of_nothing(spark):
    assert got(spark, []) == []
