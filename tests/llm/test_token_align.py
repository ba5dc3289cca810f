"""Alignment against the libraries themselves and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from relayplan.llm import token_align as T

SCHEMA = "doc_id long, text string, block string, n int"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(T.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=T.PIECE_BPE)


def spans(lib, text):
    """Tokens of both as (id, bytes), or none."""
    a, b = lib
    code = T._byte_of()
    if not text:
        return [], []
    raw = (" " + text).encode()
    at = [(i, bytes(code[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    bt = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        bt.append((i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    if b"".join(x for _, x in at) != raw or b"".join(x for _, x in bt) != raw:
        return [], []
    return at, bt


def placed(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def overlaps(at, bt):
    """Links by the definition, walking both lists."""
    out, j = [], 0
    for k, (i, s, e) in enumerate(at):
        while j and bt[j - 1][2] > s:
            j -= 1
        while j < len(bt) and bt[j][2] <= s:
            j += 1
        m = j
        while m < len(bt) and bt[m][1] < e:
            out.append((k, m, i, bt[m][0], min(e, bt[m][2]) - max(s, bt[m][1])))
            m += 1
    return out


def brute(lib, docs):
    rows, count = [], Counter()
    for i, t in docs:
        at, bt = map(placed, spans(lib, t))
        links = overlaps(at, bt)
        ends = sorted({e for _, _, e in at} & {e for _, _, e in bt})
        groups, low, shared = [], 0, 0
        for end in ends:
            ga = [x for x, s, e in at if low < e <= end] if len(at) < 3000 else None
            if ga is None:
                break
            gb = [x for x, s, e in bt if low < e <= end]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            shared += len(ga) * len(gb)
            low = end
        text = ";".join(groups)
        rows.append((i, len(at), len(bt), len(ends), len(links), shared, links,
                     hashlib.sha256(text.encode()).hexdigest() if text else ""))
        count.update({(a, b) for _, _, a, b, _ in links})
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return sorted((-1 if i is None else i, *c, sum(count[a, b] == top[a] for _, _, a, b, _ in links),
                   sum(count[a, b] for _, _, a, b, _ in links), sha) for i, *c, links, sha in rows)


def got(spark, docs, **how):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(4)
    return sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in T.alignment(df, **how).collect())


def corpus(sf):
    rnd = random.Random(4)
    real = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    docs = [(i, t[:1500]) for i, t in zip(real["doc_id"], real["text"], strict=True)][:60]
    docs += [(1000, None), (1001, ""), (1002, " "), (1003, "▁ mark"), (None, "no id"), (None, "no id"), (1004, "\x00a\n\n\t b"),
             (1005, "<|endoftext|><s></s><unk> <0x41>"), (1006, "é🙂漢字" * 20), (1007, "a" * 500), (1008, "  \r\n  "),
             (9223372036854775807, "largest"), (1009, "\U0010ffff ﷽")]
    docs += [(2000 + i, "".join(rnd.choice("aé 🙂\n'1.") for _ in range(80))) for i in range(40)]
    return docs


def test_alignment_is_brute_force(spark, sf_small, libraries):
    docs = corpus(sf_small)
    want = brute(libraries, docs)
    assert got(spark, docs) == want
    assert got(spark, docs, block_bytes=300) == want  # the same whatever the blocks
    assert {r[1:] for r in want if r[0] in (1000, 1001, 1003)} == {(0, 0, 0, 0, 0, 0, 0, "")}


def test_links_of_a_long_text_in_stretches(spark, libraries, monkeypatch):
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choice("abcdeé🙂") for _ in range(rnd.randrange(1, 12))) for _ in range(60_000))
    at, bt = map(placed, spans(libraries, text))
    want = overlaps(at, bt)
    df = spark.createDataFrame([(5, text)], "doc_id long, text string")
    rows = T.overlap_links(df).collect()
    assert len(text.encode()) > 2 * T.STRETCH
    assert [tuple(r)[1:6] for r in rows] == want
    groups = {r.a_at: (r.b_first, r.b_stop) for r in rows}
    assert all(groups[r.a_at][0] <= r.b_at < groups[r.a_at][1] for r in rows)


def test_product_is_that_of_dense_matrices():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n, k, m = rng.integers(0, 9, 3)
        a, b = (rng.integers(0, 4, s) * (rng.random(s) < 0.5) for s in ((n, k), (k, m)))

        def csr(x):
            rows, cols = np.nonzero(x)
            return T.Csr(np.searchsorted(rows, np.arange(len(x) + 1)), cols, x.shape[1], x[rows, cols])

        def dense(c):
            out = np.zeros((c.rows, c.columns), int)
            out[c.row_of(), c.indices] = c.data
            return out

        assert (dense(T.gustavson(csr(a), csr(b))) == a @ b).all()
        assert (dense(csr(a).transposed()) == a.T).all()


def test_hot_pair_and_empty_table(spark, libraries):
    docs = [(i, "the the" if i % 3 else f"x{i} theory") for i in range(90)]
    assert got(spark, docs, block_bytes=50) == brute(libraries, docs)
    assert T.alignment(spark.createDataFrame([], SCHEMA)).count() == 0
