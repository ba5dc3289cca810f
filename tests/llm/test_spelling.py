"""Spelling variants against brute force; trie numbering against plain sets."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from relayplan.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    form, k = {}, {}
    for w in n:
        have = [o for o in n if near(w, o)]
        k[w] = len(have)
        best = min(have, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n[w], k[w], n[form[w]] if form[w] else 0) for w in n)


def got(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(4)
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in spelling.group(df).collect())


def corpus(seed):
    rnd = random.Random(seed)
    base = ["hello", "hellö", "aabbcc", "aaaaaa", "Größe", "straÿe", "étude", "banana", "zebra", "zzzzz"]
    words = list(base)
    for _ in range(60):  # chains of variants
        w = rnd.choice(words)
        i = rnd.randrange(len(w))
        words.append(rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abzéÿÉ") + w[i + rnd.randrange(2):]]))
    docs = [(0, None), (1, ""), (2, "a b c"), (3, "x" * 9), (None, "Hello hello hello Ééééé Ééééé Ééééé")]
    for _ in range(300):
        docs.append((rnd.randrange(60), " 1,".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 40])))))
    docs += [(900 + i, "q" * 3000 + " " + "q" * 3001) for i in range(3)]
    # counts that double along a chain of forms
    docs += [(1000 + i, " ".join(f"abcd{'xy'[j] * (j // 2 + 1)}" for j in (0, 1))) for i in range(9)]
    chain = ["chaina", "chainab", "chainabc", "chainabcd", "chainabcde", "chainabcdef"]
    docs += [(2000 + i, w) for j, w in enumerate(chain) for i in range(3 * 2 ** (len(chain) - j))]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_brute_force(spark, seed):
    docs = corpus(seed)
    want = brute(docs)
    assert got(spark, docs) == want
    assert any(w[2] not in (w[0], w[1]) for w in want) and any(w[4] > 3 for w in want)


def test_numbers_are_nodes():
    """Over ranges of any cut, equal prefixes and only these have equal numbers."""
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 9))) for _ in range(400)})
    for parts in (1, 2, 7, 60, len(words)):
        cuts = [0, *sorted(rnd.sample(range(1, len(words)), parts - 1)), len(words)]
        heads = [words[c] for c in cuts[:-1]]
        border = spelling.border_nodes(heads)
        seen, order = {}, []
        for a, b in zip(cuts, cuts[1:], strict=False):
            for w, (wid, nodes) in zip(words[a:b], spelling.numbered(iter(words[a:b]), heads, border), strict=True):
                order.append(wid)
                assert len(nodes) == len(w) + 1
                for i, x in enumerate(nodes.tolist()):
                    assert seen.setdefault(w[:i], x) == x
        assert len(set(seen.values())) == len(seen) and order == sorted(set(order))


def test_a_range_read_from_the_middle_is_an_error():
    with pytest.raises(RuntimeError):
        list(spelling.numbered(iter(["b"]), ["a"], [np.zeros(2, np.int64)]))


def test_pairs_stay_small(spark):
    """Each word gives two pairs a place, and no pair has more words than letters."""
    docs = [(i, "".join(f"wor{a}s{b} " for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefgh")) for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    vocab = spelling.vocabulary(df).cache()
    d = spelling.pairs(spelling.trie(vocab, False), spelling.trie(vocab, True))
    assert d.count() == sum(2 * len(r.word) + 1 for r in vocab.collect())
    assert d.groupBy("before", "after").count().agg({"count": "max"}).first()[0] <= 91
    vocab.unpersist()


def test_hot_word_and_empty_table(spark):
    docs = [(i, "common " * 50 + ("commom" if i < 40 else "")) for i in range(200)]
    assert got(spark, docs) == brute(docs)
    assert spelling.group(spark.createDataFrame([], SCHEMA)).count() == 0
