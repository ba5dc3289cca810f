"""License scan and decontamination against brute force."""

import random
import re

import pyarrow.parquet as pq
import pytest

from relayplan.llm import decontaminate, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
SCHEMA = "doc_id long, text string, _bad string, n int, words string"


def texts(sf):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]


def awkward():
    rnd = random.Random(5)
    filler = ["alpha", "of", "the", "license", "mit", "général", "x1"]
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, "mit\nlicense mit-license"), (4, "mit\nlicense mit-license"),
            (5, "license mit"), (6, "the GNU General  Public, License"), (None, "Apache license"),
            (7, "Licensed under the Apache License, Version 2.0."), (8, "under licensed apache version 2 the license"),
            (9, " ".join(rnd.choice(filler) for _ in range(9000))),
            (10, " ".join(["pad"] * 31 + ["mit", "license"] + ["pad"] * 63 + ["general", "public", "license"]))]
    return rows


def scan_one(text):
    w = WORD.findall((text or "").lower())
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def method_labels(text):
    """Templates met by some block, by comparing every block with every template."""
    w = WORD.findall((text or "").lower())
    tpl = license_scan.templates()
    span = max(len(t.words) for t in tpl)
    out = set()
    for at in range(0, len(w), license_scan.STRIDE):
        block = set(w[at:at + license_scan.STRIDE + span - 1])
        for t in tpl:
            if not t.phrase and len(block & set(t.words)) >= t.threshold * len(set(t.words)) - 1e-9:
                out.add(t.label)
    return out


@pytest.mark.parametrize("source", ["awkward", "files"])
def test_scan_is_brute_force(spark, sf_small, source):
    rows = awkward() if source == "awkward" else texts(sf_small)
    df = spark.createDataFrame([(i, t, "l", 1, "w") for i, t in rows], SCHEMA).repartition(3)
    got = license_scan.scan(df).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    mine = sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key)
    assert mine == sorted([(i, *scan_one(t)) for i, t in rows], key=key)
    by = {}
    for i, t in rows:
        by[i] = set(scan_one(t)[4].split(",")) - {""} | method_labels(t)
    assert {r.doc_id: set(r.labels.split(",")) - {""} for r in got} == by
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


def test_scan_of_nothing(spark):
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def found(docs, items, t=0.8):
    sh = lambda w, k: {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}
    per_item, out = {}, {}
    for i, text in items:
        w = WORD.findall((text or "").lower())
        if w:
            k = min(5, len(w))
            per_item.setdefault(i, set()).update((k, s) for s in sh(w, k))
    per_doc = {}
    for d, text in docs:
        w = WORD.findall((text or "").lower())
        per_doc.setdefault(d, set()).update((k, s) for k in range(1, 6) for s in sh(w, k))
    for d, s in per_doc.items():
        for i, m in per_item.items():
            if len(m & s) >= t * len(m) - 1e-9:
                out[d, i] = (len(m), len(m & s))
    return out


def planted(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in
             enumerate([5, 7, 16, 31, 32, 33, 64, 3, 1, 0])] + [(20, None), (None, "q r s t u v w x")]
    docs = [(0, None), (1, ""), (2, "w1"), (None, "a Q r, s t u v w x z"), (3, "one two")]
    for d in range(40):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([3, 50, 400]))]
        item = rnd.choice(items[:9])[1].split()
        for _ in range(rnd.choice([0, 0, 1, 2])):  # near the threshold on both sides
            if item:
                item[rnd.randrange(len(item))] = "changed"
        at = rnd.randrange(len(w))
        docs.append((100 + d // 2, " ".join(w[:at] + item + w[at:])))
    return docs, items


def test_search_is_brute_force(spark, sf_small):
    docs, items = planted()
    for dd, ii in ((docs, items), (texts(sf_small), [(r["item_id"], r["text"]) for r in
                                   pq.read_table(f"{sf_small}/benchmark.parquet").to_pylist()])):
        d = spark.createDataFrame([(i, t, "x", 0, "n") for i, t in dd], SCHEMA)
        m = spark.createDataFrame(ii, "item_id long, text string")
        got = {(r.doc_id, r.item_id): (r.n_item, r.n_found) for r in decontaminate.search(d, m).collect()}
        assert got == found(dd, ii)
    assert found(docs, items)


def test_clean_drops_only_contaminated(spark):
    docs, items = planted()
    d = spark.createDataFrame([(i, t, "x", 0, "n") for i, t in docs], SCHEMA)
    m = spark.createDataFrame(items, "item_id long, text string")
    bad = {k[0] for k in found(docs, items)}
    left = decontaminate.clean(d, m)
    assert left.columns == d.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted((i or -1) for i, _ in docs if i not in bad)


def test_clean_keeps_other_rows_without_id(spark):
    docs = [(None, "x a b c d e f g y"), (None, "nothing of it"), (None, None), (None, "x a b c d e f g y"), (4, "fine")]
    d = spark.createDataFrame([(i, t, "x", 0, "n") for i, t in docs], SCHEMA)
    m = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    left = [r.text for r in decontaminate.clean(d, m).collect()]
    assert sorted(left, key=str) == [None, "fine", "nothing of it"]


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontaminate.search(docs, none).count() == 0
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.search(docs.limit(0), items).count() == 0
