"""PII patterns and disclosing terms against brute force."""

import hashlib
import math
import random
import time
import re
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from relayplan.llm import sanitise

SCHEMA = "doc_id long, text string, _row string, n_chars long, _all int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10 == 0


def base(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end(), m[0]))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), m[0]))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), m[0]))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), m[0]))
    return sorted(out)


def terms(docs):
    """Spans of revealing terms of each row, by counting everything."""
    df_e, df_t, both, support, near = (defaultdict(set) for _ in range(5))
    for r, (_, t) in enumerate(docs):
        for w in set(WORD.findall((t or "").lower())):
            df_t[w].add(r)
        spans = base(t)
        for s, _, e, v in spans:
            df_e[v].add(r)
            left, right = t[max(0, s - 80):s].lower(), t[e:e + 80].lower()
            at = max(0, s - 80)
            some = [(at + m.start(), at + m.end(), m[0]) for m in WORD.finditer(left)
                    if m.end() < len(left) and not (len(left) == 80 and m.start() == 0)][-5:]
            some += [(e + m.start(), e + m.end(), m[0]) for m in WORD.finditer(right)
                     if m.start() > 0 and not (len(right) == 80 and m.end() == len(right))][:5]
            for a, b, w in some:
                if len(w) >= 2 and not any(a < y[2] and y[0] < b for y in spans):
                    near[r].add((v, w, a, b))
                    both[v, w].add(r)
                    support[v, w].add(t)
    n, out = len(docs), defaultdict(set)
    for r, found in near.items():
        for v, w, a, b in found:
            ic = math.log2(n / len(df_e[v]))
            pmi = math.log2(n * len(both[v, w]) / len(df_e[v]) / len(df_t[w]))
            if len(support[v, w]) >= 3 and ic > 0 and pmi >= 0.75 * ic - 1e-9:
                out[r].add((a, 4, b))
    return out


def awkward():
    rnd = random.Random(9)
    cards = ["4539 1488 0343 6467", "4539148803436467", "4539-1488-0343-6468", "1234 5678 9012 345678901"]
    rows = [(1, None), (2, ""), (3, "a@b.c_x@y.z.w a@b"), (3, "a@b.c_x@y.z.w a@b"), (4, "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.2.3"),
            (5, cards[0] + " " + cards[1]), (6, cards[0] + "," + cards[1] + "," + cards[2] + ";" + cards[3] + "; 7"),
            (7, "+1 (403) 555-9312, +49 30 1234567 + 1 +12 +1-2-3"), (None, "é😀 mail é.x@ü.de 😀 x@ab.de"),
            (8, "x" * 3000 + "@" + "a." * 3000 + "b"), (9, "1 " * 4000 + "12 34"), (10, "@" * 50 + "+" * 50)]
    for i in range(60):
        who = rnd.choice(["kim@corp.example", "+1 403 555 9312", "10.0.0.7", "zoe@corp.example"])
        code = {"kim@corp.example": "falcon", "10.0.0.7": "gateway"}.get(who, "nothing")
        rows.append((100 + i, f"the of {rnd.choice(['And', 'or', 'BUT'])} {code} and {who} the {rnd.choice('abcdefgh')}q of {i % 7}"))
    pieces = ["a", "@", ".", "1", "23", " ", "-", "+", "(", ")", "é", "😀", "255", "b.c", "4539148803436467"]
    rows += [(300 + i, "".join(rnd.choice(pieces) for _ in range(rnd.randrange(120)))) for i in range(150)]
    return rows


@pytest.mark.parametrize("source", ["awkward", "files"])
def test_scan_is_brute_force(spark, sf_small, source):
    rows = awkward() if source == "awkward" else [(r["doc_id"], r["text"]) for r in pq.read_table(
        f"{sf_small}/documents.parquet").to_pylist()]
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = sorted((str(r.doc_id), [(s.start, s.kind, s.stop, s.value) for s in r.base],
                  [(s.start, s.kind, s.stop) for s in r.spans]) for r in sanitise.scan(df).collect())
    more = terms(rows)
    want = sorted((str(i), base(t), sorted([x[:3] for x in base(t)] + list(more[r]))) for r, (i, t) in enumerate(rows))
    assert got == want
    if source == "awkward":
        assert any(more.values())


def test_digest_text(spark):
    df = spark.createDataFrame([(1, "call +1 403 555 9312 or a@b.cd")], "doc_id long, text string")
    r = sanitise.scan(df).select(sanitise.span_text(F.col("spans")).alias("s"),
                                 F.sha2(sanitise.span_text(F.col("base")), 256).alias("h")).first()
    assert r.s == "phone:5:20,email:24:30"
    assert r.h == hashlib.sha256(r.s.encode()).hexdigest()


def test_sanitise_rewrites_spans_only(spark):
    rows = awkward()
    df = spark.createDataFrame([(i, t, "s", len(t or ""), 2) for i, t in rows], SCHEMA).coalesce(1)
    out = sanitise.sanitise(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    more = terms(rows)
    mark = ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>", ""]
    want = []
    for r, (i, t) in enumerate(rows):
        at, new = 0, ""
        for s, k, e in sorted([x[:3] for x in base(t)] + list(more[r])):
            if e > at:
                new += (t[at:s] if s > at else "") + mark[k]
                at = e
        want.append((str(i), None if t is None else new + t[at:]))
    got = out.collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text is not None) == sorted(x for x in want if x[1] is not None)
    assert all(r.n_chars == len(r.text or "") for r in got)


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sanitise.scan(df).count() == 0 and sanitise.sanitise(df).count() == 0


def test_shuffled_input_leaks_nothing(spark):
    """Rows are numbered once: a shuffled table with a wide column, whose order
    differs between evaluations, keeps no address."""
    df = (spark.range(8000).selectExpr("id as doc_id", "concat('write to u', id, '@corp.example soon') as text",
                                       "repeat(md5(string(id)), 40) as wide").repartition("doc_id"))
    out = sanitise.sanitise(df)
    assert out.filter(F.contains("text", F.lit("@"))).count() == 0
    assert out.filter(F.contains("text", F.lit("<EMAIL>"))).count() == out.count() == 8000
    assert out.select("doc_id", "wide").exceptAll(df.select("doc_id", "wide")).isEmpty()


def test_time_is_linear_in_the_spans(spark):
    def seconds(n):
        text = " ".join(f"a{i}@b.cd" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.perf_counter()
        (new,) = sanitise.sanitise(df).select("text").first()
        assert new == " ".join(["<EMAIL>"] * n)
        return time.perf_counter() - began

    seconds(100)
    few, many = seconds(4000), seconds(16_000)
    assert many < 4 * few + 5
