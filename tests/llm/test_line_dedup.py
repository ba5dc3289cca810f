"""Line dedup against brute force over odd rows."""

import random

from relayplan.llm import line_dedup

SCHEMA = "doc_id long, text string, keep string, n_dropped int"
LONG = "the quick brown fox jumps over the lazy dog again and again"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(line_dedup.BLANKS).translate(UP)


def brute(docs):
    low = float("-inf")
    have = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                have.setdefault(key(line), set()).add(low if i is None else i)
    last = {k: max(v) for k, v in have.items() if len(v) >= 5}
    out = []
    for i, t in docs:
        cut = (t or "").split("\n")
        stay = [x for x in cut if last.get(key(x), low if i is None else i) == (low if i is None else i)]
        out.append((low if i is None else i, len(cut), len(cut) - len(stay), "\n".join(stay)))
    return sorted(out)


def frame(spark, docs, parts=4):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(parts)


def got(spark, docs):
    return sorted((float("-inf") if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept)
                  for r in line_dedup.dedup(frame(spark, docs)).collect())


def corpus(seed):
    rnd = random.Random(seed)
    pool = [LONG, "\t " + LONG.upper() + " \x0b\r", LONG + " É", LONG + " é", "x" * 40, "X" * 40, "y" * 39, " " + "y" * 39,
            "ü" * 40, " " + "z" * 39, " " + LONG, "short", "", "   "]
    docs = [(0, None), (1, ""), (2, "\n"), (None, LONG + "\n" + "x" * 40), (None, LONG), (3, LONG), (3, LONG),
            (3, LONG + "\n" + LONG), (-9223372036854775808, "x" * 40), (9223372036854775807, "y" * 39)]
    docs += [(10 + rnd.randrange(40), "\n".join(rnd.choice(pool) for _ in range(rnd.choice([1, 2, 5, 70, 200]))))
             for _ in range(50)]
    return docs


def test_dedup_is_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        assert got(spark, docs) == brute(docs)


def test_number_of_documents_at_the_border(spark):
    four = [(i, LONG) for i in range(4)]
    assert got(spark, four) == brute(four) and all(r[2] == 0 for r in got(spark, four))
    assert [r[2] for r in got(spark, [*four, (9, LONG.upper())])] == [1, 1, 1, 1, 0]
    # repeats within a document or of an id are one document
    same = [*four, (3, LONG + "\n" + LONG)]
    assert got(spark, same) == brute(same) and all(r[2] == 0 for r in got(spark, same))


def test_hot_line_and_very_long_text(spark):
    rnd = random.Random(5)
    own = lambda i: f"{rnd.random()} line of document {i} that nobody else has at all"
    docs = [(i, "\n".join([own(i), LONG] if i % 3 == 0 else [own(i)])) for i in range(3000)]
    docs.append((3001, "\n".join(rnd.choice([LONG, "a", own(0)]) for _ in range(30_000))))
    want = brute(docs)
    assert got(spark, docs) == want and sum(r[2] for r in want) == 1000


def test_rows_of_a_hot_key_are_spread(spark):
    docs = spark.range(40_000).selectExpr("id as doc_id", f"'{LONG}' as text")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = (line_dedup.occurrences(docs).repartitionByRange(8, "h1", "h2", "doc_id")
                .rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert len(rows) == 8 and max(rows) < 10_000


def test_bitmaps_are_compressed(spark):
    filler = "\n".join(str(i) for i in range(1000))
    docs = [(i, f"{filler}\n{LONG}") for i in range(5)]
    maps = line_dedup.keep_bitmaps(frame(spark, docs).select("doc_id", "text")).collect()
    assert sorted(m.doc_id for m in maps) == [0, 1, 2, 3]
    for m in maps:
        (w,) = m.keep
        assert w.word == 1000 // 64 and w.bits == ~(1 << 1000 % 64) and m.n_dropped == 1


def test_all_columns_stay_and_empty_table(spark):
    docs = [(i, f"{LONG}\nown {i}") for i in range(6)] + [(7, None)]
    out = line_dedup.drop_lines(frame(spark, docs))
    assert out.columns == ["doc_id", "text", "keep", "n_dropped"]
    assert {(r.doc_id, r.text, r.keep, r.n_dropped) for r in out.collect()} == {
        *((i, f"own {i}", "x", 1) for i in range(5)), (5, f"{LONG}\nown 5", "x", 1), (7, None, "x", 1)}
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup(none).count() == line_dedup.drop_lines(none).count() == 0
