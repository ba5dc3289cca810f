"""PII: information-theoretic sanitisation.

Protected entities are the personal data found by pattern: e-mail addresses,
IP addresses, card numbers and phone numbers. A term near an entity reveals it
if seeing the term says much about the entity. With document frequencies over
the whole corpus, the information of an entity is ``IC(e) = -log2 p(e)`` and
what a term tells of it ``PMI(e, t) = log2(p(e, t) / (p(e) p(t)))``. Terms with
``PMI >= DISCLOSURE * IC(e)`` that stand within ``NEAR`` words of the entity in
at least ``SUPPORT`` different texts are spans of kind ``term``. Entities are
generalised to their kind, terms are removed.

The patterns are read as: leftmost, non-overlapping matches of each kind; a
match that fails its check (IP parts, Luhn, digits) is dropped and nothing is
searched again inside it. Repetitions are written possessively where that
finds the same matches, so that matching needs no deep stack on long runs.

Words near entities are few, so pairs are counted from the entities' rows;
only terms that can still disclose something are counted over all words of all
texts.

Defined cases: null and empty texts hold nothing; every row is a document of
its own, equal rows too, and equal texts count once for support; an empty
table gives no rows; ``sanitise`` keeps all columns, of any name, replaces
``text`` and, if present, ``n_chars``; a null text stays null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayplan.llm.common import WORD_ALNUM, aside, kept, words
from relayplan.session import scratch_path

# fixed values: kinds in the order of the contract
KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)
NAMES = (*KINDS, "term")
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# the runs of digits with single separators that have 14 to 19 digits
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

NEAR = 5
REACH = 80  # code points on either side in which the near words are looked for
SUPPORT = 3
DISCLOSURE = 0.75


#: Items whose results are appended one by one before they join the others.
CHUNK = 256
#: Code points of a block of a text.
BLOCK = 1024
#: Stands for the code points of spans, which are all ASCII.
MASK = "\ue000"
MATCH = "array<struct<start:int,stop:int,value:string>>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded(items: Column, step, kind: str) -> Column:
    """What ``step`` collects going through ``items``: it takes a state of ``at``
    (an int, 0 at first) and ``out`` (an array of ``kind``) and an item, and returns
    the next state. Appending copies an array, so items are taken in chunks."""
    none = lambda: F.array().cast(kind)

    def chunk(done: Column, part: Column) -> Column:
        start = F.struct(done["at"].alias("at"), none().alias("out"))
        return bound(F.aggregate(part, start, step), lambda r: F.struct(
            r["at"].alias("at"), F.concat(done["out"], F.array(r["out"])).alias("out")))

    def run(it: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(it) / CHUNK).cast("int")),
                            lambda c: F.slice(it, c * CHUNK + 1, F.lit(CHUNK)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(parts, start, chunk, lambda d: F.flatten(d["out"]))

    return bound(items, run)


def text_blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` of a text in blocks; only the blocks
    that they lie in are read."""
    first = F.floor(start / BLOCK).cast("int")
    some = F.slice(blocks, first + 1, F.greatest(F.ceil(stop / BLOCK).cast("int") - first, F.lit(0)))
    return F.substring(F.array_join(some, ""), start - first * BLOCK + 1, F.greatest(stop - start, F.lit(0)))


def matches(text: Column, pattern: str) -> Column:
    """Matches with their places in code points, stop exclusive."""
    parts = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # the pieces between matches and the matches add up to the places
    both = bound(hits, lambda h: F.arrays_zip(h.alias("m"), F.slice(parts, F.lit(1), F.size(h)).alias("p")))

    def step(done: Column, x: Column) -> Column:
        start, stop = done["at"] + x["p"], done["at"] + x["p"] + F.length(x["m"])
        return F.struct(stop.alias("at"), F.concat(done["out"], F.array(F.struct(
            start.alias("start"), stop.alias("stop"), x["m"].alias("value")))).alias("out"))

    return folded(both, step, MATCH)


def rewritten(blocks: Column, spans: Column, mark) -> Column:
    """The text with ``mark(span, begin)`` for each span. Spans of different
    kinds may overlap: what lies in an earlier one is skipped; ``begin`` is where
    a span's own part begins."""
    def step(done: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], done["at"])
        piece = F.struct(part_of(blocks, done["at"], begin).alias("text"), mark(s, begin).alias("mark"),
                         s["stop"].alias("stop"))
        return F.when(s["stop"] <= done["at"], done).otherwise(F.struct(
            s["stop"].alias("at"), F.concat(done["out"], F.array(piece)).alias("out")))

    pieces = folded(spans, step, "array<struct<text:string,mark:string,stop:int>>")
    return bound(pieces, lambda p: F.concat(
        F.array_join(F.transform(p, lambda x: F.concat(x["text"], x["mark"])), ""),
        part_of(blocks, F.coalesce(F.get(F.slice(p, -1, 1), F.lit(0))["stop"], F.lit(0)), F.size(blocks) * BLOCK)))


def replaced(text: Column, spans: Column) -> Column:
    """The text with its spans generalised or removed."""
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit(""))
    return bound(text_blocks(text), lambda b: rewritten(b, spans, lambda s, _: F.get(marks, s["kind"])))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Luhn's check over the digits of a card number."""
    d = digits(value)
    doubled = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 1, F.substring(d, -i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substring(d, -i, F.lit(1)).cast("int") + 1)))
    return doubled % 10 == 0


def entities(text: Column) -> Column:
    """All personal data of a text: start, kind, stop, value; sorted."""
    t = F.coalesce(text, F.lit(""))
    found = {
        "email": F.when(F.contains(t, F.lit("@")), matches(t, EMAIL)),
        "ip": F.filter(matches(t, IP), lambda m: F.forall(
            F.split(m["value"], r"\."), lambda x: F.regexp_replace(x, "^0+", "").rlike(
                "^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))),
        "card": F.filter(matches(t, CARD), lambda m: luhn(m["value"])),
        "phone": F.when(F.contains(t, F.lit("+")), F.filter(
            matches(t, PHONE), lambda m: F.length(digits(m["value"])).between(10, 15))),
    }
    kind = "array<struct<start:int,kind:int,stop:int,value:string>>"

    def tagged(i: int, name: str) -> Column:
        return F.transform(F.coalesce(found[name], F.array()), lambda m: F.struct(
            m["start"].alias("start"), F.lit(i).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value")))

    return F.array_sort(F.concat(*[tagged(i, n).cast(kind) for i, n in enumerate(KINDS)]))


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` of sorted spans, comma-joined."""
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def near_terms(found: DataFrame) -> DataFrame:
    """Words near entities that do not touch an entity: row, entity, place."""
    one = found.select("_row", "_digest", F.explode("_near").alias("e"))

    def placed(context: Column, masked: Column, at: Column, last: bool) -> Column:
        # whole words only: none that touches the entity, or the end of the reach in mid-text
        cut = F.length(context) >= REACH
        hits = F.filter(matches(F.lower(context), WORD_ALNUM), lambda m: (
            (m["stop"] < F.length(context)) & ~(cut & (m["start"] == 0)) if last else
            (m["start"] > 0) & ~(cut & (m["stop"] == F.length(context)))))
        size = F.size(hits)
        some = F.slice(hits, F.greatest(size - (NEAR - 1), F.lit(1)), NEAR) if last else F.slice(hits, 1, NEAR)
        # a word that reaches into another entity is not the same where these are masked
        free = F.filter(some, lambda m: (F.length(m["value"]) >= 2) & (
            F.substring(F.lower(masked), m["start"] + 1, m["stop"] - m["start"]) == m["value"]))
        return F.transform(free, lambda m: F.struct(
            (at + m["start"]).alias("start"), (at + m["stop"]).alias("stop"), m["value"].alias("term")))

    terms = F.concat(placed(F.col("e.before"), F.col("e.masked_before"), F.col("e.start") - F.length("e.before"), True),
                     placed(F.col("e.after"), F.col("e.masked_after"), F.col("e.stop"), False))
    return one.select("_row", "_digest", "e.value", F.explode(terms).alias("t")).select(
        "_row", "_digest", "value", F.col("t.start").alias("start"), F.col("t.stop").alias("stop"),
        F.col("t.term").alias("term"))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row (``_row``) and its entities (``_spans``),
    written once to the shared folder. Numbers depend on the order in which
    rows are read, so nothing may read ``docs`` again."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sanitise")
    (docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_spans", entities(F.col("text")))
     .write.parquet(path))
    return spark.read.parquet(path)


def find(rows: DataFrame) -> DataFrame:
    """The entities of each numbered row with the text on both sides."""
    def near(spans: Column, blocks: Column, masked: Column) -> Column:
        def around(s: Column, of: Column, *names: str):
            return (part_of(of, F.greatest(s["start"] - REACH, F.lit(0)), s["start"]).alias(names[0]),
                    part_of(of, s["stop"], s["stop"] + REACH).alias(names[1]))

        return F.transform(spans, lambda s: F.struct(
            s["value"].alias("value"), s["start"].alias("start"), s["stop"].alias("stop"),
            *around(s, blocks, "before", "after"), *around(s, masked, "masked_before", "masked_after")))

    spans = F.col("_spans")
    cover = lambda s, begin: F.repeat(F.lit(MASK), s["stop"] - begin)
    both = bound(text_blocks(F.col("text")), lambda b: bound(
        text_blocks(rewritten(b, spans, cover)), lambda m: near(spans, b, m)))
    return kept(rows.select("doc_id", "_row", "_spans",
                            F.when(F.size("_spans") > 0, F.xxhash64("text")).alias("_digest"),
                            F.when(F.size("_spans") > 0, both).alias("_near")))


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Spans of revealing terms: row, start, stop."""
    terms = kept(near_terms(found))
    entity = (found.select("_row", F.explode(F.array_distinct(F.transform("_near", lambda e: e["value"])))
                           .alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n_e")))
    # one row per text first, so that a hot pair meets as counts
    pair = (terms.groupBy("value", "term", "_digest").agg(F.countDistinct("_row").alias("n"))
            .groupBy("value", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("support"))
            .filter(F.col("support") >= SUPPORT))
    # A pair discloses if n_t <= n_et * (N / n_e) ** (1 - DISCLOSURE). The documents that have
    # the term near any entity are some of those that have it, so common words drop out here.
    n_all = F.lit(float(found.count()))
    most = F.col("n_et") * F.pow(n_all / F.col("n_e"), F.lit(1 - DISCLOSURE))
    near = terms.select("term", "_row").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_near"))
    pair = kept(pair.join(entity, "value").join(near, "term").filter(F.col("n_near") <= most * (1 + 1e-9)))
    term = pair.select("term").distinct()
    # counted first and joined then: common words meet as counts
    frequency = (docs.select(F.explode(F.array_distinct(words(F.lower("text")))).alias("term"))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(term, "term"))
    pmi = F.log2(n_all * F.col("n_et") / F.col("n_e") / F.col("n_t"))
    content = F.log2(n_all / F.col("n_e"))
    flagged = pair.join(frequency, "term").filter(
        (content > 0) & (pmi >= DISCLOSURE * content - 1e-9)).select("value", "term")
    return terms.join(flagged, ["value", "term"]).select("_row", "start", "stop").distinct()


def with_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the spans of terms added: ``_spans`` (base), ``_all``."""
    term = (disclosing(docs, found).groupBy("_row").agg(F.collect_set(F.struct(
        "start", F.lit(TERM).alias("kind"), "stop", F.lit(None).cast("string").alias("value"))).alias("_terms")))
    kind = "array<struct<start:int,kind:int,stop:int,value:string>>"
    return found.join(term, "_row", "left").withColumn("_all", F.array_sort(F.concat(
        "_spans", F.coalesce(F.col("_terms").cast(kind), F.array().cast(kind)))))


def scan(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, its ``base`` spans (sorted array) and all
    ``spans`` with those of revealing terms."""
    rows = numbered(docs.select("doc_id", "text"))
    full = with_terms(rows, find(rows))
    return full.select("doc_id", F.col("_spans").alias("base"), F.col("_all").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities generalised to ``<EMAIL>``, ``<IP>``, ``<CARD>``
    or ``<PHONE>`` and revealing terms removed."""
    docs, back = aside(docs, "doc_id", "text", "n_chars")
    rows = numbered(docs)
    changed = (with_terms(rows, find(rows)).filter(F.size("_all") > 0)
               .select(F.col("_row").alias("_r"), "_all"))
    out = rows.join(changed, F.col("_row") == F.col("_r"), "left").withColumn(
        "_new", F.when(F.col("_all").isNull(), F.col("text")).otherwise(replaced(F.col("text"), F.col("_all"))))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("_new").alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("_all").isNull(), F.col(c)).otherwise(
                F.length("_new").cast(docs.schema[c].dataType)).alias(c))
        else:
            cols.append(F.col(c))
    return back(out.select(*cols))


def information(n_all: int, n_e: int) -> float:
    """IC of an entity of ``n_e`` among ``n_all`` documents, in bits."""
    return math.log2(n_all / n_e)
