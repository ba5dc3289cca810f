"""License scan: exact set-similarity join of text blocks with templates.

Every text is cut into blocks of consecutive words, one block each ``STRIDE``
words, long enough that any passage of a template's length lies whole in the
block in whose first ``STRIDE`` words it starts. A block meets a template when
its word set holds at least ``threshold`` of the template's word set.

Words are ordered by their document frequency over the whole corpus, rarest
first. Prefix filter: a block that meets a template of n words with at least
``need`` of them shares one of the template's first ``n - need + 1`` words, so
only blocks with such a word are formed at all and joined with the templates
on it. Length filter: the block has at least ``need`` words of the template
vocabulary. Positional filter: what can still follow the shared word in both
orders reaches ``need``. Survivors are verified by intersecting the sets.
Only words of templates are ordered: no other word can be shared.

Templates are a parameter, so the word ranks and the template index are of a
size that does not depend on the input; the index is broadcast.

A phrase is a template with threshold 1 whose words must also stand
consecutively; its places are counted in the verified blocks.

Defined cases: null and empty texts have no words and no labels (score 0);
equal rows are scanned each for itself; an empty table gives no rows; only
``doc_id`` and ``text`` are read, columns of other names do not matter. Words
are lower-cased as a whole; beyond A-Z that changes only letters which no
phrase holds.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan.llm.common import WORD_ALNUM, words

STRIDE = 32

# fixed values: phrases of the contract and the labels they give
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: notice sentences of common public licenses
NOTICES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, "
                  "are permitted provided that the following conditions are met",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                      "this software and associated documentation files",
}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    threshold: float
    phrase: bool


def template_words(text: str) -> tuple[str, ...]:
    return tuple(re.findall(WORD_ALNUM, text.lower()))


def templates(phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
              threshold: float = 0.8) -> list[Template]:
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    return ([Template(v, template_words(k), 1.0, True) for k, v in phrases.items()]
            + [Template(k, template_words(v), threshold, False) for k, v in notices.items()])


def word_ranks(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by document frequency over all of ``docs``, rarest
    first. The result has one row per word of the templates."""
    vocab = F.array(*map(F.lit, vocabulary))
    counts = (docs.select(F.explode(F.array_intersect(words(F.lower("text")), vocab)).alias("w"))
              .groupBy("w").count())
    df = {r["w"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (df.get(w, 0), w))


def scan(docs: DataFrame, tpl: list[Template] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words``, the places of phrases
    (``n_base, first_word, last_word, base_labels``), the labels of all met
    templates (``labels``) and the greatest containment (``score``)."""
    tpl = templates() if tpl is None else tpl
    order = word_ranks(docs, sorted({w for t in tpl for w in t.words}))
    rank = {w: i for i, w in enumerate(order)}
    span = max(len(t.words) for t in tpl)
    index, prefix = [], set()
    for t in tpl:
        own = sorted({rank[w] for w in t.words})
        need = max(1, math.ceil(t.threshold * len(own) - 1e-9))
        for i, r in enumerate(own[:len(own) - need + 1]):
            prefix.add(r)
            index.append(F.struct(
                F.lit(r).alias("t_rank"), F.lit(t.label).alias("label"), F.lit(t.phrase).alias("phrase"),
                F.lit(i).alias("t_pos"), F.lit(need).alias("need"),
                F.array(*map(F.lit, own)).alias("t_set"),
                F.array(*map(F.lit, t.words)).alias("t_words")))
    spark = docs.sparkSession
    lookup = spark.range(1).select(F.inline(F.array(*index)))
    vocab = F.array(*map(F.lit, order))
    rare = F.array(*[F.lit(order[r]) for r in sorted(prefix)])
    rare_ranks = F.array(*map(F.lit, sorted(prefix)))

    base = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"),
                       words(F.lower("text")).alias("_w"))
    n = F.size("_w")
    blocks = F.when(F.arrays_overlap("_w", rare), F.filter(
        F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STRIDE).cast("int")),
                    lambda k: F.struct((k * STRIDE).alias("at"),
                                       F.slice("_w", k * STRIDE + 1, STRIDE + span - 1).alias("words"))),
        lambda b: F.arrays_overlap(b["words"], rare)))
    block = (base.select("doc_id", "_row", n.cast("long").alias("n_words"),
                         F.explode_outer(blocks).alias("_b"))
             .withColumn("_set", F.array_sort(F.transform(
                 F.array_intersect(F.col("_b.words"), vocab),
                 lambda w: (F.array_position(vocab, w) - 1).cast("int")))))
    # one row per rare word of a block; blocks and documents without stay, unmatched
    hits = block.select("doc_id", "_row", "n_words", "_b", "_set",
                        F.explode_outer(F.array_intersect("_set", rare_ranks)).alias("_rank"))
    pairs = hits.join(F.broadcast(lookup), F.col("_rank") == F.col("t_rank"), "left")
    b_pos = F.array_position("_set", F.col("_rank")) - 1
    left_over = 1 + F.least(F.size("t_set") - F.col("t_pos") - 1, F.size("_set") - b_pos - 1)
    candidate = ((F.size("_set") >= F.col("need")) & (left_over >= F.col("need"))
                 # a block meets a template once: by the first word they share
                 & (F.array_min(F.array_intersect("_set", "t_set")) == F.col("_rank")))
    shared = F.when(candidate, F.size(F.array_intersect("_set", "t_set")))
    met = pairs.withColumn("_shared", shared).withColumn("_met", F.col("_shared") >= F.col("need"))
    places = F.when(F.col("_met") & F.col("phrase"), F.transform(F.filter(
        F.sequence(F.lit(0), F.lit(STRIDE - 1)),
        lambda i: F.slice(F.col("_b.words"), i + 1, F.size("t_words")) == F.col("t_words")),
        lambda i: (i + F.col("_b.at")).cast("long")))
    found = (met.withColumn("_places", places)
             .withColumn("_hit", F.col("_met") & (~F.col("phrase") | (F.size("_places") > 0))))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("phrase") & F.col("_hit"), F.size("_places"))), F.lit(0))
        .cast("long").alias("n_base"),
        F.min(F.array_min("_places")).alias("first_word"),
        F.max(F.array_max("_places")).alias("last_word"),
        joined(F.when(F.col("phrase") & F.col("_hit"), F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("_hit"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("_hit"), F.col("_shared") / F.size("t_set"))), F.lit(0.0))
        .cast("double").alias("score")).drop("_row")
