"""Spelling variant grouping by a dictionary of trie-node pairs.

Words are near if they differ by exactly one inserted, deleted or replaced code
point. Each word is cut at every place; the part before is a node of the trie of
all words, the part behind a node of the trie of all reversed words.

1. Nodes are numbered. The words are partitioned by ranges and sorted, so that
   a word shares its known nodes with the word before it and adds the rest. A
   node that occurs in two ranges is a prefix of the first word of a range;
   nodes of these few words (one a range) are numbered once, for all tasks, all
   other nodes by the task that holds their range.
2. A word gives an integer pair (prefix node, suffix node) for each place with
   its code point skipped, and one for each place where a code point could be
   inserted. Replacements are words that meet in a skipped pair; a deletion is a
   skipped pair that meets an inserted one. Node numbers are exact, so what
   meets is near; no strings are compared.
3. A pair is held by as many words as there are letters at most (90 of these),
   and by one word with an insertion. Within it each word counts its
   partners and picks the most frequent. If a code point stands several times in
   a row, skipping any of them gives the same word: the first one counts.

A word's form is its near word of largest count if that is at least ``RATIO``
times its own. Counts at least double along forms, so the chain to the root is
short, and pointers are doubled until none moves.

Before counting, a run of letters loses one code point where ``MODULUS``
divides the CRC of its document and itself (a rule of the contract; see
``altered``).

Defined cases: null and empty texts have no words; a null id is written as
nothing in front of the colon; every row counts, equal rows too; runs of any
length; ties go to the word that is smaller in code points; an empty table gives
no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayplan.llm.common import ascii_lower, kept

# fixed values of the contract
LETTERS = r"[A-Za-zÀ-ÿ]+"
MODULUS = 97
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2

#: Bits for numbers within a range.
RANGE_BITS = 36

NODES = "word string, n long, wid long, nodes array<long>, starts array<boolean>"


def altered(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the rule asks for it."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % MODULUS == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words that are long and frequent enough, with their counts."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(LETTERS), F.lit(0))).alias("run"))
    return (runs.select(altered(F.col("doc_id"), F.col("run")).alias("word"))
            .filter(F.length("word") >= MIN_CHARS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT))


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def border_nodes(heads: list[str]) -> list[np.ndarray]:
    """Numbers below zero for the nodes of the first words of all ranges."""
    out, last, free = [], "", 1
    for word in heads:
        same = common_prefix(last, word) + 1 if out else 0
        new = len(word) + 1 - same
        own = out[-1][:same] if out else np.zeros(0, np.int64)
        out.append(np.concatenate((own, -np.arange(free, free + new, dtype=np.int64))))
        free, last = free + new, word
    return out


def numbered(spell: Iterator[str], heads: list[str], border: list[np.ndarray]):
    """Number of each word of a range, in order, and the nodes of its prefixes."""
    last, nodes, k, count, free = "", None, 0, 0, 0
    for word in spell:
        if nodes is None:
            k = bisect_right(heads, word) - 1
            if k < 0 or heads[k] != word:
                raise RuntimeError("a range must be read from its first word")
            free = k << RANGE_BITS
            nodes = border[k]
        else:
            same = common_prefix(last, word)
            known = [nodes[:same + 1]]
            have = same + 1
            for j in (k, k + 1):
                if j < len(heads) and have <= len(word):
                    deep = common_prefix(heads[j], word) + 1
                    if deep > have:
                        known.append(border[j][have:deep])
                        have = deep
            new = len(word) + 1 - have
            known.append(np.arange(free, free + new, dtype=np.int64))
            nodes, free = np.concatenate(known), free + new
        yield (k << RANGE_BITS) + count, nodes
        last, count = word, count + 1


def trie(vocab: DataFrame, backward: bool) -> DataFrame:
    """The words with the nodes of all their prefixes, shortest first, in the
    trie of the words or of the reversed words. ``wid`` orders words like their
    code points (forward); ``starts`` tells where a code point differs from the
    one before it."""
    spell = F.reverse("word") if backward else F.col("word")
    ranged = kept(vocab.select("word", "n", spell.alias("spell"))
                  .repartitionByRange("spell").sortWithinPartitions("spell"))
    # one word a range
    heads = sorted(r.head for r in ranged.groupBy(F.spark_partition_id().alias("part"))
                   .agg(F.min("spell").alias("head")).collect())
    border = border_nodes(heads)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here: list[pd.DataFrame] = []

        def spelled():
            for b in batches:
                if not len(b):
                    continue
                here.append(b)
                yield from b["spell"]

        rows = []
        for wid, nodes in numbered(spelled(), heads, border):
            rows.append((wid, nodes))
            b = here[0]
            if len(rows) == len(b):
                starts = [[i == 0 or c != w[i - 1] for i, c in enumerate(w)] for w in b["spell"]]
                yield pd.DataFrame({"word": b["word"], "n": b["n"], "wid": [r[0] for r in rows],
                                    "nodes": [r[1] for r in rows], "starts": starts})
                rows = []
                here.pop(0)

    return ranged.mapInPandas(run, NODES)


def pairs(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """The dictionary from both tries: (prefix node, suffix node) with the
    words that have it by skipping a code point (``skip``) or by inserting one."""
    both = forward.join(backward.select("word", F.reverse("nodes").alias("rest")), "word")
    size = F.size("nodes")
    # place i: the prefix of length i, what follows, what follows the next code point
    places = F.arrays_zip(
        F.col("nodes").alias("before"), F.col("rest").alias("here"),
        F.concat(F.slice("rest", F.lit(2), size), F.array(F.lit(None).cast("long"))).alias("next"),
        F.concat("starts", F.array(F.lit(None).cast("boolean"))).alias("first"))
    each = both.select("wid", "n", F.explode(places).alias("x"))
    two = F.array(
        F.struct(F.lit(False).alias("skip"), F.col("x.here").alias("after"), F.lit(False).alias("first")),
        F.struct(F.lit(True).alias("skip"), F.col("x.next").alias("after"), F.coalesce("x.first", F.lit(False)).alias("first")))
    return (each.select("wid", "n", F.col("x.before").alias("before"), F.explode(two).alias("y"))
            .select("before", F.col("y.after").alias("after"), F.col("y.skip").alias("skip"),
                    F.col("y.first").alias("first"), "n", "wid").filter(F.col("after").isNotNull()))


def partners(dictionary: DataFrame) -> DataFrame:
    """Per word: number of near words, the best of them and its count."""
    # bounded: a word for each letter, and one
    held = (dictionary.groupBy("before", "after")
            .agg(F.collect_list(F.struct("skip", "first", "n", "wid")).alias("held"))
            .filter(F.size("held") > 1))
    each = held.select(F.explode("held").alias("u"), "held")
    near = F.transform(
        F.filter("held", lambda x: F.when(F.col("u.skip"), F.when(x["skip"], x["wid"] != F.col("u.wid")).otherwise(
            F.col("u.first"))).otherwise(x["skip"] & x["first"])),
        lambda x: F.struct(x["n"].alias("n"), (-x["wid"]).alias("order")))
    found = each.select(F.col("u.wid").alias("wid"), near.alias("near")).filter(F.size("near") > 0)
    return (found.select("wid", F.size("near").cast("long").alias("k"), F.array_max("near").alias("best"))
            .groupBy("wid").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))
            .select("wid", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.order")).alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``wid, form`` to ``wid, root``: where following the forms ends."""
    now = kept(forms.select("wid", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        moved = kept(now.join(step, "root", "left").select("wid", F.coalesce("further", "root").alias("root"), "further"))
        if moved.filter(F.col("further").isNotNull()).isEmpty():
            return moved.select("wid", "root")
        now = moved.select("wid", "root")


def group(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word that counts."""
    vocab = kept(vocabulary(docs.select("doc_id", "text")))
    forward = kept(trie(vocab, False))
    near = kept(partners(pairs(forward, trie(vocab, True))))
    words = forward.select("word", "n", "wid")
    forms = kept(words.join(near, "wid").filter(F.col("best_n") >= RATIO * F.col("n"))
                 .select("wid", F.col("best").alias("form"), F.col("best_n").alias("form_n")))
    name = lambda key: words.select(F.col("wid").alias(key), F.col("word").alias(f"{key}_word"))
    found = forms.join(roots(forms), "wid").join(name("form"), "form").join(name("root"), "root")
    return (words.join(near.select("wid", "n_near"), "wid", "left")
            .join(found.select("wid", "form_n", "form_word", "root_word"), "wid", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
                    "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))
