"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed into factors: maximal runs of words that can be
copied from earlier text, where earlier means a smaller document id or an
earlier start in the same document. A factor of at least ``LENGTH`` words is
a duplicate span; its words are removed. Texts are judged on the input.

The reference is the whole corpus, cut into blocks of words at anchors
(``Anchors``), places that equal texts agree on. All blocks are indexed by the
fingerprint of their anchor:

1. Each part of the corpus sends one entry per distinct block, with its
   earliest place. Where all blocks of an anchor are equal, the earliest
   of them is the reference of all others.
2. Blocks of one anchor that differ lie at the ends of factors. There each
   ``LENGTH``-word window is looked up for itself, so a window that crosses
   the boundary of two factors is still found, and a factor ends exactly
   where its copy ends.
3. The parse walks over the windows that have a reference: a factor goes on
   while the next window's reference is the next place of the same document.

Words are compared by 64-bit fingerprints, windows by two independent ones. A
part sends one entry per distinct block or window, so a hot passage costs one
entry in each.

Defined cases: null text has no words; documents under ``LENGTH`` words keep
all; rows with equal id and start are not earlier than each other; a null id
is greater than all others; an empty table gives no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from relayplan.llm.blocks import (NULL_ID, Anchors, CodeGrams, block_stage, first_of, gram_codes, group_of, open_block, pack,
                                  pack_documents, tidy, unpack, word_bounds, word_codes)
from relayplan.llm.common import kept, scan_partitions

LENGTH = 20
GRAM = 4

ASK = "bucket int, block long, data binary"
ANSWER = "block long, kind int, bucket int, data binary"
RESULT = ("doc_id long, n_words long, n_removed long, "
          "factors array<struct<start:long,stop:long,ref_doc:long,ref_start:long>>, kept binary")

OWN, REFERENCE, OPEN = 0, 1, 2


class Parsed:
    """Words and reference blocks of a part of the corpus."""

    def __init__(self, data: bytes):
        self.ids, self.offsets, self.text = open_block(data)
        self.starts, self.ends, self.first = word_bounds(self.text, self.offsets)
        self.codes = word_codes(self.text, self.starts, self.ends)
        self.anchors = a = Anchors(CodeGrams(self.codes, LENGTH, GRAM), self.first)
        self.doc = self.ids[a.doc]
        self.place = a.lo - self.first[a.doc]
        self.by, self.begin = first_of(a.key, self.doc, self.place)
        self.group = group_of(self.begin, len(self.by))

    def entries(self):
        """Key, fingerprint (0: differing blocks) and earliest place of each anchor's blocks."""
        at = self.by[self.begin] if len(self.by) else self.by
        whole = self.anchors.whole[self.by]
        same = (np.minimum.reduceat(whole, self.begin) == np.maximum.reduceat(whole, self.begin)
                if len(at) else np.zeros(0, bool))
        return (self.anchors.key[at] >> np.uint64(16),
                np.where(same, (self.anchors.whole[at] >> np.uint64(16)) | np.uint64(1), np.uint64(0)),
                self.doc[at], self.place[at])

    def open_windows(self, status: np.ndarray):
        """Windows of blocks that differ: word, fingerprints, document and
        place, sorted, and where distinct ones begin."""
        a = self.anchors
        rows = self.by[(status == OPEN)[self.group]] if len(self.by) else self.by
        n = a.hi[rows] - a.lo[rows] + 1
        ends = np.cumsum(n)
        at = np.repeat(a.lo[rows], n) + np.arange(int(n.sum())) - np.repeat(ends - n, n)
        doc, place = np.repeat(self.doc[rows], n), at - np.repeat(self.first[a.doc[rows]], n)
        one = gram_codes(self.codes, LENGTH)[at]
        other = gram_codes(word_codes(self.text, self.starts, self.ends, 1), LENGTH)[at] if len(at) else one
        by = np.lexsort((place, doc, other, one))
        one, other = one[by], other[by]
        new = (np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (other[1:] != other[:-1]))))
               if len(at) else np.zeros(0, np.int64))
        return at[by], one, other, doc[by], place[by], new


def slices(key: np.ndarray, buckets: int, bits: int):
    """Slices of sorted keys by range, the same ranges for all senders."""
    edge = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** bits / buckets)).astype(np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(key, edge), [len(key)]))
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
        yield int(i), slice(int(cuts[i]), int(cuts[i + 1]))


def index(blocks, buckets: int):
    for block, data in blocks:
        cols = Parsed(data).entries()
        rows = [(i, block, pack(*[c[s] for c in cols])) for i, s in slices(cols[0], buckets, 48)]
        if rows:
            yield pd.DataFrame(rows, columns=["bucket", "block", "data"])


def gather(pdf: pd.DataFrame):
    pdf = pdf.sort_values("block")
    parts = [unpack(d) for d in pdf["data"]]
    return pdf, np.cumsum([len(p[0]) for p in parts])[:-1], [np.concatenate(c) for c in zip(*parts, strict=True)]


def answer(pdf, cuts, kind, *columns) -> pd.DataFrame:
    split = [np.split(c, cuts) for c in columns]
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "kind": kind, "bucket": pdf["bucket"].to_numpy(),
                         "data": [pack(*c) for c in zip(*split, strict=True)]})


def match_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """References of the blocks of a key range."""
    pdf, cuts, (key, whole, doc, place) = gather(pdf)
    by, begin = first_of(key, doc, place)
    group = group_of(begin, len(by))
    w, d, p = whole[by], doc[by], place[by]
    same = (np.minimum.reduceat(w, begin) == np.maximum.reduceat(w, begin)) & (w[begin] != 0)
    first_doc, first_place = d[begin][group], p[begin][group]
    mine = (d == first_doc) & (p == first_place)
    state = np.where(same[group], np.where(mine, OWN, REFERENCE), OPEN).astype(np.uint8)
    status, ref_doc, ref_place = np.empty(len(by), np.uint8), np.zeros(len(by), np.int64), np.zeros(len(by), np.int64)
    status[by] = state
    ref_doc[by] = np.where(state == REFERENCE, first_doc, 0)
    ref_place[by] = np.where(state == REFERENCE, first_place, 0)
    return answer(pdf, cuts, 0, status, ref_doc, ref_place)


def window_batch(buckets: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for block, data in zip(left["block"], left["data"], strict=True):
            _, one, other, doc, place, new = Parsed(data).open_windows(answers(right, 0)[0])
            cols = [c[new] for c in (one, other, doc, place)]
            rows += [(i, block, pack(*[c[s] for c in cols])) for i, s in slices(cols[0], buckets, 64)]
        tidy()
        return pd.DataFrame(rows, columns=["bucket", "block", "data"])
    return run


def match_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Earliest places of the windows of a key range."""
    pdf, cuts, (one, other, doc, place) = gather(pdf)
    by = np.lexsort((place, doc, other, one))
    a, b = one[by], other[by]
    begin = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    group = group_of(begin, len(by))
    ref_doc, ref_place = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    ref_doc[by], ref_place[by] = doc[by][begin][group], place[by][begin][group]
    return answer(pdf, cuts, 1, ref_doc, ref_place)


def answers(pdf: pd.DataFrame, kind: int) -> list[np.ndarray]:
    own = pdf[pdf["kind"] == kind].sort_values("bucket")["data"]
    parts = [unpack(d) for d in own]
    if not parts:
        return [np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)][:3 if kind == 0 else 2]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def references(p: Parsed, right: pd.DataFrame):
    """Windows that have an earlier copy, in order: word, document number,
    place, and document id and place of the copy."""
    a = p.anchors
    status, ref_doc, ref_place = answers(right, 0)
    if not len(p.by):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    own = p.by[p.begin]
    ref_doc = np.where(status == OWN, p.doc[own], ref_doc)[p.group]
    ref_place = np.where(status == OWN, p.place[own], ref_place)[p.group]
    state = status[p.group]
    earlier = (ref_doc < p.doc[p.by]) | ((ref_doc == p.doc[p.by]) & (ref_place < p.place[p.by]))
    pick = (state != OPEN) & earlier
    rows = p.by[pick]
    n = a.hi[rows] - a.lo[rows] + 1
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = [np.repeat(a.lo[rows], n) + step]
    src_doc, src_place = [np.repeat(ref_doc[pick], n)], [np.repeat(ref_place[pick], n) + step]
    w, _, _, doc, place, new = p.open_windows(status)
    if len(w):
        group = group_of(new, len(w))
        d, q = (c[group] for c in answers(right, 1))
        late = (d < doc) | ((d == doc) & (q < place))
        at.append(w[late])
        src_doc.append(d[late])
        src_place.append(q[late])
    at, src_doc, src_place = (np.concatenate(x) for x in (at, src_doc, src_place))
    by = np.argsort(at, kind="stable")
    at = at[by]
    doc = np.searchsorted(p.first, at, "right") - 1
    return at, doc, at - p.first[doc], src_doc[by], src_place[by]


def parse(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Factors and kept words of a part's documents."""
    out = []
    for data in left["data"]:
        p = Parsed(data)
        at, doc, place, src_doc, src_place = references(p, right)
        cover = np.zeros(len(p.codes) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + LENGTH, -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        breaks = (np.flatnonzero(np.concatenate((
            [True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (src_doc[1:] != src_doc[:-1])
            | (src_place[1:] != src_place[:-1] + 1)))) if len(at) else np.zeros(0, np.int64))
        last = np.append(breaks[1:], len(at))[:len(breaks)] - 1
        factors: dict[int, list] = {}
        for b, e in zip(breaks.tolist(), last.tolist(), strict=True):
            factors.setdefault(int(doc[b]), []).append({
                "start": int(place[b]), "stop": int(place[e]) + LENGTH, "ref_start": int(src_place[b]),
                "ref_doc": None if src_doc[b] == NULL_ID else int(src_doc[b])})
        # the byte after a kept word that another kept word of the document follows is its blank
        stay = np.flatnonzero(~gone)
        owner = np.searchsorted(p.first, stay, "right") - 1
        more = np.concatenate((owner[1:] == owner[:-1], [False])) if len(stay) else np.zeros(0, bool)
        text, mark = p.text.copy(), np.zeros(len(p.text) + 1, np.int8)
        mark[p.starts[stay]] += 1
        mark[p.ends[stay] + more] -= 1
        text[p.ends[stay[more]]] = 32
        mark = np.cumsum(mark[:-1], dtype=np.int8).view(bool)
        for i, (s, e) in enumerate(zip(p.offsets[:-1], p.offsets[1:], strict=True)):
            words = slice(p.first[i], p.first[i + 1])
            out.append((None if p.ids[i] == NULL_ID else int(p.ids[i]), int(p.first[i + 1] - p.first[i]),
                        int(gone[words].sum()), factors.get(i, []), text[s:e][mark[s:e]].tobytes()))
    got = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "factors", "kept"])
    got["doc_id"] = got["doc_id"].astype("Int64")
    tidy()
    return got


def dedup(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed``, its ``factors`` (places in
    words, stop exclusive, and where the copy starts) and the ``kept`` words
    joined by blanks."""
    buckets = 4 * scan_partitions(docs)
    blocks = pack_documents(docs)
    matched = kept(block_stage(docs, lambda b: index(b, buckets), ASK)
                   .groupBy("bucket").applyInPandas(match_blocks, ANSWER))
    windows = (blocks.groupBy("block").cogroup(matched.groupBy("block"))
               .applyInPandas(window_batch(buckets), ASK)
               .groupBy("bucket").applyInPandas(match_windows, ANSWER))
    both = matched.unionByName(windows)
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(parse, RESULT)
