"""Suffix-array dedup by a distributed, common-prefix-aware merge sort.

A byte is removed if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller id. Strings are judged on the input.

The suffixes, cut to ``LENGTH`` bytes, would be sorted over all documents; equal
neighbours in that order are the repeated strings. Three steps keep the
exchange small, none drops a repeated string:

1. Duplicate detection. Each block gathers its suffixes by anchor (``Anchors``)
   and sends the anchors' fingerprints. A suffix whose anchor occurs nowhere
   else is unique and needs no sorting. Where all copies of an anchor, in all
   blocks, stand in the same bytes, its suffixes are equal throughout and the
   smallest id settles them at once. At the edges of copies the surroundings
   differ; only those anchors are sorted.
2. Each block sorts the suffixes that begin at its open anchors into one run,
   front-coded: a suffix is stored without the prefix it shares with the one
   before it. The bytes left of the anchor go along. Runs are cut by anchor and
   exchanged.
3. Each receiver merges its runs with a loser tree. Every waiting suffix carries
   the length of its common prefix with the last winner; suffixes whose lengths
   differ are ordered by these alone, equal lengths compare from that place on.
   The winner's common prefix with its predecessor comes out with it. The string
   that starts ``o`` bytes left of an anchor is the same for neighbours that
   have ``LENGTH - o`` bytes in common to the right and ``o`` to the left.
   Answers go back to the blocks as one bit per such string.

An anchor that stands in more than ``HOT`` different surroundings is not
gathered in one place: its strings are exchanged one by one, by fingerprint,
one entry per distinct string and block.

Defined cases: null text is empty; texts shorter than ``LENGTH`` bytes keep all
bytes; rows with the same id do not count against each other; a null id is
greater than all others; an empty table gives no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from relayplan.llm.blocks import (NULL_ID, Anchors, ByteGrams, block_stage, combine, first_of, group_of,
                                  mix, open_block, pack, pack_documents, runs, tidy, unpack)
from relayplan.llm.common import kept, scan_partitions

LENGTH = 50
GRAM = 20
HOT = 4096
#: An anchor lies at most so many bytes right of the start of its strings.
REACH = LENGTH - GRAM

ASK = "bucket int, block long, data binary"
ANSWER = "block long, kind int, bucket int, data binary"
RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"

SETTLED_FIRST, SETTLED_COPY, OPEN, SPREAD = 0, 1, 2, 3
#: Kinds of exchange: anchors, sorted runs, single strings.
ANCHOR, RUN, STRING = 0, 1, 2


def front_code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted byte rows to common-prefix lengths and the bytes beyond them."""
    lcp = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return lcp, rows[np.arange(rows.shape[1])[None, :] >= lcp[:, None]]


def front_decode(lcp: np.ndarray, tails: np.ndarray, length: int) -> np.ndarray:
    rows = np.zeros((len(lcp), length), np.uint8)
    own = np.arange(length)[None, :] >= lcp[:, None]
    rows[own] = tails
    # a shared byte comes from the last row above that stored its own
    last = np.maximum.accumulate(np.where(own, np.arange(len(lcp))[:, None], 0), axis=0)
    return np.take_along_axis(rows, last, axis=0)


def merge_runs(strings: list[list[bytes]], lcps: list[list[int]], length: int):
    """Loser tree over sorted runs. Returns run, place in the run and common
    prefix with the string before, for all strings in sorted order. ``lcps``
    are the runs' own common-prefix lengths."""
    k = 1
    while k < len(strings):
        k *= 2
    n_runs = len(strings)
    head = [s[0] if s else None for s in strings] + [None] * (k - n_runs)
    known = [0] * k  # common prefix with the last string that came out
    place = [0] * k
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = known[a], known[b]
        if p > q:
            return a, b
        if q > p:
            return b, a
        s, t = x[p:], y[p:]
        if s == t:
            known[b] = length
            return a, b
        w = len(s)
        same = p + w - 1 - ((int.from_bytes(s, "big") ^ int.from_bytes(t, "big")).bit_length() - 1) // 8
        if s < t:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        win, lose = play(build(2 * node), build(2 * node + 1))
        loser[node] = lose
        return win

    winner = build(1) if k > 1 else 0
    out_run, out_place, out_lcp = [], [], []
    while head[winner] is not None:
        at = place[winner]
        out_run.append(winner)
        out_place.append(at)
        out_lcp.append(known[winner])
        at += 1
        place[winner] = at
        run = strings[winner]
        if at < len(run):
            head[winner] = run[at]
            known[winner] = lcps[winner][at]
        else:
            head[winner] = None
        node = (winner + k) >> 1
        while node:
            other = loser[node]
            if head[winner] is not None and head[other] is not None and known[winner] != known[other]:
                if known[other] > known[winner]:
                    loser[node], winner = winner, other
            else:
                winner, loser[node] = play(winner, other)
            node >>= 1
    return out_run, out_place, out_lcp


def sections(key: np.ndarray, buckets: int, bits: int):
    """Number and slice of each range of sorted keys, the same ranges for all
    senders."""
    edge = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** bits / buckets)).astype(np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(key, edge), [len(key)]))
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
        yield int(i), slice(int(cuts[i]), int(cuts[i + 1]))


def bucket_of(key: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    edge = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** bits / buckets)).astype(np.uint64)
    return np.searchsorted(edge, key, "right")


class Judged:
    """A block's documents and anchors, grouped by anchor key."""

    def __init__(self, data: bytes):
        self.ids, self.offsets, self.text = open_block(data)
        self.anchors = a = Anchors(ByteGrams(self.text, LENGTH, GRAM), self.offsets)
        self.doc = self.ids[a.doc]
        # an anchor is the least of its neighbours: mixed, keys spread evenly over key ranges again
        self.key = mix(a.key)
        self.by = np.lexsort((self.doc, a.whole, self.key))
        key, whole = self.key[self.by], a.whole[self.by]
        first = np.ones(min(len(key), 1), bool)
        new_key = np.concatenate((first, key[1:] != key[:-1]))
        self.starts = np.flatnonzero(new_key)
        #: first row of each distinct surrounding of an anchor: its smallest id
        self.distinct = np.flatnonzero(new_key | np.concatenate((first, whole[1:] != whole[:-1])))
        self.group = group_of(self.starts, len(key))

    def entries(self):
        """Key, covered bytes, smallest id and number of surroundings of each group."""
        a, at = self.anchors, self.by[self.starts]
        n = np.diff(np.append(np.searchsorted(self.distinct, self.starts), len(self.distinct)))
        smallest = np.minimum.reduceat(self.doc[self.by], self.starts) if len(at) else self.doc[:0]
        return (self.key[at] >> np.uint64(16), a.whole[at] >> np.uint64(16), smallest, n.astype(np.uint32))

    def open_runs(self, status: np.ndarray, buckets: int):
        """The distinct surroundings of open anchors, sorted by receiver and by
        the suffix from the anchor on: rows, receivers, suffixes, left bytes
        (nearest first), first and last offset, smallest id."""
        a = self.anchors
        rows = self.distinct[status[self.group[self.distinct]] == OPEN] if len(self.by) else self.distinct
        own = self.by[rows]
        at = a.at[own][:, None]
        padded = np.concatenate((np.zeros(LENGTH, np.uint8), self.text, np.zeros(LENGTH, np.uint8)))
        place = at + np.arange(LENGTH)
        suffix = np.where(place < a.hi[own][:, None] + LENGTH, padded[place + LENGTH], 0).astype(np.uint8)
        place = at - 1 - np.arange(REACH)
        left = np.where(place >= a.lo[own][:, None], padded[place + LENGTH], 0).astype(np.uint8)
        least, most = (at[:, 0] - a.hi[own]).clip(0), at[:, 0] - a.lo[own]
        wide = np.zeros((len(own), -(-LENGTH // 8) * 8), np.uint8)
        wide[:, :LENGTH] = suffix
        to = bucket_of(self.key[own] >> np.uint64(16), buckets, 48)
        by = np.lexsort((rows, *wide.view(">u8").astype(np.uint64).T[::-1], to))
        return (rows[by], to[by], suffix[by], left[by], least[by].astype(np.uint8), most[by].astype(np.uint8),
                self.doc[own[by]])

    def strings(self, status: np.ndarray):
        """Strings of anchors in many surroundings: place, id, fingerprints,
        sorted by these and id, and where distinct ones begin."""
        a = self.anchors
        rows = self.by[(status == SPREAD)[self.group]] if len(self.by) else self.by
        n = a.hi[rows] - a.lo[rows] + 1
        at = np.repeat(a.lo[rows], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        doc = np.repeat(self.doc[rows], n)
        one = a.items.wide(at)
        other = a.items.wide(at, 1)
        by = np.lexsort((doc, other, one))
        one, other = one[by], other[by]
        first = np.ones(min(len(by), 1), bool)
        new = np.flatnonzero(np.concatenate((first, (one[1:] != one[:-1]) | (other[1:] != other[:-1]))))
        return at[by], doc[by], one, other, new


def ask(blocks, buckets: int):
    for block, data in blocks:
        cols = Judged(data).entries()
        rows = [(i, block, pack(*[c[s] for c in cols])) for i, s in sections(cols[0], buckets, 48)]
        del cols
        if rows:
            yield pd.DataFrame(rows, columns=["bucket", "block", "data"])
        del rows
        tidy()


def gather(pdf: pd.DataFrame):
    pdf = pdf.sort_values("block")
    parts = [unpack(d) for d in pdf["data"]]
    return pdf, np.cumsum([len(p[0]) for p in parts])[:-1], [np.concatenate(c) for c in zip(*parts, strict=True)]


def answer(pdf: pd.DataFrame, kind: int, parts: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "kind": kind, "bucket": pdf["bucket"].to_numpy(),
                         "data": [pack(p) for p in parts]})


def settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """All blocks' entries of a key range: which are settled."""
    pdf, cuts, (key, whole, doc, n) = gather(pdf)
    by, starts = first_of(key, doc)
    group = group_of(starts, len(by))
    w = whole[by]
    total = np.add.reduceat(n[by].astype(np.int64), starts)
    entries = np.diff(np.append(starts, len(by)))
    same = (np.minimum.reduceat(w, starts) == np.maximum.reduceat(w, starts)) & (total == entries)
    state = np.where(same[group], (doc[by] > doc[by][starts][group]).astype(np.uint8),
                     np.where(total[group] > HOT, np.uint8(SPREAD), np.uint8(OPEN)))
    status = np.empty(len(by), np.uint8)
    status[by] = state
    del by, starts, group, w, total, entries, same, state, key, whole, doc, n
    tidy()
    return answer(pdf, ANCHOR, np.split(status, cuts))


def answers(pdf: pd.DataFrame, kind: int, dtype) -> np.ndarray:
    own = pdf[pdf["kind"] == kind].sort_values("bucket")["data"]
    return np.concatenate([np.zeros(0, dtype), *[unpack(d)[0] for d in own]])


def send_open(buckets: int):
    """A block's open anchors as sorted, front-coded runs, one per receiver,
    and its strings of hot anchors."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, data in zip(left["block"], left["data"], strict=True):
            b, status = Judged(data), answers(right, ANCHOR, np.uint8)
            _, to, suffix, before, least, most, doc = b.open_runs(status, buckets)
            cuts = np.searchsorted(to, np.arange(buckets + 1))
            for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
                s = slice(cuts[i], cuts[i + 1])
                lcp, tails = front_code(suffix[s])
                out.append((int(i), block, pack(lcp, tails, before[s].ravel(), least[s], most[s], doc[s])))
            _, doc, one, other, new = b.strings(status)
            cols = [c[new] for c in (one, other, doc)]
            out += [(buckets + i, block, pack(*[c[s] for c in cols])) for i, s in sections(cols[0], buckets, 64)]
        tidy()
        return pd.DataFrame(out, columns=["bucket", "block", "data"])
    return run


def receive(buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return merge_strings(pdf) if pdf["bucket"].iloc[0] >= buckets else merge_anchors(pdf)
    return run


def merge_strings(pdf: pd.DataFrame) -> pd.DataFrame:
    """Strings by fingerprint: does a smaller id have it?"""
    pdf, cuts, (one, other, doc) = gather(pdf)
    by = np.lexsort((doc, other, one))
    a, b = one[by], other[by]
    starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    later = np.empty(len(by), np.uint8)
    later[by] = doc[by] > doc[by][starts][group_of(starts, len(by))]
    del by, a, b, starts, one, other, doc
    tidy()
    return answer(pdf, STRING, np.split(later, cuts))


def merge_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merges the runs of a receiver. Per anchor, a bit for each offset: does
    a smaller id have the string that starts so far left of the anchor?"""
    pdf = pdf.sort_values("block")
    texts, lcps, parts = [], [], []
    for d in pdf["data"]:
        lcp, tails, before, least, most, doc = unpack(d)
        raw = front_decode(lcp, tails, LENGTH).tobytes()
        texts.append([raw[i:i + LENGTH] for i in range(0, len(raw), LENGTH)])
        lcps.append(lcp.tolist())
        parts.append((before.reshape(len(lcp), REACH), least, most, doc))
    run, place, lcp = (np.array(x, np.int64) for x in merge_runs(texts, lcps, LENGTH))
    base = np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    flat = base[run] + place
    before, least, most, doc = (np.concatenate([p[i] for p in parts])[flat] for i in range(4))
    bits, left = np.zeros(len(flat), np.uint32), np.full(len(flat), 1, np.uint64)
    for o in range(REACH + 1):
        if o:  # fingerprint of the bytes to the left, one more each time
            left = combine(left, before[:, o - 1].astype(np.uint64) + np.uint64(1))
        have = np.flatnonzero((least <= o) & (o <= most))
        if not len(have):
            continue
        same_right = np.cumsum(lcp < LENGTH - o)[have]
        d, h = doc[have], left[have]
        by = np.lexsort((d, h, same_right))
        r, g = same_right[by], h[by]
        starts = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (g[1:] != g[:-1]))))
        later = d[by] > d[by][starts][group_of(starts, len(by))]
        bits[have[by[later]]] |= np.uint32(1 << o)
    out = np.empty(len(flat), np.uint32)
    out[flat] = bits
    tidy()
    return answer(pdf, RUN, np.split(out, base[1:-1]))


def covered(b: Judged, right: pd.DataFrame, buckets: int) -> np.ndarray:
    """Which bytes of a block a repeated string covers."""
    a, status = b.anchors, answers(right, ANCHOR, np.uint8)
    cover = np.zeros(len(b.text) + 1, np.int32)
    if not len(b.by):
        return cover[:-1] > 0
    state, doc = status[b.group], b.doc[b.by]
    smallest = np.minimum.reduceat(doc, b.starts)[b.group]
    rows = b.by[(state == SETTLED_COPY) | ((state == SETTLED_FIRST) & (doc > smallest))]
    np.add.at(cover, a.lo[rows], 1)
    np.add.at(cover, a.hi[rows] + LENGTH, -1)
    # open anchors: all with one surrounding have its bits, and greater ids all others too
    sent, *_ = b.open_runs(status, buckets)
    if len(sent):
        bits = np.zeros(len(b.distinct), np.uint32)
        number = np.searchsorted(b.distinct, sent)
        bits[number] = answers(right, RUN, np.uint32)
        kind = group_of(b.distinct, len(b.by))
        rows = np.flatnonzero(state == OPEN)
        mine, own = kind[rows], b.by[rows]
        mask = np.where(doc[rows] > doc[b.distinct][mine], np.uint32(0xFFFFFFFF), bits[mine])
        for o in range(REACH + 1):
            at = a.at[own] - o
            hit = at[((mask >> np.uint32(o)) & np.uint32(1)).astype(bool) & (a.lo[own] <= at) & (at <= a.hi[own])]
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + LENGTH, -1)
    at, doc, _, _, new = b.strings(status)
    if len(at):
        group = group_of(new, len(at))
        hit = at[answers(right, STRING, np.uint8)[group].astype(bool) | (doc > doc[new][group])]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + LENGTH, -1)
    return np.cumsum(cover[:-1], dtype=np.int32) > 0


def remove(buckets: int):
    """Spans and kept bytes of a block's documents."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data in left["data"]:
            b = Judged(data)
            gone = covered(b, right, buckets)
            for i, (s, e) in enumerate(zip(b.offsets[:-1], b.offsets[1:], strict=True)):
                mine = gone[s:e]
                first, last = runs(mine)
                spans = [{"start": int(x), "stop": int(y)} for x, y in zip(first, last, strict=True)]
                out.append((None if b.ids[i] == NULL_ID else int(b.ids[i]), int(e - s), spans,
                            b.text[s:e][~mine].tobytes()))
        got = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
        got["doc_id"] = got["doc_id"].astype("Int64")
        tidy()
        return got
    return run


def dedup(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_bytes``, the removed ``spans`` (byte offsets,
    stop exclusive) and the remaining bytes ``kept``."""
    buckets = 4 * scan_partitions(docs)
    blocks = pack_documents(docs)
    settled = kept(block_stage(docs, lambda b: ask(b, buckets), ASK)
                   .groupBy("bucket").applyInPandas(settle, ANSWER))
    merged = (blocks.groupBy("block").cogroup(settled.groupBy("block"))
              .applyInPandas(send_open(buckets), ASK)
              .groupBy("bucket").applyInPandas(receive(buckets), ANSWER))
    both = settled.unionByName(merged)
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(remove(buckets), RESULT)
