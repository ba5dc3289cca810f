"""N-gram Jaccard join with an R-tree over count vectors.

A document's set holds its distinct word shingles. The shingles are hashed
into ``GROUPS`` groups; the counts per group are a point. Two sets share at
most ``sum(min(a_g, b_g))`` shingles, and a link of similarity ``T`` needs
``T / (1 + T) * (|A| + |B|)`` of them, so an R-tree over the points finds the
pairs that can link: a box is entered only if the sum of coordinate minima of
the query and the box's upper corner, over the sizes the box allows, reaches
the need. Surviving pairs are verified by intersecting the sets.

How the join is spread over the cluster, without losing a link:

1. Whoever links with A has at least ``T |A|`` of its shingles. Each document
   sends the smallest ``1 - T`` and a tenth of its shingle fingerprints and
   learns which of them others have; documents with too few of them have no
   partner and are done.
2. Documents with equal sets become one. Each remaining set is posted under
   its smallest ``floor((1 - T) n) + 1`` fingerprints: linked sets share one
   of these (prefix rule). Within a posting an R-tree finds the pairs; each
   receiver returns stars of connected sets, not pairs. Postings are counted
   first: one of more than ``POSTING`` sets is cut into chunks by hash, and each
   pair of chunks is a group of its own, so that no task takes it whole.
3. The stars' connected components are candidate clusters. A cluster's sets
   meet in blocks of bounded size, each pair of blocks in one task; an R-tree
   finds pairs that are not yet connected and can link, and the sets decide.
   Only links that connect are returned. Their components are the result.

Boxes alone do not separate unrelated documents of one size when shingles
spread evenly over the groups, hence the postings around the tree.

Defined cases: a text of fewer than ``WIDTH`` words has its whole sequence as
its one shingle; null, empty and blank texts have none and link with nothing;
rows of equal id are linked and labelled like others; a null id is greater
than all others, and null if it is the smallest; an empty table gives no rows;
``drop_duplicates`` keeps all columns, of any name, and decides by row: rows
are told apart by id and text, so other rows of a null or repeated id stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan.llm.blocks import (NULL_ID, block_stage, gram_codes, group_of, mix, open_block, pack,
                                  pack_documents, tidy, unpack, word_bounds, word_codes)
from relayplan.llm.common import aside, kept, scan_partitions, text_key
from relayplan.llm.decontaminate import checked

WIDTH = 5
T_NUM, T_DEN = 8, 10  # similarity, as a fraction of integers
GROUPS = 128
LEAF = 32
CLUSTER_BLOCK = 2048
#: Postings up to this size are joined pair by pair.
SMALL = 8
#: Sets of a posting that make a chunk; larger postings are cut.
POSTING = 4096
#: Sets that post together, as a power of two.
POST_BITS = 8

ASK = "bucket int, block long, data binary"
ANSWER = "block long, kind int, bucket int, data binary"
HOT = "block long, data binary"
POSTED = "bucket int, own long, data binary"
SETS = "id long, key binary, n long, d1 long, d2 long, data binary"
EDGE = "a long, b long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def spare(n):
    """Shingles of a set of ``n`` that a partner may lack."""
    return n - -(-T_NUM * n // T_DEN)


def asked(n):
    return np.minimum(n, spare(n) + 1 + n // 10)


def need(a, b):
    """Least common shingles of linked sets of sizes ``a`` and ``b``."""
    return -(-T_NUM * (a + b) // (T_NUM + T_DEN))


class Sets:
    """The shingle sets of a block's documents: sorted fingerprints of each,
    one after the other, and their bounds."""

    def __init__(self, data: bytes):
        self.ids, offsets, text = open_block(data)
        self.offsets, self.text = offsets, text
        text = _LOWER[text]
        starts, ends, first = word_bounds(text, offsets)
        codes = word_codes(text, starts, ends)
        count = np.diff(first)
        n = len(codes) - WIDTH + 1
        doc = np.repeat(np.arange(len(count)), count)
        grams = gram_codes(codes, WIDTH)
        at = np.flatnonzero(doc[:max(n, 0)] == doc[WIDTH - 1:]) if n > 0 else np.zeros(0, np.int64)
        value, owner = [grams[at]], [doc[at]]
        for i in np.flatnonzero((count > 0) & (count < WIDTH)):
            value.append(mix(gram_codes(codes[first[i]:first[i + 1]], int(count[i])) + np.uint64(count[i])))
            owner.append(np.array([i]))
        value, owner = np.concatenate(value), np.concatenate(owner)
        by = np.lexsort((value, owner))
        value, owner = value[by], owner[by]
        new = np.ones(len(by), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.value, self.owner = value[new], owner[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(count) + 1))
        self.n = np.diff(self.bounds)
        place = np.arange(len(self.value)) - self.bounds[self.owner]
        pick = np.flatnonzero(place < asked(self.n)[self.owner])
        #: what is asked about: places and the distinct keys, sorted
        self.pick = pick
        self.keys, self.key_no, self.key_count = np.unique(
            self.value[pick] >> np.uint64(16), return_inverse=True, return_counts=True)

    def rows(self, shared: np.ndarray) -> Iterator[tuple]:
        """A row per document; those that may link carry their set."""
        hit = np.zeros(len(self.value), bool)
        hit[self.pick] = shared[self.key_no].astype(bool)
        have = np.bincount(self.owner[self.pick], hit[self.pick], minlength=len(self.n)).astype(np.int64)
        may = (self.n > 0) & (have >= asked(self.n) - spare(self.n))
        group = (mix(self.value) >> np.uint64(40)).astype(np.int64) % GROUPS
        for i in range(len(self.n)):
            own = slice(self.bounds[i], self.bounds[i + 1])
            d1 = d2 = 0
            data = None
            if may[i]:
                value = self.value[own]
                d1, d2 = np.frombuffer(hashlib.blake2b(value.tobytes(), digest_size=16).digest(), np.int64).tolist()
                prefix = value[:spare(len(value)) + 1]
                prefix = prefix[hit[own][:len(prefix)]]
                data = pack(value, prefix, np.bincount(group[own], minlength=GROUPS).astype(np.int32))
            # as ``text_key`` has it
            key = hashlib.sha256(self.text[self.offsets[i]:self.offsets[i + 1]].tobytes()).digest()
            yield int(self.ids[i]), key, int(self.n[i]), d1, d2, data


def ask(blocks, buckets: int):
    edge = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** 48 / buckets)).astype(np.uint64)
    for block, data in blocks:
        s = Sets(data)
        cuts = np.concatenate(([0], np.searchsorted(s.keys, edge), [len(s.keys)]))
        several = (s.key_count > 1).astype(np.uint8)
        rows = [(int(i), block, pack(s.keys[cuts[i]:cuts[i + 1]], several[cuts[i]:cuts[i + 1]]))
                for i in np.flatnonzero(cuts[1:] > cuts[:-1])]
        if rows:
            yield pd.DataFrame(rows, columns=["bucket", "block", "data"])


def tell(pdf: pd.DataFrame) -> pd.DataFrame:
    """Which fingerprints of a range more than one document has."""
    pdf = pdf.sort_values("block")
    parts = [unpack(d) for d in pdf["data"]]
    key, several = (np.concatenate([p[i] for p in parts]) for i in range(2))
    _, no, count = np.unique(key, return_inverse=True, return_counts=True)
    shared = ((count > 1)[no] | (several > 0)).astype(np.uint8)
    parts = np.split(shared, np.cumsum([len(p[0]) for p in parts])[:-1])
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "kind": 0, "bucket": pdf["bucket"].to_numpy(),
                         "data": [pack(p) for p in parts]})


def to_sets(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = []
    told = [unpack(d)[0] for d in right.sort_values("bucket")["data"]]
    shared = np.concatenate([np.zeros(0, np.uint8), *told])
    for data in left["data"]:
        out += Sets(data).rows(shared)
    tidy()
    return pd.DataFrame(out, columns=["id", "key", "n", "d1", "d2", "data"])


class Forest:
    """Connected components by union of their roots."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def roots(self) -> np.ndarray:
        up = np.array(self.up, np.int64)
        while True:
            higher = up[up]
            if (higher == up).all():
                return up
            up = higher


class RTree:
    """Packed R-tree over count vectors: points sorted by size and then by
    their first counts, ``LEAF`` to a page, ``LEAF`` pages to a box above."""

    def __init__(self, n: np.ndarray, points: np.ndarray):
        tile = max(1, LEAF * int(np.sqrt(max(1, len(n) / LEAF))))
        size_order = np.argsort(n, kind="stable")
        slab = np.empty(len(n), np.int64)
        slab[size_order] = np.arange(len(n)) // tile
        self.order = np.lexsort((points[:, 0], points[:, :GROUPS // 2].sum(axis=1), slab))
        # sums of counts stay exact in the narrow type up to 2**24
        kind = np.float32 if int(n.max(initial=0)) < 1 << 23 else np.float64
        self.n, self.points = n[self.order], points[self.order].astype(kind)
        self.ones = np.ones(points.shape[1], kind)
        self.levels = []
        at, top, low, high = np.arange(0, len(n), LEAF), self.points, self.n, self.n
        while len(at) > 1 or not self.levels:
            top = np.maximum.reduceat(top, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))
            if len(at) == 1:
                break
            at = np.arange(0, len(at), LEAF)

    def fits(self, q, size, top, low, high) -> np.ndarray:
        """Boxes (points: low = high) that may hold a partner of the query."""
        least = np.maximum(low, -(-T_NUM * size // T_DEN))
        return ((T_DEN * high >= T_NUM * size) & (T_NUM * low <= T_DEN * size)
                & (np.minimum(top, q) @ self.ones >= need(size, least)))

    def partners(self, q: np.ndarray, size: int) -> np.ndarray:
        """Points that may link with a query, by their original numbers."""
        boxes, q = np.arange(len(self.levels[-1][0])), q.astype(self.points.dtype)
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            boxes = boxes[self.fits(q, size, top[boxes], low[boxes], high[boxes])]
            boxes = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
            boxes = boxes[boxes < (len(self.levels[k - 1][0]) if k else len(self.n))]
        n = self.n[boxes]
        return self.order[boxes[self.fits(q, size, self.points[boxes], n, n)]]


def prefix_keys(data: bytes) -> np.ndarray:
    return unpack(data)[1] >> np.uint64(16)


def receiver(key: np.ndarray, buckets: int) -> np.ndarray:
    # keys are the smallest fingerprints: spread them again
    return (mix(key) % np.uint64(buckets)).astype(np.int64)


def count_keys(buckets: int):
    """How many sets of each block post under a key."""
    def run(batches):
        for b in batches:
            rows = []
            for block, own in b.groupby("block", sort=False):
                key, n = np.unique(np.concatenate([prefix_keys(d) for d in own["data"]]), return_counts=True)
                to = receiver(key, buckets)
                by = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[by], np.arange(buckets + 1))
                rows += [(int(k), int(block), pack(key[by[cuts[k]:cuts[k + 1]]], n[by[cuts[k]:cuts[k + 1]]]))
                         for k in np.flatnonzero(cuts[1:] > cuts[:-1])]
            yield pd.DataFrame(rows, columns=["bucket", "block", "data"])
        tidy()
    return run


def hot_keys(pdf: pd.DataFrame) -> pd.DataFrame:
    """Keys of postings that are cut, and their numbers of chunks, for each
    block that has them."""
    parts = [unpack(d) for d in pdf["data"]]
    key, no = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, no, np.concatenate([p[1] for p in parts]))
    chunks = -(-total // POSTING)
    out, at = [], 0
    for block, p in zip(pdf["block"], parts, strict=True):
        mine = chunks[no[at:at + len(p[0])]]
        at += len(p[0])
        if (mine > 1).any():
            out.append((block, pack(p[0][mine > 1], mine[mine > 1])))
    tidy()
    return pd.DataFrame(out, columns=["block", "data"])


def post_sets(buckets: int):
    """Sets under their prefix fingerprints, one array row per receiver; under
    a key that is cut, one row per pair of chunks (``own`` names the pair)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = [prefix_keys(d) for d in left["data"]]
        size = [len(k) for k in keys]
        key = np.concatenate([np.zeros(0, np.uint64), *keys])
        i, n = (np.repeat(left[c].to_numpy(), size) for c in ("id", "n"))
        point = [unpack(d)[2] for d in left["data"]]
        which = np.repeat(np.arange(len(size)), size)
        hot = [unpack(d) for d in right["data"]]
        hot_key = np.concatenate([np.zeros(0, np.uint64), *[h[0] for h in hot]])
        cut_into = np.concatenate([np.zeros(0, np.int64), *[h[1] for h in hot]])
        # a key has one receiver, but a block may have told it in several batches
        hot_key, first = np.unique(hot_key, return_index=True)
        cut_into = cut_into[first]
        chunks = np.ones(len(key), np.int64)
        if len(hot_key):
            at = np.minimum(np.searchsorted(hot_key, key), len(hot_key) - 1)
            chunks = np.where(hot_key[at] == key, cut_into[at], 1)
        # entries go to each pair of their own chunk and another
        row = np.repeat(np.arange(len(key)), chunks)
        other = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        mine = (mix(i[row].astype(np.uint64)) % chunks[row].astype(np.uint64)).astype(np.int64)
        pair = np.minimum(mine, other) * chunks[row] + np.maximum(mine, other)
        group = np.where(chunks[row] > 1, mix(key[row] + mix(pair.astype(np.uint64))).astype(np.int64), 0)
        to = np.where(group != 0, receiver(group.astype(np.uint64), buckets), receiver(key[row], buckets))
        by = np.lexsort((group, to))
        row, group, to = row[by], group[by], to[by]
        starts = np.flatnonzero(np.concatenate(([True], (to[1:] != to[:-1]) | (group[1:] != group[:-1])))) if len(
            by) else np.zeros(0, np.int64)
        rows = []
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(by)).tolist(), strict=True):
            r = row[s:e]
            rows.append((int(to[s]), int(group[s]), pack(
                key[r], i[r], n[r].astype(np.int32), np.stack([point[w] for w in which[r]]).ravel())))
        tidy()
        return pd.DataFrame(rows, columns=["bucket", "own", "data"])
    return run


def join_postings(pdf: pd.DataFrame) -> pd.DataFrame:
    """Stars of sets that may link, over all postings of a receiver."""
    parts = [unpack(d) for d in pdf["data"]]
    key, ids, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
    point = np.concatenate([p[3] for p in parts]).reshape(len(key), GROUPS)
    by = np.lexsort((ids, n, key))
    key, ids, n, point = key[by], ids[by], n[by].astype(np.int64), point[by]
    names, who = np.unique(ids, return_inverse=True)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    small = (sizes <= SMALL)[group_of(starts, len(key))]
    pairs = []
    for d in range(1, SMALL):  # small postings: all pairs, at distance d in the order
        i = np.flatnonzero(small[:-d] & (key[:-d] == key[d:])) if len(key) > d else np.zeros(0, np.int64)
        i = i[T_DEN * n[i] >= T_NUM * n[i + d]]
        i = i[np.minimum(point[i], point[i + d]).sum(axis=1) >= need(n[i], n[i + d])]
        pairs.append(np.stack((who[i], who[i + d]), axis=1))
    forest = Forest(len(names))
    for a, b in np.unique(np.concatenate(pairs), axis=0).tolist():
        forest.join(a, b)
    for s, k in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = who[s:s + k].tolist()
        apart = len({forest.root(x) for x in own}) - 1
        tree = RTree(n[s:s + k], point[s:s + k]) if apart else None
        for i in range(k):
            if not apart:  # all sets of the posting are connected
                break
            for j in tree.partners(point[s + i], int(n[s + i])).tolist():
                apart -= forest.join(own[i], own[j])
    root = forest.roots()
    far = np.flatnonzero(root != np.arange(len(names)))
    tidy()
    return pd.DataFrame({"a": names[far], "b": names[root[far]]})


class Overlaps:
    """Exact common shingles of one set with many: postings of all shingles
    of a block's sets."""

    def __init__(self, sets: list[np.ndarray]):
        size = [len(s) for s in sets]
        _, self.token = np.unique(np.concatenate(sets), return_inverse=True)
        self.bounds = np.concatenate(([0], np.cumsum(size)))
        owner = np.repeat(np.arange(len(sets)), size)
        by = np.argsort(self.token, kind="stable")
        self.owner = owner[by]
        self.starts = np.searchsorted(self.token[by], np.arange(int(self.token.max()) + 2))

    def of(self, i: int) -> np.ndarray:
        token = self.token[self.bounds[i]:self.bounds[i + 1]]
        n = self.starts[token + 1] - self.starts[token]
        at = np.repeat(self.starts[token] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.owner[at], minlength=len(self.bounds) - 1)


def verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links that connect, within the clusters' blocks or between two of them."""
    out = []
    for _, group in pdf.groupby(["cluster", "part"], sort=False):
        sets = [unpack(d) for d in group["data"]]
        ids, n = group["id"].to_numpy(), group["n"].to_numpy()
        points, shingles = np.stack([s[2] for s in sets]), [s[0] for s in sets]
        forest, apart = Forest(len(ids)), len(ids) - 1
        tree, overlaps = RTree(n, points), Overlaps(shingles) if len(ids) > 8 else None
        # larger sets first: they meet those between which most links lie
        for i in np.argsort(n, kind="stable")[::-1].tolist():
            if not apart:
                break
            mine = forest.root(i)
            near = [j for j in tree.partners(points[i], int(n[i])).tolist() if forest.root(j) != mine]
            if overlaps is not None and len(near) > 4:
                common = overlaps.of(i)[near]
            else:
                common = [len(np.intersect1d(shingles[i], shingles[j], assume_unique=True)) for j in near]
            for j, c in zip(near, common, strict=True):
                if c >= need(int(n[i]), int(n[j])) and forest.join(i, j):
                    apart -= 1
                    out.append((int(ids[i]), int(ids[j])))
    tidy()
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` of all ids in ``edges(a, b)``, root the smallest id of the
    component: each round points every id to the smallest neighbour (large
    star) and then to the smallest of those below it (small star)."""
    now = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct())
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.filter("a <> b").distinct()
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = (low.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        new = kept(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        same = (new.count() == now.count()) and new.join(now, ["a", "b"], "left_anti").isEmpty()
        now = new
        if same:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))


def candidate_sets(docs: DataFrame, buckets: int) -> DataFrame:
    blocks = pack_documents(docs)
    told = kept(block_stage(docs, lambda b: ask(b, buckets), ASK).groupBy("bucket").applyInPandas(tell, ANSWER))
    return kept(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(to_sets, SETS))


def labels(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row per row of ``docs`` (``SETS``), and for each distinct set
    (``d1, d2``) the row that stands for its component: ``least(id, key)``."""
    buckets = 4 * scan_partitions(docs)
    sets = candidate_sets(docs, buckets)
    may = sets.filter(F.col("data").isNotNull())
    # distinct sets, numbered; ``least`` is the smallest document id of each, with its text's key
    one = kept(may.groupBy("d1", "d2").agg(F.min(F.struct("id", "key")).alias("least"), F.first("n").alias("n"),
                                           F.first("data").alias("data"))
               .withColumn("id", F.monotonically_increasing_id()))
    post = one.select(F.shiftright("id", POST_BITS).alias("block"), "id", "n", "data")
    cut = (post.select("block", "data").mapInPandas(count_keys(buckets), ASK)
           .groupBy("bucket").applyInPandas(hot_keys, HOT))
    stars = (post.groupBy("block").cogroup(cut.groupBy("block")).applyInPandas(post_sets(buckets), POSTED)
             .groupBy("bucket", "own").applyInPandas(join_postings, EDGE))
    cluster = components(stars)
    named = cluster.unionByName(cluster.select(F.col("root").alias("id"), "root").distinct())
    held = one.select("id", "n", "data").join(named.withColumnRenamed("root", "cluster"), "id")
    # blocks of a cluster, by hash; each pair of blocks is one task's group
    size = named.groupBy("root").agg(F.count(F.lit(1)).alias("_size")).select(F.col("root").alias("cluster"), "_size")
    parts = F.ceil(F.col("_size") / CLUSTER_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.least(own, k) * parts + F.greatest(own, k))
    spread = (held.join(size, "cluster").select("id", "n", "data", "cluster", parts.alias("_parts"),
                                                F.explode(pairs).alias("part"))
              .withColumn("own", F.when(F.col("_parts") > 1, F.struct("cluster", "part"))).drop("_parts")
              .withColumn("bucket", F.pmod(F.xxhash64("cluster", "part"), F.lit(buckets)).cast("int")))
    # clusters of one block share groups, each pair of blocks of a larger one is a group
    links = spread.groupBy("bucket", "own").applyInPandas(verify, EDGE)
    rooted = one.select("d1", "d2", "id", "least").join(components(links), "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    return sets, (rooted.select("d1", "d2", "root")
                  .join(rooted.groupBy("root").agg(F.min("least").alias("least")), "root")
                  .select("d1", "d2", "least"))


def link(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    sets, label = labels(docs)
    label = label.select("d1", "d2", F.col("least.id").alias("root"), F.lit(True).alias("may"))
    full = sets.select("id", "n", "d1", "d2", (F.col("data").isNotNull()).alias("may")).join(
        label, ["d1", "d2", "may"], "left")
    null_id = F.lit(NULL_ID)
    return full.select(F.nullif("id", null_id).alias("doc_id"), F.col("n").alias("n_shingles"),
                       F.nullif(F.coalesce("root", "id"), null_id).alias("component_id"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of
    equal ids, of the smallest text key). Rows that repeat both id and text
    count as one document."""
    docs, back = aside(docs, "doc_id", "text")
    sets, label = labels(docs)
    own = [F.nullif("id", F.lit(NULL_ID)).alias("_id"), F.col("key").alias("_of")]
    gone = checked(kept(sets.filter(F.col("data").isNotNull()).join(label, ["d1", "d2"])
                        .filter((F.col("id") != F.col("least.id")) | (F.col("key") != F.col("least.key")))
                        .select(*own).distinct()))
    twice = checked(kept(sets.groupBy("id", "key").count().filter("count > 1").select(*own)))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_of"))
    left = docs.withColumn("_key", text_key("text")).join(gone, same, "left_anti")
    return back(left.join(twice, same, "left_anti")
                .unionByName(left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])))
