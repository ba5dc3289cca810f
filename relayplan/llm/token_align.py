"""Cross-tokenizer alignment by products of sparse incidence matrices.

A text is cut into tokens by two vocabularies: byte-level BPE (A, a tokenizer
file in JSON) and SentencePiece (B, a model file). Both cut the same bytes, a
blank and the text. With the incidence of tokens and bytes as sparse matrices
in compressed rows (``Csr``):

- ``A . B^T`` by Gustavson's row products: the row of an A token gathers, for
  each of its bytes, the B tokens of that byte; its entries are the overlap
  links with the number of common bytes.
- Where tokens of A and B end at the same byte, groups end. With the incidences
  of tokens and groups, ``GA . GB^T`` has the links within a group. All rows of a
  group are one interval of B tokens, so the product is kept as intervals
  (``shared_links``) and its size is summed, never its pairs.

Products are formed over stretches of ``STRETCH`` bytes that end where a group
ends, so that a giant document needs no more room than its tokens.

How many documents hold an id pair linked is counted over the corpus: each block
of documents sends its distinct pairs, Spark sums them and finds the highest
count per A id, and the totals go back to the blocks by a join on the pair.
Token work is done once; per document, pairs and multiplicities are written to
the shared folder for the second step.

The A file's merges are replayed by its ranks (ids are its own); special tokens
are not known to it, so their strings are plain text. Files are read on the
driver and go to the tasks with the function; their size bounds that.

Defined cases: null and empty texts, and texts whose tokens do not join to
blank + text (a U+2581 in the text, for one), have no tokens: zeros and an empty
``groups_sha256``; every row is a document, equal rows and null ids too; an
empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relayplan.llm.blocks import pack, tidy, unpack
from relayplan.session import scratch_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# fixed value: how the byte-level file cuts text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"
STRETCH = 1 << 18
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 20_000

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
# ids travel as text: a pandas column of integers with nulls would be float
SCHEMA = ("block long, doc_id string, " + ", ".join(f"{c} long" for c in COUNTS)
          + ", groups_sha256 string, data binary, pair long, n long")
RESULT = ("doc_id string, " + ", ".join(f"{c} long" for c in COUNTS)
          + ", n_best long, count_sum long, groups_sha256 string")


# ---- sparse matrices ---------------------------------------------------------

@dataclass(frozen=True)
class Csr:
    """Rows of a sparse matrix: row ``i`` has the columns
    ``indices[indptr[i]:indptr[i + 1]]`` with ``data``, one each if None."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int
    data: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.indptr))

    def transposed(self) -> Csr:
        row, by = self.row_of(), None
        if len(self.indices) and (self.indices[1:] < self.indices[:-1]).any():
            by = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns)))).astype(np.int64)
        pick = (lambda x: x) if by is None else (lambda x: x[by])
        return Csr(indptr, pick(row), self.rows, None if self.data is None else pick(self.data))


def of_lengths(lengths: np.ndarray) -> Csr:
    """Incidence of consecutive tokens and their bytes."""
    indptr = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return Csr(indptr, np.arange(indptr[-1], dtype=np.int64), int(indptr[-1]))


def of_labels(label: np.ndarray, columns: int) -> Csr:
    """Incidence of items and the one group each is in."""
    return Csr(np.arange(len(label) + 1, dtype=np.int64), label, columns)


def gustavson(a: Csr, b: Csr) -> Csr:
    """``a . b``, row by row: entry (i, k) of ``a`` brings row k of ``b`` into
    row i, equal columns add up. All rows at once, by arrays."""
    if a.columns != b.rows:
        raise ValueError("shapes do not fit")
    n = np.diff(b.indptr)[a.indices]
    row = np.repeat(a.row_of(), n)
    first = np.repeat(b.indptr[a.indices] - (np.cumsum(n) - n), n)
    at = first + np.arange(len(row))
    col = b.indices[at]
    left = np.ones(len(a.indices), np.int64) if a.data is None else a.data
    value = np.repeat(left, n) if b.data is None else np.repeat(left, n) * b.data[at]
    key = row * max(b.columns, 1) + col
    if len(key) and (key[1:] < key[:-1]).any():
        by = np.argsort(key, kind="stable")
        key, value = key[by], value[by]
    new = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    value = np.add.reduceat(value, new) if len(new) else value[:0]
    row, col = np.divmod(key[new], max(b.columns, 1))
    indptr = np.searchsorted(row, np.arange(a.rows + 1))
    return Csr(indptr, col, b.columns, value)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries of each row of ``a . b`` where no two terms meet in a column,
    without forming them."""
    total = np.concatenate(([0], np.cumsum(np.diff(b.indptr)[a.indices])))
    return total[a.indptr[1:]] - total[a.indptr[:-1]]


# ---- tokenizers --------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """Byte of each character in the A file: printable ones stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coders:
    """Both tokenizers of a task, their tokens' bytes and the texts of ids."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        spec, code = json.loads(a_file), _byte_of()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(code[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id and what follows it: within a side, after side A, after a group, at the end
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        self.a_text = [f"{i}{end}".encode() for end in (",", "|") for i in range(self.n_a)]
        self.text = self.a_text + [f"{i}{end}".encode() for end in (",", ";", "") for i in range(self.n_b)]

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace(MARK, " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A and by B; none where they do not join to blank + text."""
        none = (np.zeros(0, np.int64),) * 2
        out = []
        for t in texts:
            if not t:
                out.append(none)
                continue
            raw = (" " + t).encode()
            a = self.a.encode_ordinary(" " + t)
            b = self.b.encode(t, num_threads=1)
            if (b"".join(map(self.a_bytes.__getitem__, a)) != raw
                    or b"".join(map(self.b_bytes.__getitem__, b)) != raw):
                out.append(none)
                continue
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return out


_CODERS: dict[bytes, Coders] = {}


def coders(a_file: bytes, b_file: bytes) -> Coders:
    """One pair of tokenizers a worker."""
    key = hashlib.sha256(a_file + b_file).digest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coders(a_file, b_file)
    return _CODERS[key]


# ---- alignment ---------------------------------------------------------------

@dataclass(frozen=True)
class Alignment:
    """Tokens of documents laid end to end: ids, the group of each token, the
    number of groups, and overlap links (token of A, token of B, bytes)."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    groups: int
    link_a: np.ndarray
    link_b: np.ndarray
    overlap: np.ndarray

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``GA . GB^T`` as intervals: per A token the first B token of
        its group and one past the last."""
        of_b = of_labels(self.b_group, self.groups).transposed()
        first = of_b.indptr[self.a_group]
        return first, first + product_sizes(of_labels(self.a_group, self.groups), of_b)


def align(a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> Alignment:
    """Aligns tokens that cover the same bytes; ``a_len`` and ``b_len`` are the
    tokens' numbers of bytes."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    total = int(a_end[-1]) if len(a_end) else 0
    if total != (int(b_end[-1]) if len(b_end) else 0):
        raise ValueError("tokens cover different bytes")
    ends = np.zeros(total + 1, bool)
    ends[a_end] = True
    common = b_end[ends[b_end]]
    links, at, a0, b0 = [], 0, 0, 0
    while at < total:
        stop = int(common[min(np.searchsorted(common, at + STRETCH), len(common) - 1)])
        a1, b1 = np.searchsorted(a_end, stop, "right"), np.searchsorted(b_end, stop, "right")
        got = gustavson(of_lengths(a_len[a0:a1]), of_lengths(b_len[b0:b1]).transposed())
        links.append((got.row_of() + a0, got.indices + b0, got.data))
        at, a0, b0 = stop, a1, b1
    none = (np.zeros(0, np.int64),) * 3
    link_a, link_b, overlap = (np.concatenate(x) for x in zip(*(links or [none]), strict=True))
    return Alignment(a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end), len(common),
                     link_a, link_b, overlap)


def group_texts(al: Alignment, a_count: np.ndarray, b_count: np.ndarray, c: Coders) -> Iterator[bytes]:
    """Per document (tokens of A, tokens of B): ``a1,a2|b1;a3|b2,b3``."""
    na = np.bincount(al.a_group, minlength=al.groups)
    nb = np.bincount(al.b_group, minlength=al.groups)
    a_stop, b_stop = np.cumsum(na), np.cumsum(nb)
    item = np.empty(len(al.a) + len(al.b), np.int64)
    last = np.zeros(len(al.a), np.int64)
    last[a_stop - 1] = 1
    item[np.arange(len(al.a)) + (b_stop - nb)[al.a_group]] = al.a + last * c.n_a
    last = np.zeros(len(al.b), np.int64)
    last[b_stop - 1] = 1
    last[np.cumsum(b_count)[b_count > 0] - 1] = 2
    item[np.arange(len(al.b)) + a_stop[al.b_group]] = 2 * c.n_a + al.b + last * c.n_b
    at = 0
    for n in (a_count + b_count).tolist():
        yield b"".join(map(c.text.__getitem__, item[at:at + n].tolist()))
        at += n


def _block(no: int, ids: list, texts: list, c: Coders) -> Iterator[pa.RecordBatch]:
    """A block's documents and its distinct pairs as rows of ``SCHEMA``."""
    coded = c.encode(texts)
    a_count, b_count = (np.array([len(x[i]) for x in coded], np.int64) for i in (0, 1))
    a, b = (np.concatenate([x[i] for x in coded]) for i in (0, 1))
    al = align(a, b, c.a_len[a], c.b_len[b])
    doc = np.repeat(np.arange(len(ids)), a_count)  # of each A token
    first, stop = al.shared()
    groups = np.bincount(doc[np.searchsorted(al.a_group, np.arange(al.groups))], minlength=len(ids))
    shared = np.bincount(doc, stop - first, len(ids)).astype(np.int64)
    links = np.bincount(doc[al.link_a], minlength=len(ids))
    pairs, of = np.unique(a[al.link_a] * c.n_b + b[al.link_b], return_inverse=True)
    each, times = np.unique(doc[al.link_a] * max(len(pairs), 1) + of, return_counts=True)
    in_doc, pair = np.divmod(each, max(len(pairs), 1))
    cuts = np.searchsorted(in_doc, np.arange(len(ids) + 1))
    pair, times = pair.astype(np.uint32), times.astype(np.uint32)
    sha = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(al, a_count, b_count, c)]
    data = [pack(pair[s:e], times[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]

    def batch(n: int, columns: dict) -> pa.RecordBatch:
        kinds = {"doc_id": pa.string(), "groups_sha256": pa.string(), "data": pa.binary()}
        full = {"block": np.full(n, no, np.int64)} | columns
        return pa.RecordBatch.from_arrays([pa.array(full[k], kinds.get(k, pa.int64())) if k in full
                                           else pa.nulls(n, kinds.get(k, pa.int64())) for k in names], names)

    yield batch(len(ids), dict(zip(["doc_id", *COUNTS, "groups_sha256", "data"], [
        ids, a_count, b_count, groups, links, shared, sha, data], strict=True)))
    per = np.bincount(pair, minlength=len(pairs))
    for s in range(0, len(pairs), 50_000):
        yield batch(len(pairs[s:s + 50_000]), {"pair": pairs[s:s + 50_000], "n": per[s:s + 50_000]})


def _encoded(a_file: bytes, b_file: bytes, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(a_file, b_file)
        part = TaskContext.get().partitionId() << 32
        no, ids, texts, size = 0, [], [], 0
        for b in batches:
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                if ids and (size + len(t or "") > block_bytes or len(ids) >= BLOCK_DOCS):
                    yield from _block(part + no, ids, texts, c)
                    no, ids, texts, size = no + 1, [], [], 0
                    tidy()
                ids.append(i)
                texts.append(t)
                size += len(t or "")
        if ids:
            yield from _block(part + no, ids, texts, c)
        tidy()
    return run


def _judged(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """A block's documents with the corpus counts of their links."""
    pairs = pairs.sort_values("pair")
    total, top = pairs["total"].to_numpy(np.int64), pairs["top"].to_numpy(bool)
    best, counts = [], []
    for d in docs["data"]:
        pair, times = unpack(d)
        times = times.astype(np.int64)
        best.append(int((times * top[pair]).sum()) if len(pair) else 0)
        counts.append(int((times * total[pair]).sum()) if len(pair) else 0)
    out = docs[["doc_id", *COUNTS, "groups_sha256"]].assign(n_best=best, count_sum=counts)
    tidy()
    return out


def read_files(a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> tuple[bytes, bytes]:
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def pair_counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """``pair, total, top``: documents per pair of ids, and whether no other
    pair of the A id has more."""
    total = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # a window holds the B ids of an A id: no more than B's vocabulary
    most = F.max("total").over(Window.partitionBy("a"))
    return (total.withColumn("a", F.floor(F.col("pair") / F.lit(n_b)).cast("long"))
            .select("pair", "total", (F.col("total") == most).alias("top")))


def alignment(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: numbers of tokens, groups, overlap links and shared-group
    links, links of highest count, sum of counts, digest of the groups."""
    spark = docs.sparkSession
    files = read_files(a_path, b_path)
    n_b = coders(*files).n_b
    path = scratch_path(spark, "token-align")
    docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(
        _encoded(*files, block_bytes), SCHEMA).write.parquet(path)
    rows = lambda: spark.read.schema(SCHEMA).parquet(path)
    pairs = rows().filter(F.col("pair").isNotNull()).select("block", "pair", "n")
    judged = pairs.drop("n").join(pair_counts(pairs, n_b), "pair")
    own = rows().filter(F.col("pair").isNull()).drop("pair", "n")
    return own.groupBy("block").cogroup(judged.groupBy("block")).applyInPandas(
        lambda left, right: _judged(left, right), RESULT).withColumn("doc_id", F.col("doc_id").cast("long"))


def overlap_links(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """The links themselves: ``doc_id``, places ``a_at`` and ``b_at`` and ids
    ``a`` and ``b`` of two tokens that overlap, ``n_bytes`` in common, and the
    B tokens of the group, ``b_first`` to ``b_stop`` (exclusive): the A token's
    shared-group links."""
    files = read_files(a_path, b_path)
    schema = ("doc_id long, a_at long, b_at long, a long, b long, n_bytes long, b_first long, b_stop long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(*files)
        for batch in batches:
            for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ((a, b),) = c.encode([t])
                al = align(a, b, c.a_len[a], c.b_len[b])
                first, stop = al.shared()
                cols = [al.link_a, al.link_b, a[al.link_a], b[al.link_b], al.overlap,
                        first[al.link_a], stop[al.link_a]]
                for s in range(0, len(al.link_a), 50_000):
                    n = len(al.link_a[s:s + 50_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * n, pa.int64()), *[pa.array(x[s:s + 50_000], pa.int64()) for x in cols]],
                        [f.split(" ")[0] for f in schema.split(", ")])
        tidy()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
