"""Documents packed into blocks, and arrays exchanged between blocks.

Operators on all positions of all texts do not send one row per position.
``pack_documents`` packs the documents of an input split into compressed
blocks of bounded size; a stage turns a block into numpy arrays and sends
array slices, one per (receiver, block), through Spark's shuffle; receivers
answer with arrays in the order they were asked. Block ids come from the
input split and a running number, so a task that is run again on another
executor sends the same rows.

A block holds at most ``BLOCK_BYTES`` of text, or one document that is longer.
"""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

BLOCK_BYTES = 2 << 20
BLOCK_DOCS = 20_000
#: Place of a null id in the order of ids: after all others.
NULL_ID = np.iinfo(np.int64).max

BLOCK_SCHEMA = "block long, data binary"

_SEED = np.random.default_rng(20240607)
BYTE_CODES = _SEED.integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
POWER = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(POWER), -1, 1 << 64))


def tidy() -> None:
    """Give freed memory back to the system. Python workers live on between
    tasks, and the allocator would keep what a task has freed."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.malloc_trim  # noqa: B018 - absent from other C libraries
    except (OSError, AttributeError):
        return None
    return libc


_LIBC = _libc()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of a sequence from those of its two parts."""
    x = (a * _M3 + (b ^ (b >> np.uint64(29)))) * _M1
    return x ^ (x >> np.uint64(32))


def pack(*columns: np.ndarray) -> bytes:
    """Arrays to bytes: byte planes apart, so that leading zeros vanish."""
    head, body = [struct.pack("<B", len(columns))], []
    for c in columns:
        c = np.ascontiguousarray(c)
        head.append(struct.pack("<2sQ", c.dtype.str[1:].encode(), len(c)))
        raw = c.view(np.uint8).reshape(len(c), c.dtype.itemsize) if len(c) else np.zeros((0, 1), np.uint8)
        body.append(np.ascontiguousarray(raw.T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = raw[0], 1, []
    kinds = []
    for _ in range(n):
        kinds.append(struct.unpack_from("<2sQ", raw, at))
        at += 10
    for kind, size in kinds:
        dtype = np.dtype(kind.decode())
        end = at + size * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, end - at, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at = end
    return out


def packed(batches: Iterator[pd.DataFrame], block_bytes: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of a task's documents: number and bytes."""
    part = TaskContext.get().partitionId() << 32
    no, ids, texts, size = 0, [], [], 0

    def block():
        lengths = np.array([len(t) for t in texts], np.int64)
        text = np.frombuffer(b"".join(texts), np.uint8)
        return part + no, pack(np.array(ids, np.int64), lengths, text)

    for b in batches:
        for i, t in zip(b["doc_id"].array, b["text"].array, strict=True):
            t = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
            if ids and (size + len(t) > block_bytes or len(ids) >= BLOCK_DOCS):
                yield block()
                no, ids, texts, size = no + 1, [], [], 0
            ids.append(NULL_ID if pd.isna(i) else int(i))
            texts.append(t)
            size += len(t)
    if ids:
        yield block()


def block_stage(docs: DataFrame, stage, schema: str, block_bytes: int | None = None) -> DataFrame:
    """``stage(blocks)`` over the blocks of each input split, one worker for
    both; ``blocks`` yields numbers and bytes, the stage yields pandas frames."""
    size = block_bytes or BLOCK_BYTES

    def run(batches):
        yield from stage(packed(batches, size))
        tidy()

    # ids travel as text: a pandas column of integers with nulls would be float
    return (docs.selectExpr("cast(doc_id as string) doc_id", "text")
            .mapInPandas(run, schema))


def pack_documents(docs: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """``docs(doc_id, text)`` as rows ``(block, data)``; null text is empty."""
    return block_stage(docs, lambda blocks: (
        pd.DataFrame({"block": [n], "data": [d]}) for n, d in blocks), BLOCK_SCHEMA, block_bytes)


def open_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, byte offsets (one more than documents), bytes."""
    ids, lengths, text = unpack(data)
    return ids, np.concatenate(([0], np.cumsum(lengths))).astype(np.int64), text


def word_bounds(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space (0x20, 0x09 to
    0x0D), and per document the index of its first word (one more at the
    end). Words do not cross documents."""
    solid = (text != 32) & ((text < 9) | (text > 13))
    before = np.empty(len(solid), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    edge = offsets[:-1][offsets[:-1] < len(text)]
    before[edge] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(solid), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_WORD_PIECE = 1 << 16
_UP, _DOWN = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``POWER`` and of its inverse."""
    global _UP, _DOWN
    if n > len(_UP):
        n = max(n, 2 * _WORD_PIECE)
        _UP, _DOWN = np.full(n, POWER, np.uint64), np.full(n, _INVERSE, np.uint64)
        _UP[0] = _DOWN[0] = 1
        np.multiply.accumulate(_UP, out=_UP)
        np.multiply.accumulate(_DOWN, out=_DOWN)
    return _UP, _DOWN


def word_codes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit fingerprints of ``text[start:end]``, bytes or wider numbers: a
    polynomial in an odd number over random codes of the items, by prefix sums,
    in pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    codes = mix(BYTE_CODES + np.uint64(salt))
    code = (lambda x: codes[x]) if text.dtype == np.uint8 else (
        lambda x: mix(x.astype(np.uint64) + POWER + np.uint64(salt)))
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + _WORD_PIECE, "right")))
        piece = text[lo:ends[to - 1]]
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(code(piece) * up[:len(piece)], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out)


def gram_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of ``width`` codes, by doubling."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, power, size, whole = codes, 1, 0, None
    while True:
        if width & power:
            whole = have[:n] if whole is None else combine(whole, have[size:size + n])
            size += power
        power <<= 1
        if power > width:
            return whole
        have = combine(have[:-(power >> 1)], have[power >> 1:])


class CodeGrams:
    """Fingerprints of runs of 64-bit codes."""

    def __init__(self, codes: np.ndarray, length: int, gram: int):
        self.codes, self.length, self.gram = codes, length, gram

    def grams(self, start: int, stop: int) -> np.ndarray:
        return gram_codes(self.codes[start:stop], self.gram)

    def wide(self, at: np.ndarray) -> np.ndarray:
        """Of the runs of ``length`` that start at ``at``."""
        if not hasattr(self, "_wide"):
            self._wide = gram_codes(self.codes, self.length)
        return self._wide[at]


class ByteGrams:
    """Fingerprints of runs of bytes, eight bytes at a time."""

    def __init__(self, text: np.ndarray, length: int, gram: int):
        padded = np.concatenate((text, np.zeros(8, np.uint8)))
        # the eight bytes from each place on, as one number
        self.eights = np.ndarray((len(text) + 1,), "<u8", padded, 0, (1,))
        self.length, self.gram = length, gram

    @staticmethod
    def _steps(width: int) -> list[int]:
        return [*range(0, width - 8, 8), width - 8]

    def grams(self, start: int, stop: int) -> np.ndarray:
        n = stop - start - self.gram + 1
        out = None
        for k in self._steps(self.gram):
            part = self.eights[start + k:start + k + n]
            out = mix(part.copy()) if out is None else combine(out, part)
        return out

    def wide(self, at: np.ndarray, salt: int = 0) -> np.ndarray:
        out = np.full(len(at), self.length + (salt << 32), np.uint64)
        for k in self._steps(self.length):
            out = combine(out, mix(self.eights[at + k]))
        return out


class Anchors:
    """The windows of ``length`` items of a block, gathered by anchor.

    A window's anchor is the leftmost of its runs of ``gram`` items whose
    fingerprint is least. It depends on the window's content alone, so equal
    windows have anchors of equal content at equal distance, and the windows
    of one anchor are consecutive. Per anchor: place ``at``, first and last window ``lo``
    and ``hi``, document ``doc``, fingerprint ``key`` of its gram and
    ``whole`` of everything its windows cover and where in it the gram lies.
    Long texts are worked off in pieces; a piece may split the windows of an
    anchor, which changes ``whole`` but not the key.
    """

    PIECE = 60_000  # windows; places in a piece fit into 16 bits

    def __init__(self, items: CodeGrams | ByteGrams, offsets: np.ndarray):
        self.items, self.length, self.offsets = items, items.length, offsets
        n = int(offsets[-1])
        # a window lies in one document: not in the last places of any
        self.ok = np.ones(n, bool)
        tail = np.minimum(np.diff(offsets), self.length - 1)
        ends = np.cumsum(tail)
        self.ok[np.repeat(offsets[1:] - tail, tail) + np.arange(int(ends[-1]) if len(ends) else 0)
                - np.repeat(ends - tail, tail)] = False
        parts = [self._piece(s, min(n, s + self.PIECE + self.length - 1))
                 for s in range(0, max(n - self.length + 1, 0), self.PIECE)]
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        self.lo, self.hi, self.at, self.key = (np.concatenate(x) for x in zip(*(parts or [none]), strict=True))
        self.doc = np.searchsorted(offsets, self.lo, "right") - 1
        at = self.at
        shape = ((at - self.lo) * (self.length + 1) + (at - self.hi + self.length)).astype(np.uint64)
        self.whole = (combine(combine(items.wide(self.lo), items.wide(self.hi)), mix(shape + np.uint64(1)))
                      if len(at) else self.key)

    def _piece(self, start: int, stop: int):
        grams = self.items.grams(start, stop)
        n = stop - start - self.length + 1
        low = np.uint64(0xFFFF)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # equal ones: the leftmost
        width, done = len(grams) - n + 1, 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[step:], least[:len(least) - step])
            done += step
        anchor = (least & low).astype(np.uint16)
        ok = self.ok[start:start + n]
        same = np.zeros(n + 1, bool)  # window i has the anchor of window i - 1
        same[1:n] = (anchor[1:] == anchor[:-1]) & ok[1:] & ok[:-1]
        lo, hi = np.flatnonzero(ok & ~same[:-1]), np.flatnonzero(ok & ~same[1:])
        at = anchor[lo].astype(np.int64)
        return lo + start, hi + start, at + start, grams[at]


def first_of(keys: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by key and then ``order``; returns the sorting and where each key
    begins in it."""
    by = np.lexsort((*order[::-1], keys))
    k = keys[by]
    return by, np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)


def group_of(starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the group of each of ``n`` sorted rows."""
    mark = np.zeros(n, np.int64)
    mark[starts[1:]] = 1
    return np.cumsum(mark)


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
