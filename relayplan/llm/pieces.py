"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is cut into pieces of a vocabulary so that the sum of their scores is
greatest. That is a longest path through positions, a product of matrices over
(max, +), and such products are associative:

- A piece never holds the blank mark behind another character (checked for the
  vocabulary), so all paths meet before each run of blanks. Runs between are
  segments; equal segments are solved once per batch, all in lockstep.
- A giant document is split into chunks of ``CHUNK`` characters anywhere. The
  state at a chunk's border is by how many characters a piece reaches over it.
  Each chunk yields its transfer matrix (best score from each state at its
  start to each state at its end); the matrices are combined by prefix products,
  which fix the best state at each border; then each chunk is traced back by
  itself between its two states.

Scores are integers here (scaled), and a small fixed number per piece is added
to decide ties, so that the pieces found do not depend on where a text is
split; only in repetitions can the same pieces come in another order.

The public model file is of the BPE kind: its scores are ranks of merges, not
log-probabilities. Ranks are turned into these by Zipf's law, ``-ln(rank + 2)``;
a file whose scores are not whole numbers is taken as it is. Ids are those of
the file; the segmentation is the most probable one, which often but not always
is the one that replaying the merges gives.

As in the file's own settings, a blank is put before the text, nothing is
normalised, and characters outside the vocabulary become byte pieces. The mark
itself, if it stands in a text, becomes byte pieces as well, so decoding gives
back every text exactly.

Defined cases: null text has null ids and null again after decoding; an empty
text has none; every row is encoded for itself; an empty table gives no rows;
all columns stay, ``ids`` (``exact``, ``decoded``) replaces one of its name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from relayplan.llm.blocks import combine, mix, pack, tidy, unpack, word_codes
from relayplan.llm.common import aside, kept

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x2581  # stands for a blank in the pieces
LITERAL = 0x110000  # the mark itself in a text: in no piece
SCALE = 1 << 30
UNKNOWN_PENALTY = 10.0
GIANT = 65_536
CHUNK = 16_384
SHORT = 48  # segments up to this length are solved in lockstep
GROUP = 1 << 18  # characters of segments solved at once
PIECE_CHARS = 1 << 20  # characters of documents worked on at once
LOW = -(1 << 61)
NONE, UNKNOWN = -2, -1


@dataclass
class Vocabulary:
    """Pieces as a table of the fingerprints of all their prefixes."""

    slots: np.ndarray  # fingerprints, 0 where free
    values: np.ndarray  # piece id of a slot, ``NONE`` for a mere prefix
    weight: np.ndarray  # by id; the last but one: none, the last: unknown
    longest: int
    byte_ids: np.ndarray
    cuts: bool  # the mark stands only at the start of pieces
    piece_bytes: np.ndarray
    piece_bounds: np.ndarray

    @classmethod
    def of(cls, pieces: list[tuple[int, str, float]], byte_ids: dict[int, int], size: int) -> Vocabulary:
        weight = np.full(size + 2, LOW, np.int64)
        least = min((s for _, _, s in pieces), default=0.0)
        prefixes: dict[int, int] = {}
        for i, text, score in pieces:
            weight[i] = round(score * SCALE) + int(mix(np.array([i + 1], np.uint64))[0] & np.uint64(0xFF))
            codes = np.array([ord(c) for c in text], np.uint64)
            f = _start(codes[:1])
            for n in range(1, len(codes) + 1):
                if n > 1:
                    f = combine(f, _item(codes[n - 1:n]))
                prefixes.setdefault(int(f[0]), NONE)
            prefixes[int(f[0])] = i
        weight[-1] = round((least - UNKNOWN_PENALTY) * SCALE)
        bits = max(4, int(np.ceil(np.log2(max(1, len(prefixes)) * 3))))
        slots, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, NONE, np.int32)
        for f, i in prefixes.items():
            at = f >> (64 - bits)
            while slots[at]:
                at = (at + 1) % len(slots)
            slots[at], values[at] = f, i
        text = [b""] * size
        for i, t, _ in pieces:
            text[i] = t.replace(chr(MARK), " ").encode()
        for b, i in byte_ids.items():
            text[i] = bytes([b])
        cuts = all(chr(MARK) not in t.lstrip(chr(MARK)) for _, t, _ in pieces)
        return cls(slots, values, weight, max((len(t) for _, t, _ in pieces), default=1),
                   np.array([byte_ids.get(b, 0) for b in range(256)], np.int32), cuts,
                   np.frombuffer(b"".join(text), np.uint8),
                   np.concatenate(([0], np.cumsum([len(t) for t in text]))).astype(np.int64))

    def find(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which fingerprints are prefixes, and their piece ids."""
        shift = np.uint64(64 - int(np.log2(len(self.slots))))
        at = (f >> shift).astype(np.int64)
        known, value = np.zeros(len(f), bool), np.full(len(f), NONE, np.int32)
        todo = np.arange(len(f))
        while len(todo):
            slot = self.slots[at[todo]]
            hit = slot == f[todo]
            known[todo[hit]] = True
            value[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (slot != 0)]
            at[todo] = (at[todo] + 1) % len(self.slots)
        return known, value


def _item(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + np.uint64(0x51ED270B))


def _start(codes: np.ndarray) -> np.ndarray:
    return mix(_item(codes)) | np.uint64(1)


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a public model file, read on the driver."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte_ids = [], {}
    for i in range(m.get_piece_size()):
        text = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(text[1:-1], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            normal.append((i, text, m.get_score(i)))
    if all(float(s).is_integer() for _, _, s in normal):
        order = sorted(range(len(normal)), key=lambda k: (-normal[k][2], normal[k][0]))
        normal = [(*normal[k][:2], -math.log(rank + 2)) for rank, k in enumerate(order)]
    return Vocabulary.of(normal, byte_ids, m.get_piece_size())


def to_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each with a blank before it (an empty one has
    none), blanks as marks; and the texts' bounds."""
    codes = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le"), np.uint32).copy()
    codes[codes == MARK] = LITERAL
    codes[codes == 32] = MARK
    return codes, np.concatenate(([0], np.cumsum([len(t) + 1 if t else 0 for t in texts]))).astype(np.int64)


def piece_matrix(v: Vocabulary, codes: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """``[length - 1, start]``: id of the piece there, if it ends by ``limit``."""
    out = np.full((v.longest, len(codes)), NONE, np.int32)
    at = np.arange(len(codes))
    f = _start(codes)
    item = _item(codes)
    for n in range(1, v.longest + 1):
        if n > 1:
            inside = at + n <= limit[at]
            at, f = at[inside], f[inside]
            f = combine(f, item[at + n - 1])
        known, value = v.find(f)
        at, f = at[known], f[known]
        out[n - 1, at] = value[known]
        if not len(at):
            break
    out[0, out[0] == NONE] = UNKNOWN
    return out


def weights(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    return v.weight[np.where(ids == NONE, len(v.weight) - 2, np.where(ids == UNKNOWN, len(v.weight) - 1, ids))]


def solve_short(v: Vocabulary, codes: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """Best pieces of many segments in lockstep, longest segments first.
    Returns segment, start and id of each piece, in order, and the totals."""
    limit = np.zeros(len(codes), np.int64)
    limit[:] = np.repeat(begin + size, size)
    ids = piece_matrix(v, codes, limit)
    lanes = len(begin)
    longest = int(size.max(initial=0))
    best = np.full((longest + 1, lanes), LOW, np.int64)
    step = np.zeros((longest + 1, lanes), np.uint8)
    best[0] = 0
    counts = np.searchsorted(-size, -np.arange(longest + 1), "right")
    for end in range(1, longest + 1):
        m = counts[end]  # segments that reach so far
        for n in range(min(end, v.longest), 0, -1):
            got = best[end - n, :m] + weights(v, ids[n - 1, begin[:m] + end - n])
            better = got > best[end, :m]
            best[end, :m][better] = got[better]
            step[end, :m][better] = n
    who, start, found = [], [], []
    lane, at = np.arange(lanes), size.copy()
    while len(lane):
        n = step[at, lane].astype(np.int64)
        at = at - n
        who.append(lane)
        start.append(at)
        found.append(ids[n - 1, begin[lane] + at])
        lane, at = lane[at > 0], at[at > 0]
    who, start, found = (np.concatenate(x) for x in (who, start, found)) if who else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
    by = np.lexsort((start, who))
    return who[by], start[by], found[by], best[size, np.arange(lanes)]


def scan_long(v: Vocabulary, codes: np.ndarray, stop: int, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores from each of the first ``entries`` places to every place; pieces
    start before ``stop`` and end within ``codes``. Also the piece matrix."""
    ids = piece_matrix(v, codes, np.full(len(codes), len(codes)))
    ids[:, stop:] = NONE
    w = weights(v, ids)
    best = np.full((len(codes) + 1, entries), LOW, np.int64)
    for s in range(min(entries, len(best))):
        best[s, s] = 0
    lengths = np.arange(1, v.longest + 1)
    for end in range(1, len(codes) + 1):
        n = lengths[:min(end, v.longest)]
        got = (best[end - n] + w[n - 1, end - n][:, None]).max(axis=0)
        best[end] = np.maximum(best[end], np.maximum(got, LOW))
    return best, ids


def solve_long(v: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Best pieces of one long segment: starts, ids, total."""
    best, ids = scan_long(v, codes, len(codes), 1)
    w, best = weights(v, ids), best[:, 0]
    at, start, found = len(codes), [], []
    while at > 0:
        n = np.arange(min(at, v.longest), 0, -1)
        n = int(n[(best[at - n] + w[n - 1, at - n]).argmax()])
        at -= n
        start.append(at)
        found.append(int(ids[n - 1, at]))
    return np.array(start[::-1], np.int64), np.array(found[::-1], np.int32), int(best[-1])


def borders(v: Vocabulary, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the segments: of texts, and of runs of blanks."""
    start = np.zeros(len(codes), bool)
    start[bounds[:-1][bounds[:-1] < len(codes)]] = True
    if v.cuts:
        mark = codes == MARK
        start[1:] |= mark[1:] & ~mark[:-1]
    return np.flatnonzero(start)


def expand(v: Vocabulary, ids: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with unknown characters as bytes, and how many each gives."""
    unknown = ids == UNKNOWN
    c = np.where(code == LITERAL, MARK, code).astype(np.int64)
    n = np.where(unknown, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000), 1)
    out = np.repeat(ids, n)
    if unknown.any():
        place = np.arange(len(out)) - np.repeat(np.cumsum(n) - n, n)
        own = np.repeat(unknown, n)
        c, size, place = np.repeat(c, n)[own], np.repeat(n, n)[own], place[own]
        tail = 0x80 | ((c >> (6 * (size - 1 - place))) & 0x3F)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size] | (c >> (6 * (size - 1)))
        out[own] = v.byte_ids[np.where(place == 0, lead, tail)]
    return out, n


def solve(v: Vocabulary, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, each text's number of ids, and
    its total weight."""
    begin = borders(v, codes, bounds)
    if not len(begin):
        z = np.zeros(len(bounds) - 1, np.int64)
        return np.zeros(0, np.int32), z, z
    size = np.diff(np.append(begin, len(codes)))
    _, first, same = np.unique(word_codes(codes, begin, begin + size), return_index=True, return_inverse=True)
    d_begin, d_size = begin[first], size[first]
    parts, total = [], np.zeros(len(first), np.int64)
    order = np.argsort(-d_size, kind="stable")
    long = order[:np.searchsorted(-d_size[order], -SHORT, "left")]
    for i in long.tolist():
        own = codes[d_begin[i]:d_begin[i] + d_size[i]]
        start, ids, total[i] = solve_long(v, own)
        parts.append((np.full(len(ids), i), ids, own[start]))
    order = order[len(long):]
    for group in np.split(order, np.flatnonzero(np.diff(np.cumsum(d_size[order]) // GROUP)) + 1):
        if not len(group):
            continue
        n = d_size[group]
        local = np.cumsum(n) - n
        own = codes[np.repeat(d_begin[group] - local, n) + np.arange(int(n.sum()))]
        who, start, ids, total[group] = solve_short(v, own, local, n)
        parts.append((group[who], ids, own[local[who] + start]))
    who, ids, code = (np.concatenate(x) for x in zip(*parts, strict=True))
    ids, n = expand(v, ids, code)
    who = np.repeat(who, n)
    # pieces of a distinct segment are consecutive and in order; lay them out per segment
    by = np.argsort(who, kind="stable")
    ids, counts = ids[by], np.bincount(who, minlength=len(first))
    at = np.cumsum(counts) - counts
    n = counts[same]
    out = ids[np.repeat(at[same], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
    text = np.searchsorted(bounds, begin, "right") - 1
    per = np.zeros(len(bounds) - 1, np.int64)
    np.add.at(per, text, n)
    scores = np.zeros(len(bounds) - 1, np.int64)
    np.add.at(scores, text, total[same])
    return out, per, scores


def encode_texts(v: Vocabulary, texts: list) -> list:
    """Ids of each text; ``None`` for null."""
    out, at = [None] * len(texts), 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to] or "") <= PIECE_CHARS):
            chars += len(texts[to] or "")
            to += 1
        some = [t if isinstance(t, str) else "" for t in texts[at:to]]
        ids, per, _ = solve(v, *to_codes(some))
        for i, part in enumerate(np.split(ids, np.cumsum(per)[:-1])):
            out[at + i] = part if isinstance(texts[at + i], str) else None
        at = to
    return out


def decode_ids(v: Vocabulary, rows: list) -> list:
    """Texts of rows of ids: the pieces' bytes without the blank before."""
    out = []
    for ids in rows:
        if ids is None:
            out.append(None)
            continue
        ids = np.asarray(ids, np.int64)
        n = v.piece_bounds[ids + 1] - v.piece_bounds[ids]
        place = np.repeat(v.piece_bounds[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out.append(v.piece_bytes[place].tobytes().decode("utf-8", "replace")[1:])
    return out


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of matrices over (max, +), one after the other."""
    return np.maximum((a[..., :, :, None] + b[..., None, :, :]).max(axis=-2), LOW)


def prefix_products(t: np.ndarray) -> np.ndarray:
    """``t[0]``, ``t[0] t[1]``, ... by doubling: the product is associative."""
    out, step = t.copy(), 1
    while step < len(out):
        out[step:] = max_plus(out[:-step], out[step:])
        step *= 2
    return out


def transfer(v: Vocabulary, codes: np.ndarray, chunk: int, cut: bool) -> np.ndarray:
    """Transfer matrix of a chunk: ``codes`` holds its ``chunk`` characters and
    those a piece may reach into; ``cut``: all paths meet at its start."""
    states = v.longest
    out = np.full((states, states), LOW, np.int64)
    meets = np.zeros(len(codes) + 1, bool)
    if v.cuts and len(codes):
        mark = codes == MARK
        meets[1:-1] = mark[1:] & ~mark[:-1]
        meets[0] = cut
    inside = np.flatnonzero(meets[:chunk])
    if not len(inside):
        best, _ = scan_long(v, codes, chunk, states)
        end = best[chunk:chunk + states]
        out[:, :len(end)] = end.T
        return out
    first, last = int(inside[0]), int(inside[-1])
    head, _ = scan_long(v, codes[:first], first, states)
    _, _, middle = solve(v, codes[first:last], np.array([0, last - first]))
    ahead = np.flatnonzero(meets[chunk:]) + chunk  # no piece goes on over a meeting place
    tail = codes[last:int(ahead[0]) if len(ahead) else len(codes)]
    best, _ = scan_long(v, tail, chunk - last, 1)
    end = best[chunk - last:chunk - last + states, 0]
    start = head[first][:first + 1]
    out[:len(start), :len(end)] = start[:, None] + int(middle[0]) + end[None, :]
    out[out < LOW // 2] = LOW
    return out


def split_chunks(v: Vocabulary):
    """Giant texts as chunks, each with one character before and the reach of
    a piece after it."""
    def run(batches):
        for b in batches:
            for row, text in zip(b["_row"], b["text"], strict=True):
                text = " " + text
                yield pd.DataFrame([(row, k // CHUNK, text[max(0, k - 1):k + CHUNK + v.longest - 1], len(text) - k)
                                    for k in range(0, len(text), CHUNK)], columns=["_row", "chunk", "part", "left"])
    return run


def chunk_codes(part: str, chunk: int) -> tuple[np.ndarray, bool]:
    """A chunk's characters without the one before; do all paths meet there?"""
    codes = np.frombuffer(part.encode("utf-32-le"), np.uint32).copy()
    codes[codes == MARK] = LITERAL
    codes[codes == 32] = MARK
    if not chunk:
        return codes, True
    return codes[1:], bool(codes[1] == MARK and codes[0] != MARK)


def matrices(v: Vocabulary):
    def run(batches):
        for b in batches:
            out = []
            for row, chunk, part, left in b.itertuples(index=False):
                codes, cut = chunk_codes(part, chunk)
                out.append((row, chunk, pack(transfer(v, codes, min(CHUNK, left), cut).ravel())))
            yield pd.DataFrame(out, columns=["_row", "chunk", "data"])
        tidy()
    return run


def states(v: Vocabulary):
    """Best state at each border of a giant text, from all its matrices."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        t = np.stack([unpack(d)[0].reshape(v.longest, v.longest) for d in pdf["data"]])
        before = prefix_products(t)[:, 0, :]
        enter, leave = np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
        for k in range(len(t) - 1, 0, -1):  # of equal paths, one and the same at all borders
            enter[k] = leave[k - 1] = (before[k - 1] + t[k][:, leave[k]]).argmax()
        return pd.DataFrame({"_row": pdf["_row"], "chunk": pdf["chunk"], "enter": enter, "leave": leave})
    return run


def trace_chunks(v: Vocabulary):
    def run(batches):
        for b in batches:
            out = []
            for row, chunk, part, left, enter, leave in b.itertuples(index=False):
                codes, _ = chunk_codes(part, chunk)
                codes = codes[enter:min(CHUNK, left) + leave]
                ids, _, _ = solve(v, codes, np.array([0, len(codes)]))
                out.append((row, chunk, ids))
            yield pd.DataFrame(out, columns=["_row", "chunk", "ids"])
        tidy()
    return run


IDS = StructField("ids", ArrayType(IntegerType()))
EXACT = StructField("exact", BooleanType())
DECODED = StructField("decoded", StringType())


def encode(docs: DataFrame, v: Vocabulary, giant: int = GIANT, check: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the pieces of ``text``; with ``check`` also
    ``exact``: does decoding them, in the same pass, give back the text?"""
    more = [IDS, EXACT] if check else [IDS]
    own = [c for c in docs.columns if c not in {f.name for f in more}]
    docs, back = aside(docs.select(*own), "text")
    size = F.coalesce(F.length("text"), F.lit(0))

    def run(batches):
        for b in batches:
            texts = b["text"].tolist()
            ids = encode_texts(v, texts)
            yield b.assign(ids=ids, exact=same_texts(v, ids, texts)) if check else b.assign(ids=ids)

    def compare(batches):
        for b in batches:
            yield b.assign(exact=same_texts(v, b["ids"].tolist(), b["text"].tolist()))

    short = over_python(docs.filter(size <= giant), run, *more)
    long = kept(docs.filter(size > giant).withColumn("_row", F.monotonically_increasing_id()))
    chunks = kept(long.select("_row", "text").mapInPandas(
        split_chunks(v), "_row long, chunk int, part string, left long"))
    border = (chunks.mapInPandas(matrices(v), "_row long, chunk int, data binary")
              .groupBy("_row").applyInPandas(states(v), "_row long, chunk int, enter int, leave int"))
    traced = (chunks.join(border, ["_row", "chunk"]).select("_row", "chunk", "part", "left", "enter", "leave")
              .mapInPandas(trace_chunks(v), "_row long, chunk int, ids array<int>"))
    whole = traced.groupBy("_row").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    coded = long.join(whole, "_row").drop("_row")
    return back(short.unionByName(over_python(coded, compare, EXACT) if check else coded), *[f.name for f in more])


def same_texts(v: Vocabulary, ids: list, texts: list) -> list[bool]:
    return [a == (t if isinstance(t, str) else None) for a, t in zip(decode_ids(v, ids), texts, strict=True)]


def decode(encoded: DataFrame, v: Vocabulary) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``."""
    def run(batches):
        for b in batches:
            yield b.assign(decoded=decode_ids(v, b["ids"].tolist()))

    return over_python(encoded.drop("decoded"), run, DECODED)


def over_python(df: DataFrame, run, *fields: StructField) -> DataFrame:
    """``mapInPandas`` that adds columns; integers travel as text, since
    pandas would make them floats where they are null."""
    as_text = [F.col(c).cast("string").alias(c) if t in ("bigint", "int") else F.col(c) for c, t in df.dtypes]
    schema = StructType([StructField(f.name, StringType() if t in ("bigint", "int") else f.dataType)
                         for f, (_, t) in zip(df.schema, df.dtypes, strict=True)] + list(fields))

    def tidied(batches):
        yield from run(batches)
        tidy()

    got = df.select(*as_text).mapInPandas(tidied, schema)
    return got.select(*[F.col(c).cast(t).alias(c) for c, t in df.dtypes], *[f.name for f in fields])
