"""Periodic runs of words within each text, found by an online sparse dynamic program over diagonals.

A diagonal is a lag q between a word and an earlier occurrence of it. Going through the words, every active lag whose earlier
word is equal gains one word of match length; one whose earlier word differs ends, and gives a run at once if it is long enough.

Which earlier occurrences are followed: all of them would be the square of a frequent word's count. A run of smallest period q has
the words of any stretch of g words, q <= g < 2q, repeated q words before and nowhere nearer: a nearer copy would give the stretch
a smaller period. So a lag opens where a stretch of g = 1, 2, 4, … words has its nearest copy at a lag over g / 2 and up to
g, and it then has matched g words exactly. Lags of multiples of a smaller period never open. Stretches are told apart by
ranks, doubled from level to level and kept only where they repeat near by, so nothing rests on hashes.

Null texts have no words. A very long text is one row's work, in memory that grows with its words; rows repeated are judged each by
itself; an empty table gives an empty one; input columns named as a result give way. Nothing is cut off or sampled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

#: Words that are looked at together, unless one text has more.
BATCH_WORDS = 1 << 19
RUN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False), T.StructField("period", T.LongType(), False)])


def openings(texts: list[list], min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """For each text, given as a list of words, the (word number, lag, words matched so far) at which a diagonal opens, by word number."""
    out: list[list] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return out
    flat = np.empty(total, dtype=np.int64)
    at = n_ids = 0
    starts = np.zeros(len(texts), dtype=np.int64)
    np.cumsum(sizes[:-1], out=starts[1:])
    for words in texts:
        seen: dict = {}
        flat[at : at + len(words)] = [seen.setdefault(w, len(seen)) for w in words]
        flat[at : at + len(words)] += n_ids
        at, n_ids = at + len(words), n_ids + len(seen)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    limit = (sizes // min_exponent)[text_of]
    where, rank, g = np.arange(total), flat, 1
    while len(where):
        order = np.argsort(rank, kind="stable")
        r, p = rank[order], where[order]
        lag = p[1:] - p[:-1]
        near = (r[1:] == r[:-1]) & (lag <= limit[p[1:]])
        hit = near & (2 * lag > g) & (lag <= g)
        if hit.any():
            i, q = p[1:][hit], lag[hit]
            by = np.lexsort((i, q))
            i, q = i[by], q[by]
            fresh = np.ones(len(i), dtype=bool)
            fresh[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1] + 1)
            for x, lag_ in zip(i[fresh].tolist(), q[fresh].tolist(), strict=True):
                t = int(text_of[x])
                out[t].append((x - int(starts[t]), lag_, g))
        if g >= limit.max():
            break
        alive = np.zeros(len(p), dtype=bool)
        alive[1:] |= near
        alive[:-1] |= near
        group = np.concatenate(([0], np.cumsum(r[1:] != r[:-1])))
        ranks = np.full(total, -1, dtype=np.int64)
        ranks[p[alive]] = group[alive]
        ends = np.flatnonzero(ranks >= 0)
        ends = ends[ends >= g]
        ends = ends[(text_of[ends - g] == text_of[ends]) & (ranks[ends - g] >= 0)]
        where, rank, g = ends, ranks[ends - g] * (int(group[-1]) + 1) + ranks[ends], 2 * g
    for opened in out:
        opened.sort()
    return out


def runs(words: list, opened: list[tuple[int, int, int]], min_words: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text, by start and period: the walk over its words."""
    found: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}

    def end(q: int, i: int) -> None:
        length = active.pop(q) + q
        if length >= max(min_words, min_exponent * q):
            found.append((i - length, length, q))

    i = k = 0
    while k < len(opened) or active:
        if not active:
            i = opened[k][0]
        if i == len(words):
            break
        w = words[i]
        for q in list(active):
            if words[i - q] == w:
                active[q] += 1
            else:
                end(q, i)
        while k < len(opened) and opened[k][0] == i:
            active.setdefault(opened[k][1], opened[k][2])
            k += 1
        i += 1
    for q in list(active):
        end(q, len(words))
    found.sort(key=lambda x: (x[0], x[2]))
    return found


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that a run holds after its first period."""
    if not found:
        return b" ".join(words)
    gone = bytearray(len(words))
    for start, length, q in found:
        gone[start + q : start + length] = b"\1" * (length - q)
    return b" ".join(w for w, out in zip(words, gone, strict=True) if not out)


def find(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, min_words: int = 6, min_exponent: int = 4, rewrite: Callable | None = None, rewrite_by: str | None = None) -> DataFrame:
    """``keep`` columns (all but the text unless given), ``runs`` (array of start, length, period) and ``collapsed`` of every text.

    A run is a stretch of at least ``min_words`` words and ``min_exponent`` periods, of smallest period q, that neither neighbour extends. Words are
    split at ASCII white space. ``rewrite`` makes other words of the value of ``rewrite_by`` and a text's words before they are searched.
    """
    if min_exponent < 3:
        raise ValueError("runs are found from three periods on")
    keep = [c for c in (keep or df.columns) if c not in ("runs", "collapsed", text_col)]
    out = T.StructType([df.schema[c] for c in keep] + [T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.BinaryType(), False)])
    by = F.col(base.quoted(rewrite_by)) if rewrite_by else F.lit(None).cast("string")
    src = df.select(*[F.col(base.quoted(c)) for c in keep], F.col(base.quoted(text_col)).cast("binary").alias("__text__"), by.alias("__by__"))
    n, names = len(keep), [*keep, "runs", "collapsed"]
    kind = pa.list_(pa.struct([pa.field(f.name, pa.int64(), nullable=False) for f in RUN]))

    def part(batch, lo, hi, texts):
        found = [runs(words, opened, min_words, min_exponent) if opened else [] for words, opened in zip(texts, openings(texts, min_exponent), strict=True)]
        left = [collapsed(words, f) for words, f in zip(texts, found, strict=True)]
        rows = [[{"start": s, "length": size, "period": q} for s, size, q in f] for f in found]
        return pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(n)], pa.array(rows, kind), pa.array(left, pa.binary())], names=names)

    def run(batches):
        for b in batches:
            texts, lo, size = [], 0, 0
            ids = b.column(n + 1).to_pylist()
            for i in range(b.num_rows):
                words = (b.column(n)[i].as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(ids[i], words)
                if texts and size + len(words) > BATCH_WORDS:
                    yield part(b, lo, i, texts)
                    texts, lo, size = [], i, 0
                texts.append(words)
                size += len(words)
            if texts:
                yield part(b, lo, b.num_rows, texts)

    return src.mapInArrow(run, out).withColumn("collapsed", F.col("collapsed").cast("string"))
