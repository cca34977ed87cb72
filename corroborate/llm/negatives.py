"""Hard negatives for anchors, by a secondary-sort shuffle.

Scores of anchors against all rows are computed in cells: a block of anchors by a slice of rows. Each cell hands on, for every anchor,
its first positives; the best scores among them bound the windows, and a second pass over the cells hands on, for every window, its
first negatives of the cell. So a few pairs of an anchor and cell are shuffled and none that counts is lost. They are packed
into keys (anchor, descending score, positives first, id); repartitionAndSortWithinPartitions puts an anchor's keys in order, and
an iterator goes through them once: a positive opens a window, negatives that fit are emitted, a score below a window closes it. No anchor is
ever held as a whole.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows of one id count once: the one of least label,
then least vector. Vectors of unequal length are filled up with zeros. Scores beyond a long are cut to its ends. Equal scores
go by id. Tables without rows or anchors give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

#: A cell has about so many rows and anchors: the bound of what one task holds.
CELL_ROWS, CELL_ANCHORS = 4096, 8192
#: Scores that are looked at together in a cell.
BLOCK_SCORES = 1 << 21
KEY, KEY_BYTES = ">QQBQ", 25
FLIP, LEAST, MOST = 1 << 63, -(1 << 63), (1 << 63) - 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(df: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, one an id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(base.quoted(id_col)).cast("long").alias("id"), label.cast("long").alias("label"), F.col(base.quoted(vector_col)).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(~bad)
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """floor(256 x) of each component, as doubles."""
    out = np.zeros((len(lists), width))
    values = pa.concat_arrays(lists.chunks).flatten().to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0)
    sizes = np.array([len(x) for x in lists], dtype=np.int64) if len(lists) else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(out * 256.0))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, LEAST, MOST).astype(np.int64)


def _firsts(of: np.ndarray, k: int) -> np.ndarray:
    """Which of the entries of a grouped array are among the first k of their group."""
    new = np.ones(len(of), dtype=bool)
    new[1:] = of[1:] != of[:-1]
    begun = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
    return np.arange(len(of)) - begun < k


def _cell(anchors: pa.Table, rows: pa.Table):
    """Blocks of (anchor numbers, scores, same label) of a cell, and the ids of its rows."""
    rows = rows.sort_by("id")
    width = max([0, *(len(x) for t in (anchors, rows) for x in t.column("vector"))])
    a, b = _matrix(anchors.column("vector"), width), _matrix(rows.column("vector"), width)
    ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
    own, own_labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
    step = max(1, BLOCK_SCORES // max(1, len(ids)))

    def blocks():
        for lo in range(0, len(own), step):
            at = np.arange(lo, min(lo + step, len(own)))
            yield at, _scores(a[at], b), own_labels[at][:, None] == labels[None, :], own[at][:, None] == ids[None, :]

    return own, ids, blocks()


def _pairs(schema: list[str], parts: list[tuple]) -> pa.Table:
    cols = [np.concatenate(c) if parts else np.zeros(0, dtype=np.int64) for c in (zip(*parts, strict=True) if parts else [[]] * len(schema))]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(schema, cols, strict=True)})


def _first_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, ids, blocks = _cell(anchors, rows)
        parts = []
        for at, s, same, self in blocks:
            fits = same & ~self
            if s.shape[1] > k:
                masked = np.where(fits, s, LEAST)
                fits &= s >= np.partition(masked, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]
            i, j = np.nonzero(fits)
            by = np.lexsort((j, -s[i, j], i))
            by = by[_firsts(i[by], k)]
            parts.append((own[at[i[by]]], s[i, j][by], ids[j[by]]))
        return _pairs(["anchor_id", "score", "id"], parts)

    return run


def _first_negatives(k: int, low: int, scale: int):
    """Anchors come with ``best``, their positives' scores; those that no window needs are left out."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        anchors = anchors.filter(pa.compute.list_value_length(anchors.column("best")).to_numpy(zero_copy_only=False) > 0)
        own, ids, blocks = _cell(anchors, rows)
        best = anchors.column("best").to_pylist()
        n = max([1, *map(len, best)])
        high = np.array([[*b, *[LEAST] * (n - len(b))] for b in best], dtype=np.int64).reshape(-1, n)
        least = np.array([[*[min(MOST, max(LEAST, -((-low * x) // scale))) for x in b], *[MOST] * (n - len(b))] for b in best], dtype=np.int64).reshape(-1, n)
        least = np.where(least <= high, least, MOST)
        parts = []
        for at, s, same, self in blocks:
            i, j = np.nonzero(~same & ~self & (s <= high[at].max(axis=1)[:, None]) & (s >= least[at].min(axis=1)[:, None]))
            by = np.lexsort((j, -s[i, j], i))
            i, j = i[by], j[by]
            x, taken = s[i, j], np.zeros(len(i), dtype=bool)
            for w in range(n):
                fits = np.flatnonzero((x <= high[at[i], w]) & (x >= least[at[i], w]))
                taken[fits[_firsts(i[fits], k)]] = True
            parts.append((own[at[i[taken]]], x[taken], ids[j[taken]]))
        return _pairs(["anchor_id", "score", "id"], parts)

    return run


def _packed(kind: int):
    """Keys whose order as bytes is that of (anchor, descending score, kind, id)."""

    def run(batches):
        for b in batches:
            a, s, x = (np.asarray(b.column(i).to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64) for i in range(3))
            out = np.empty((len(a), KEY_BYTES), dtype=np.uint8)
            big = lambda v: np.ascontiguousarray(v.astype(">u8")).view(np.uint8).reshape(-1, 8)
            out[:, :8], out[:, 8:16], out[:, 16], out[:, 17:] = big(a ^ np.uint64(FLIP)), big(~(s ^ np.uint64(FLIP))), kind, big(x ^ np.uint64(FLIP))
            ends = np.arange(0, out.size + 1, KEY_BYTES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])], names=["key"])

    return run


def _windows(n_positives: int, n_negatives: int, low: int, scale: int):
    """The iterator over keys in order."""

    def run(keys):
        anchor, opened, seen = None, [], 0
        for key, _ in keys:
            a, s, kind, x = struct.unpack(KEY, key)
            a, s, x = a - FLIP, (s ^ (2 * FLIP - 1)) - FLIP, x - FLIP
            if a != anchor:
                anchor, opened, seen = a, [], 0
            if kind == 0:
                if seen < n_positives:
                    seen += 1
                    opened.append([x, s, 0])
                continue
            opened = [w for w in opened if w[2] < n_negatives and low * w[1] <= scale * s]
            for w in opened:
                w[2] += 1
                yield anchor, w[0], w[2], x, w[1], s

    return run


def mine(df: DataFrame, id_col: str, label: Column, vector_col: str, anchors: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, scale: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` tells the anchors by ``id``. Of each, the first ``n_positives`` other rows of its label are positives, and of each of those the first
    ``n_negatives`` rows of another label with low/scale x positive score <= score <= positive score are its hard negatives.
    """
    spark = df.sparkSession
    rows = base.materialised(usable(df, id_col, label, vector_col))
    n, n_anchors = rows.agg(F.count("*"), F.count_if(anchors)).first()
    blocks, slices = -(-max(1, n_anchors) // CELL_ANCHORS), -(-max(1, n) // CELL_ROWS)
    part = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    cell = lambda block, piece: block * F.lit(slices) + piece
    sliced = rows.withColumn("piece", part(slices, 1)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select("id", "label", "vector", cell(F.col("block"), F.col("piece")).alias("cell"))
    asked = rows.filter(anchors).withColumn("block", part(blocks, 2)).select(*[F.col(c).alias(c) for c in ("id", "label", "vector", "block")])

    def over_cells(asked: DataFrame, fn) -> DataFrame:
        spread = asked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))).withColumn("cell", cell(F.col("block"), F.col("piece"))).drop("block", "piece")
        return spread.groupBy("cell").cogroup(sliced.groupBy("cell")).applyInArrow(fn, "anchor_id long, score long, id long")

    positives = base.materialised(over_cells(asked, _first_positives(n_positives)))
    ranked = positives.withColumn("r", F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))).filter(F.col("r") <= n_positives)
    best = ranked.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("best"))
    negatives = base.materialised(over_cells(asked.join(best, "id"), _first_negatives(n_negatives, low, scale)))
    base.dropped(rows)
    keys = positives.mapInArrow(_packed(0), "key binary").union(negatives.mapInArrow(_packed(1), "key binary"))
    ordered = keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(int(spark.conf.get("spark.sql.shuffle.partitions")), lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(ordered.mapPartitions(_windows(n_positives, n_negatives, low, scale)), RESULT)


def oracle(table: str = "embeddings") -> str:
    """DuckDB SQL of the query over ``embeddings``: every pair of an anchor and a row is scored."""
    return f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM {table} WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
