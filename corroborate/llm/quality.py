"""Quality scores by nearest-neighbour voting in a latent space.

Terms are words (lower-cased, hashed), character-shape trigrams (lower, upper, digit, space, mark as itself) and repeats of the last two words. Terms
are weighted, centred and projected by a truncated singular value decomposition fitted on a bounded, hash-picked sample of
labelled texts. The sample's vectors (``per_class`` x 2 rows of ``rank`` numbers) are broadcast; every text gets its exact
cosine against all of them in blocks, and the ``k`` nearest (ties included) vote, weighted by similarity and by how far
the sample's class shares differ from the labelled table's.

Edge cases: null and empty texts score like a text without terms (the mean of the labels); with no labelled rows or a
single class every score is that class's share (0.5 for none); repeated rows and extra columns do not matter; of several texts with
one labelled id the least one is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

BINS = 2048  # of shapes
WORDS = 2048  # of words
DIMS = BINS + WORDS + 2


def _shapes(codes: np.ndarray) -> np.ndarray:
    low = base.lowered(codes)
    letter = base.is_letter(codes)
    out = np.where(letter, np.where(low != codes, 65, 97), codes).astype(np.uint32)
    out[(codes >= 48) & (codes <= 57)] = 48
    return out


def term_shares(texts: list[str]) -> np.ndarray:
    """Square roots of the terms' shares, a row for each text."""
    codes, starts = base.char_codes(texts)
    size = np.diff(starts)
    n = len(texts)
    s = _shapes(codes)
    last, feed = starts[1:] - 1, np.uint32(10)
    one, two = np.append(s[1:], feed), np.append(s[2:], [feed, feed])[: len(s)]
    one[last] = two[last] = two[last - 1] = feed  # trigrams do not reach into the next text
    h = s * np.uint32(0x9E3779B1) ^ one * np.uint32(0x85EBCA6B) ^ two * np.uint32(0xC2B2AE35)
    bins = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(21)).astype(np.int64)
    doc = np.repeat(np.arange(n), size)
    counts = np.bincount(doc * BINS + bins, minlength=n * BINS).reshape(n, BINS) / np.maximum(size, 1)[:, None]
    first, end = base.runs(codes > 32)
    out = np.zeros((n, DIMS))
    out[:, :BINS] = counts
    if len(first):
        length = end - first
        at = np.flatnonzero(codes > 32)
        inside = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
        word = np.add.reduceat(base.mixed(codes[at].astype(np.uint64) * np.uint64(0x100000001B3) + inside.astype(np.uint64)), np.cumsum(length) - length)
        of = doc[first]
        words = np.maximum(np.bincount(of, minlength=n), 1)
        spelt = np.add.reduceat(base.mixed(base.lowered(codes[at]).astype(np.uint64) * np.uint64(0x100000001B3) + inside.astype(np.uint64)), np.cumsum(length) - length)
        which = (base.mixed(spelt) >> np.uint64(53)).astype(np.int64)
        out[:, BINS : BINS + WORDS] = np.bincount(of * WORDS + which, minlength=n * WORDS).reshape(n, WORDS) / words[:, None]
        for lag in (1, 2):
            same = (word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])
            out[:, BINS + WORDS + lag - 1] = np.bincount(of[lag:][same], minlength=n) / words
    out[np.array([not t for t in texts], dtype=bool)] = 0
    return np.sqrt(out).astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray
    mean: np.ndarray
    project: np.ndarray  # DIMS x rank
    vectors: np.ndarray  # labelled, of length 1: rank x rows
    labels: np.ndarray
    weights: np.ndarray
    prior: float
    k: int

    def latent(self, shares: np.ndarray) -> np.ndarray:
        z = (shares * self.idf - self.mean) @ self.project
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 1500, rank: int = 48, k: int = 25) -> Model:
    """Learn from about ``per_class`` labelled texts of each class. ``labels`` holds (id, 0/1); repeated ids count once."""
    marked = labels.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(label_col)).cast("int").alias("y")).filter("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    sample, sizes = base.bounded_sample(marked, "y", per_class, ["k"])
    texts = docs.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(text_col)).alias("t"))

    def shares(batches):
        for b in batches:
            t = [x or "" for x in b.column(0).to_pylist()]
            for lo, hi in base.chunks(t):
                rows = term_shares(t[lo:hi])
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array([r.astype("<f2").tobytes() for r in rows], pa.binary())], names=["y", "k", "x"])

    # The sample holds at most 2 x per_class ids of each label, a hard bound, and reaches the driver as 8 KB a row.
    one = texts.join(F.broadcast(sample), "k").groupBy("k", "y").agg(F.min("t").alias("t"))
    got = one.select("t", "y", F.col("k").cast("string").alias("k")).mapInArrow(shares, "y int, k string, x binary").toPandas().sort_values(["k", "x"]) if sizes else None
    prior = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.5
    if got is None or not len(got) or got["y"].nunique() < 2:
        prior = float(got["y"].mean()) if got is not None and len(got) else prior
        return Model(np.zeros(DIMS, np.float32), np.zeros(DIMS, np.float32), np.zeros((DIMS, 1), np.float32), np.zeros((1, 0), np.float32), np.zeros(0), np.zeros(0), prior, k)
    x = np.stack([np.frombuffer(v, "<f2") for v in got["x"]]).astype(np.float32)
    y = got["y"].to_numpy().astype(np.float64)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.2).astype(np.float32)
    x *= idf
    mean = x.mean(0)
    x -= mean
    rng = np.random.default_rng(7)
    q = x.T @ (x @ rng.standard_normal((DIMS, rank + 8)).astype(np.float32))
    for _ in range(3):  # power iterations of a randomised decomposition
        q = x.T @ (x @ np.linalg.qr(q)[0])
    q = np.linalg.qr(q)[0]
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    project = (q @ v[:rank].T).astype(np.float32)
    share = np.where(y == 1, y.mean(), 1 - y.mean())
    m = Model(idf, mean, project, np.zeros((rank, 0)), y, np.where(y == 1, prior, 1 - prior) / share, prior, min(k, len(y)))
    z = x @ project
    m.vectors = np.ascontiguousarray((z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)).T, dtype=np.float32)
    return m


def vote(model: Model, texts: list[str], block: int = 256) -> np.ndarray:
    out = np.full(len(texts), model.prior)
    if not len(model.labels):
        return out
    for lo in range(0, len(texts), block):
        part = texts[lo : lo + block]
        cos = model.latent(term_shares(part)) @ model.vectors
        least = np.partition(cos, -model.k, axis=1)[:, -model.k]
        w = np.where(cos >= least[:, None] - 1e-6, np.maximum(cos, 0.01) ** 2, 0) * model.weights
        out[lo : lo + block] = np.where([bool(t) for t in part], np.round((w @ model.labels) / w.sum(1), 6), model.prior)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """``keep`` columns, ``score`` (likelihood of label 1, from 0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 x per_class x rank numbers, and DIMS x rank
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def run(texts: list[str]) -> list[pa.Array]:
        s = vote(shared.value, texts)
        return [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))]

    return base.map_text(docs, text_col, run, fields, docs.columns if keep is None else keep)
