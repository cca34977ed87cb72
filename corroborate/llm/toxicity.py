"""Toxicity by a chain of linear classifiers.

Categories are predicted in order; each model sees presence features of words and word beginnings plus the probabilities
of the categories before it. Those probabilities are out-of-fold while training, so a later model meets the errors that it
will meet in use. Fitted on a bounded, hash-picked sample (``per_class`` rows of each class of the last category).

Where the labels have one category alone, others come from the sample: the positive rows that a model over the clearest features
finds out of fold are the first kind, those it misses another, of which the same may be asked again. Features are picked for each kind apart,
so that signs of the less open kinds are not crowded out, and the chain's last model combines the kinds as predicted out of fold.

Edge cases: null and empty texts have no feature and get the intercepts' probabilities; with no labelled rows every
probability is 0; a category with a single class gets its share as a constant; repeated rows and extra columns do not matter;
of several texts with one labelled id the least one is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

BITS = 17


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs: hashes of each lower-cased run of letters and of its first five letters."""
    codes, starts = base.char_codes(texts)
    letter = base.is_letter(codes)
    first, end = base.runs(letter)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = base.lowered(codes[letter]).astype(np.uint64)
    size = end - first
    at = np.cumsum(size) - size
    inside = (np.arange(len(low)) - np.repeat(at, size)).astype(np.uint64)
    h = base.mixed(low * np.uint64(0x100000001B3) + inside)
    whole = np.add.reduceat(h, at)
    head = np.add.reduceat(np.where(inside < 5, h, np.uint64(0)), at)
    doc = np.searchsorted(starts, first, side="right") - 1
    half = 1 << (BITS - 1)
    ids = np.concatenate([base.mixed(whole) >> np.uint64(65 - BITS), (base.mixed(head + np.uint64(99)) >> np.uint64(65 - BITS)) + np.uint64(half)]).astype(np.int64)
    key = np.unique(np.concatenate([doc, doc]) * (1 << BITS) + ids)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Chain:
    categories: list[str]
    slot: np.ndarray  # feature -> column or -1
    models: list[tuple[np.ndarray, float]] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = np.zeros((len(x), len(self.categories)))
        for j, (w, b) in enumerate(self.models):
            p[:, j] = _sigmoid(np.concatenate([x, p[:, :j]], axis=1) @ w + b)
        return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps."""
    if y.min() == y.max():
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        return np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
    xb = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    weight = weight / weight.sum()
    step = 4.0 / float((xb * xb).sum(1) @ weight)
    w = v = np.zeros(xb.shape[1])
    for t in range(steps):
        residual = weight * (_sigmoid(xb @ v.astype(xb.dtype)) - y)
        g = (residual.astype(xb.dtype) @ xb).astype(np.float64) + l2 * np.append(v[:-1], 0)
        new = v - 4 * step * g
        v, w = new + t / (t + 3) * (new - w), new
    return w[:-1], float(w[-1])


def _columns(ids: np.ndarray, row: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` features whose presence differs most between the classes."""
    pos, tot = np.bincount(ids, weights=y[row], minlength=1 << BITS), np.bincount(ids, minlength=1 << BITS)
    expected = tot * y.sum() / len(y)
    chi = np.where(tot > 1, (pos - expected) ** 2 / np.maximum(expected * (1 - tot / (len(y) + 1)), 1e-9), 0)
    return np.argsort(-chi, kind="stable")[:n]


def _matrix(ids: np.ndarray, row: np.ndarray, picked: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Presence of the picked features, and the column of each feature (-1 for none)."""
    slot = np.full(1 << BITS, -1, np.int32)
    slot[picked] = np.arange(len(picked), dtype=np.int32)
    x = np.zeros((n, len(picked)), np.float32)
    on = slot[ids] >= 0
    x[row[on], slot[ids[on]]] = 1
    return x, slot


def _out_of_fold(x: np.ndarray, y: np.ndarray, weight: np.ndarray, folds: int) -> np.ndarray:
    fold, out = np.arange(len(y)) % folds, np.full(len(y), y.mean() if len(y) else 0.0)
    for f in range(folds):
        train = fold != f
        if train.any() and (~train).any():
            w, b = _logistic(x[train], y[train], weight[train])
            out[~train] = _sigmoid(x[~train] @ w + b)
    return out


def kinds_of(ids: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, kinds: int, folds: int, n_features: int) -> np.ndarray:
    """One 0/1 column for each kind of positive rows: those that a linear model over the clearest features finds out of fold, those of
    the others that a model of theirs finds, and so on; the last kind is what is left."""
    left, out = y.copy(), np.zeros((len(y), kinds))
    for k in range(kinds):
        found = left == 1
        if k < kinds - 1 and left.sum() >= 2 * folds:
            keep = (y == 0) | (left == 1)  # rows of earlier kinds are neither positive nor negative here
            at = np.flatnonzero(keep)
            where = np.searchsorted(at, row)
            on = (where < len(at)) & (at[np.minimum(where, len(at) - 1)] == row)
            x, _ = _matrix(ids[on], where[on], _columns(ids[on], where[on], left[at], n_features), len(at))
            found = np.zeros(len(y), bool)
            found[at] = (_out_of_fold(x, left[at], weight[at], folds) >= 0.5) & (left[at] == 1)
        out[found, k] = 1
        left = np.where(found, 0, left)
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text", per_class: int = 1500, n_features: int = 1500, folds: int = 4, derived: int = 0) -> Chain:
    """Learn the chain. ``labels`` has the id and a 0/1 column for each category; the last one balances the sample. ``derived`` kinds of
    the last category, named after it, come before it."""
    y_cols = [F.max(F.col(base.quoted(c)).cast("int")).alias(f"y{j}") for j, c in enumerate(categories)]
    marked = labels.filter(F.col(base.quoted(id_col)).isNotNull()).groupBy(F.col(base.quoted(id_col)).alias("k")).agg(*y_cols).na.drop()
    n_y = len(categories)
    last = f"y{n_y - 1}"
    names = [*categories[:-1], *[f"{categories[-1]}_{i + 1}" for i in range(derived)], categories[-1]]
    sample, sizes = base.bounded_sample(marked, last, per_class, ["k"])
    texts = docs.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(text_col)).alias("t"))

    def features(batches):
        for b in batches:
            t = [x or "" for x in b.column(0).to_pylist()]
            for lo, hi in base.chunks(t):
                doc, ids = word_features(t[lo:hi])
                offsets = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                own = [b.column(i).slice(lo, hi - lo) for i in range(1, n_y + 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))], names=[f"c{i}" for i in range(n_y + 2)])

    schema = ", ".join(f"c{i} int" for i in range(n_y)) + f", c{n_y} string, c{n_y + 1} array<int>"
    chain = Chain(names, np.full(1 << BITS, -1, np.int32))
    if not sizes:
        chain.models, chain.thresholds = [(np.zeros(j), -30.0) for j in range(len(names))], [0.5] * len(names)
        return chain
    # At most 2 x per_class rows of each class, a hard bound, are broadcast, and reach the driver with the features of their texts.
    one = texts.join(F.broadcast(sample), "k").groupBy("k", *[f"y{j}" for j in range(n_y)]).agg(F.min("t").alias("t"))
    got = one.select("t", *[f"y{j}" for j in range(n_y)], F.col("k").cast("string").alias("k")).mapInArrow(features, schema).toPandas().sort_values(f"c{n_y}")
    ids = np.concatenate([*got[f"c{n_y + 1}"], np.zeros(0)]).astype(np.int64)
    row = np.repeat(np.arange(len(got)), [len(v) for v in got[f"c{n_y + 1}"]])
    y = got[[f"c{j}" for j in range(n_y)]].to_numpy().astype(np.float64).reshape(len(got), n_y)
    if not len(y):
        chain.models, chain.thresholds = [(np.zeros(j), -30.0) for j in range(len(names))], [0.5] * len(names)
        return chain
    share = y[:, -1].mean()
    prior = sizes.get(1, 0) / sum(sizes.values())
    weight = np.where(y[:, -1] == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    weight = np.maximum(weight, 0.2)
    if derived:
        y = np.concatenate([y[:, :-1], kinds_of(ids, row, y[:, -1], weight, derived, folds, 30), y[:, -1:]], axis=1)
    n_y = len(names)
    # Rows are in the order of their ids as text, and so are the folds.
    picked = np.array(list(dict.fromkeys(np.concatenate([_columns(ids, row, y[:, j], n_features // n_y) for j in range(n_y)]).tolist())))
    x, chain.slot = _matrix(ids, row, picked, len(y))
    out = np.zeros_like(y)
    for j in range(n_y):
        xj = np.concatenate([x, out[:, :j].astype(np.float32)], axis=1)
        out[:, j] = _out_of_fold(xj, y[:, j], weight, folds)
        chain.models.append(_logistic(xj, y[:, j], weight))
        grid = np.linspace(0.05, 0.95, 19)
        f1 = [2 * (weight * y[:, j])[out[:, j] >= t].sum() / max(1e-9, weight[out[:, j] >= t].sum() + (weight * y[:, j]).sum()) for t in grid]
        chain.thresholds.append(float(grid[int(np.argmax(f1))]))
    return chain


def score(docs: DataFrame, chain: Chain, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``p_<category>`` in the chain's order, and 0/1 ``<category>`` at the thresholds found out of fold."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.categories
    fields = [T.StructField(f"p_{c}", T.DoubleType()) for c in names] + [T.StructField(c, T.IntegerType()) for c in names]

    def run(texts: list[str]) -> list[pa.Array]:
        m = shared.value
        doc, ids = word_features(texts)
        slot = m.slot[ids]
        x = np.zeros((len(texts), int(m.slot.max()) + 1), np.float32)
        x[doc[slot >= 0], slot[slot >= 0]] = 1
        p = m.probabilities(x)
        return [pa.array(np.round(p[:, j], 9)) for j in range(len(names))] + [pa.array((p[:, j] >= m.thresholds[j]).astype(np.int32)) for j in range(len(names))]

    return base.map_text(docs, text_col, run, fields, docs.columns if keep is None else keep)

