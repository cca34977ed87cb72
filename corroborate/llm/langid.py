"""Language identification of mixed-language text.

Each run of letters is a word. Its script narrows the candidate languages to those seen in that script; each candidate
gets the log-likelihood of the word's character trigrams; a Viterbi pass over the words of a text, in which a change of
language costs ``switch_penalty`` nats, labels spans. The model is a table of trigram counts per language, gathered with
one grouped count over a bounded, hash-picked sample of labelled texts (``per_lang`` rows a language).

Edge cases: null and empty texts and texts without a letter get ``und`` and score 0; a text whose script no learned
language uses gets the most frequent language at score 0; ties go to the more frequent language; an empty training table
labels everything ``und``; repeated rows give repeated results; extra input columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

BINS = 1 << 15

# Unicode block limits of the scripts told apart; the first number is inclusive, the second exclusive.
SCRIPTS = {
    "latin": [(0x41, 0x250), (0x1E00, 0x1F00)],
    "greek": [(0x370, 0x400), (0x1F00, 0x2000)],
    "cyrillic": [(0x400, 0x530)],
    "armenian": [(0x530, 0x590)],
    "hebrew": [(0x590, 0x600)],
    "arabic": [(0x600, 0x780)],
    "indic": [(0x900, 0xE00)],
    "thai": [(0xE00, 0xE80)],
    "georgian": [(0x10A0, 0x1100)],
    "hangul": [(0x1100, 0x1200), (0xAC00, 0xD7B0)],
    "kana": [(0x3040, 0x3100)],
    "han": [(0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x30000)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # the last is "other"


def script_of(codes: np.ndarray) -> np.ndarray:
    out = np.full(len(codes), N_SCRIPTS - 1, dtype=np.int64)
    for k, ranges in enumerate(SCRIPTS.values()):
        for lo, hi in ranges:
            out[(codes >= lo) & (codes < hi)] = k
    return out


def word_grams(texts: list[str]):
    """Letters' trigram bins and scripts, and the words: first letter (index among letters), text, character limits."""
    codes, starts = base.char_codes(texts)
    letter = base.is_letter(codes)
    low = np.where(letter, base.lowered(codes), np.uint32(32)).astype(np.uint32)
    padded = np.concatenate(([np.uint32(32)], low, [np.uint32(32)]))
    h = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA6B) ^ padded[2:] * np.uint32(0xC2B2AE35)
    at = np.flatnonzero(letter)
    h = h[at]
    bins = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)
    first, end = base.runs(letter)
    size = end - first
    word_at = np.cumsum(size) - size
    doc = np.searchsorted(starts, first, side="right") - 1
    scripts = script_of(low[first])
    return bins, word_at, doc, first - starts[doc], end - starts[doc], scripts


@dataclass
class Model:
    langs: list[str]  # by falling number of training rows
    logp: np.ndarray  # BINS x langs, float32
    allowed: np.ndarray  # N_SCRIPTS x langs, bool
    switch_penalty: float


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 1500, switch_penalty: float = 12.0, max_langs: int = 1024) -> Model:
    """Learn from about ``per_lang`` labelled texts of every language; more than ``max_langs`` of them raise (the model has 128 KB for each)."""
    rows = docs.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(text_col)).alias("t"), F.col(base.quoted(lang_col)).alias("g")).filter("t is not null and g is not null")
    sample, sizes = base.bounded_sample(rows, "g", per_lang, ["k", "t"], max_langs)
    langs = list(sizes)

    def count(batches):
        for b in batches:
            texts, labels = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), dtype=object)
            for lang in dict.fromkeys(labels):
                total, seen = np.zeros(BINS, dtype=np.int64), np.zeros(N_SCRIPTS, dtype=np.int64)
                mine = [t for t, x in zip(texts, labels, strict=True) if x == lang]
                for lo, hi in base.chunks(mine):
                    bins, *_, scripts = word_grams(mine[lo:hi])
                    total += np.bincount(bins, minlength=BINS)
                    seen += np.bincount(scripts, minlength=N_SCRIPTS)
                both = np.concatenate([total, seen])
                at = np.flatnonzero(both)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(both[at])], names=["g", "bin", "n"])

    # At most (BINS + N_SCRIPTS) x max_langs sums reach the driver.
    sums = sample.select("t", "g").mapInArrow(count, "g string, bin long, n long").groupBy("g", "bin").agg(F.sum("n").alias("n")).toPandas() if langs else None
    counts = np.zeros((BINS + N_SCRIPTS, len(langs)))
    if langs:
        where = {x: i for i, x in enumerate(langs)}
        counts[sums["bin"].to_numpy(dtype=np.int64), sums["g"].map(where).to_numpy(dtype=np.int64)] = sums["n"].to_numpy()
    grams, seen = counts[:BINS], counts[BINS:]
    logp = np.log((grams + 0.3) / (grams.sum(0) + 0.3 * BINS)).astype(np.float32)
    return Model(langs, logp, seen >= np.maximum(1, 0.01 * seen.sum(0)), switch_penalty)


def certain(scores: np.ndarray, starts: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Each text's best single language, and whether no path with a switch can beat it.

    D is how much the best other language gains on each word. A path that leaves the single language over some words gains
    at most the sum of D there, and pays two switches inside the text or one at an end.
    """
    total = np.add.reduceat(scores, starts, axis=0)
    best = total.argmax(1)
    size = np.diff(np.append(starts, len(scores)))
    mine = np.repeat(best, size)
    rows = np.arange(len(scores))
    other = scores.copy()
    own = other[rows, mine]
    other[rows, mine] = -np.inf
    gain = (other.max(1) if scores.shape[1] > 1 else np.full(len(scores), -1e9)) - own
    run = np.cumsum(np.maximum(gain, -1e3).astype(np.float64))
    before = np.concatenate(([0.0], run[:-1]))
    base_at = before[starts]
    rel, rel_before = run - np.repeat(base_at, size), before - np.repeat(base_at, size)
    shift = np.repeat(np.arange(len(starts)) * (np.abs(rel).max(initial=1.0) * 2 + 1), size)
    low = np.minimum.accumulate(rel_before - shift) + shift
    inside = np.maximum.reduceat(rel - low, starts)
    last = np.append(starts[1:], len(scores)) - 1
    return best, (inside <= 2 * penalty) & (np.maximum.reduceat(rel, starts) <= penalty) & (rel[last] - low[last] <= penalty)


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """The best path for each of several texts, stepping through their words side by side."""
    n_lang = scores.shape[1]
    ends = np.append(starts[1:], len(scores))
    out = np.zeros(len(scores), dtype=np.int64)
    order = np.argsort(starts - ends, kind="stable")
    lo = 0
    while lo < len(order):
        longest = int(ends[order[lo]] - starts[order[lo]])
        group = order[lo : lo + max(1, 400_000 // longest)]
        lo += len(group)
        size = ends[group] - starts[group]
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t words
        value, back = scores[starts[group]].astype(np.float64), []
        for t in range(1, longest):
            v = value[: live[t]]
            top = v.argmax(1)
            jump = v[np.arange(len(v)), top] - penalty
            back.append(np.where(v >= jump[:, None], np.arange(n_lang), top[:, None]).astype(np.int16))
            value[: live[t]] = np.maximum(v, jump[:, None]) + scores[starts[group[: live[t]]] + t]
        state = value.argmax(1)
        for t in range(longest - 1, -1, -1):
            on = live[t]
            out[starts[group[:on]] + t] = state[:on]
            if t:
                state[:on] = back[t - 1][np.arange(on), state[:on]]
    return out


def label_words(model: Model, texts: list[str]):
    """Words of the texts (text, start, end, letters) with the language of each, -1 where no language fits the script."""
    bins, word_at, doc, first, end, scripts = word_grams(texts)
    if not len(doc) or not model.langs:
        return doc, first, end, np.full(len(doc), -1, dtype=np.int64)
    scores = np.add.reduceat(model.logp[bins], word_at, axis=0).astype(np.float64)
    allowed = model.allowed[scripts]
    known = allowed.any(1)
    scores = np.where(allowed, scores, scores.min(1, keepdims=True) - 50.0)
    scores[~known] = 0.0
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    best, sure = certain(scores, starts, model.switch_penalty)
    size = np.diff(np.append(starts, len(doc)))
    label = np.repeat(best, size)
    if not sure.all():
        hard = np.flatnonzero(~sure)
        at = np.concatenate([np.arange(starts[i], starts[i] + size[i]) for i in hard])
        label[at] = viterbi(scores[at], np.cumsum(size[hard]) - size[hard], model.switch_penalty)
    return doc, first, end, np.where(known, label, -1)


FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))),
]


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the language holding most letters, its share of them (0 to 1) and the spans of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BINS x max_langs numbers at most

    def label(texts: list[str]) -> list[pa.Array]:
        m = shared.value
        doc, first, end, lab = label_words(m, texts)
        n, k = len(texts), len(m.langs)
        weight = np.bincount(doc * (k + 1) + lab + 1, weights=end - first, minlength=n * (k + 1)).reshape(n, k + 1)
        total = weight.sum(1)
        top = weight[:, 1:].argmax(1) if k else np.zeros(n, dtype=np.int64)
        score = weight[np.arange(n), top + 1] / np.maximum(total, 1) if k else np.zeros(n)
        pred = [m.langs[t] if k and w else "und" for t, w in zip(top, total, strict=True)]
        cut = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(lab, prepend=-2) != 0))
        stop = np.append(cut[1:], len(doc)) - 1
        spans = pa.StructArray.from_arrays([pa.array(first[cut], pa.int32()), pa.array(end[stop] if len(cut) else first[:0], pa.int32()), pa.array([m.langs[x] if x >= 0 else "und" for x in lab[cut]], pa.string())], names=["start", "end", "lang"])
        offsets = np.searchsorted(doc[cut], np.arange(n + 1)).astype(np.int32)
        return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)]

    return base.map_text(docs, text_col, label, FIELDS, docs.columns if keep is None else keep)
