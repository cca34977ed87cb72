"""Personal data: exact base patterns, and more spans accepted by boosted trees.

High-recall generators propose overlapping spans: every window of neighbouring groups of digits in a run of them, and every
reading of an address, also one written with "at" and "dot". Boosted trees over format and context features, one for each
kind, score them; a Platt scale and a threshold of 0.98 precision out of fold decide, and of overlapping spans the likelier one stays.
Training rows are the candidates of a bounded, hash-picked sample of texts: those that are base spans, and base spans rewritten
(plus sign dropped, separators changed, "@" spelt out), are positive; all other windows, also those that only overlap one, are negative.

Edge cases: null and empty texts have no spans; an accepted span never overlaps a base span or another accepted one (the
likelier first, then the earlier); without training candidates only base spans are returned; repeated rows and extra
columns do not matter. Every pattern is linear in the text's length, as is the number of windows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base, boosting

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repeats and the look-behind only save retries; the matches are the same.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
#: A run of digit groups with up to three separators between them, and its groups.
NUMBER = re.compile(r"[0-9]++(?:[ ().\-/]{1,3}[0-9]++)*+")
GROUP = re.compile(r"[0-9]++")
DIGITS = (7, 19)  # of a window; the phone and card formats that are known have as many
AT = re.compile(r"[ ]?(?:@|[(\[]at[)\]]| at )[ ]?")
LABEL = re.compile(r"[A-Za-z0-9-]++")
DOT = re.compile(r"[ ]?(?:\.|[(\[]dot[)\]]| dot )[ ]?")
HINTS = {"email": re.compile(r"(?i)mail|contact"), "ip": re.compile(r"(?i)\bip\b|host|addr"), "card": re.compile(r"(?i)card|visa|pay|acc"), "phone": re.compile(r"(?i)tel|phone|call|fax|mobil")}


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        n = ord(ch) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every base match, by start and then kind."""
    found: list[tuple[int, int, int]] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            found.append((start, 0, last))
        at = text.find("@", max(at + 1, last))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Proposed spans, which overlap, with the family that proposed them."""
    out = []
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            if m.end() - m.start() < DIGITS[0]:
                continue
            groups = [g.span() for g in GROUP.finditer(text, m.start(), m.end())]
            for i, (start, _) in enumerate(groups):
                n = 0
                for j in range(i, len(groups)):
                    a, z = groups[j]
                    n += z - a
                    if n > DIGITS[1]:
                        break
                    if n >= DIGITS[0]:
                        out.append((start, z, "number"))
                        s = start
                        while s > 0 and text[s - 1] in "+(" and start - s < 2:
                            s -= 1
                        if s < start:
                            out.append((s, z, "number"))
    if "@" in text or "(at" in text or "[at" in text or " at " in text and (" dot " in text or "." in text):
        last = 0
        for m in AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            label = LABEL.match(text, m.end())
            while start < m.start() and label:
                last = m.end()
                dot = DOT.match(text, label.end())
                label = LABEL.match(text, dot.end()) if dot else None
                if label:
                    out.append((start, label.end(), "address"))
    return out


def features(text: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    digits = re.sub("[^0-9]", "", s)
    groups = re.findall("[0-9]+", s)
    before, after = text[max(0, start - 24) : start], text[end : end + 1]
    octets = len(groups) == 4 and s.count(".") == 3 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return [
        len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        s.count(" "), s.count("-"), s.count("."), s.count("(") + s.count("/"), s[:1] == "+",
        luhn(digits) if 12 <= len(digits) <= 20 else -1, octets, "@" in s or "(at)" in s or "[at]" in s,
        "(dot)" in s or "[dot]" in s or " dot " in s, sum(c.isalpha() for c in s) / max(1, len(s)),
        before[-1:].isalnum(), after.isalnum(), before[-1:] == "+", sum(c.isdigit() for c in before) / 24,
        _digit_near(before[::-1]), _digit_near(text[end : end + 4]), len(set(re.sub("[0-9]", "", s))), len({len(g) for g in groups}), s[:2] == "00",
        *[bool(HINTS[k].search(before)) for k in KINDS],
    ]


def _digit_near(text: str) -> bool:
    """Whether a digit follows within three separators: the window could go on."""
    at = next((i for i, c in enumerate(text[:4]) if c not in " ().-/"), 4)
    return text[at : at + 1].isdigit()


def _rewritten(text: str, start: int, end: int, kind: str):
    """The span's surroundings with the span in another common writing, and where it is then."""
    s, left, right = text[start:end], text[max(0, start - 30) : start], text[end : end + 10]
    if kind == "email":
        user, _, host = s.partition("@")
        forms = [f"{user} (at) {host}", f"{user} [at] {host.replace('.', ' [dot] ')}"]
    elif kind == "phone":
        d = re.sub("[^0-9]", "", s)
        forms = [s[1:], "00" + s[1:], "00" + d, f"00{d[:2]} {d[2:]}"]
    elif kind == "card":
        d = s.replace(" ", "").replace("-", "")
        forms = [".".join(d[i : i + 4] for i in range(0, len(d), 4)), "  ".join(d[i : i + 4] for i in range(0, len(d), 4))]
    else:
        forms = []
    return [(left + f + right, len(left), len(left) + len(f)) for f in forms]


def training_rows(text: str) -> list[tuple[list[float], str]]:
    """Features and kind ('' for none) of a text's candidates and of those in the surroundings of its rewritten base spans."""
    spans = base_spans(text)
    exact = {(s, e): k for s, e, k in reversed(spans)}
    out = [(features(text, s, e), exact.get((s, e), "")) for s, e, _ in candidates(text)]
    for start, end, kind in spans:
        for other, lo, hi in _rewritten(text, start, end, kind):
            out += [(features(other, s, e), kind if (s, e) == (lo, hi) else "") for s, e, _ in candidates(other) if s < hi and lo < e]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = 6000, max_rows: int = 20_000) -> dict[str, boosting.Boosted]:
    """Trees for each kind, from the candidates of about ``n_docs`` texts (at most ``max_rows`` of them)."""
    rows = docs.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(text_col)).alias("t"), F.lit(1).alias("g")).filter("t is not null")
    sample, sizes = base.bounded_sample(rows, "g", n_docs, ["k", "t"])
    if not sizes:
        return {}

    def run(batches):
        for b in batches:
            got = [(x, k) for t in b.column(0).to_pylist() for x, k in training_rows(t)]
            yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<f4").tobytes() for x, _ in got], pa.binary()), pa.array([k for _, k in got], pa.string())], names=["x", "kind"])

    got = sample.select("t").mapInArrow(run, "x binary, kind string").orderBy(F.xxhash64("x"), "x", "kind").limit(max_rows).toPandas()
    if not len(got):
        return {}
    x = np.stack([np.frombuffer(v, "<f4") for v in got["x"]]).astype(np.float64)
    models = {k: boosting.fit(x, (got["kind"] == k).to_numpy().astype(np.float64)) for k in KINDS}
    return {k: m for k, m in models.items() if m is not None}


def added_spans(models: dict, text_list: list[str], spans_list: list[list]) -> list[list[tuple[int, int, str, float]]]:
    """Accepted spans, with their probability, beside the base spans of each text."""
    known = [base.Spans(v) for v in spans_list]
    where = [(i, s, e, fam) for i, t in enumerate(text_list) for s, e, fam in candidates(t) if not known[i].meet(s, e)]
    out: list[list[tuple[int, int, str, float]]] = [[] for _ in text_list]
    if not where or not models:
        return out
    good: list[list[tuple[float, int, int, str]]] = [[] for _ in text_list]
    for lo in range(0, len(where), 20_000):
        part = where[lo : lo + 20_000]
        x = np.array([features(text_list[i], s, e) for i, s, e, _ in part], dtype=np.float64)
        for kind, m in models.items():
            p = m.probability(x)
            ok = (p >= m.threshold) & np.array([(fam == "address") == (kind == "email") for *_, fam in part])
            for j in np.flatnonzero(ok):
                good[part[j][0]].append((-float(p[j]), part[j][1], part[j][2], kind))
    return [[(s, e, kind, -p) for p, s, e, kind in base.without_overlap(v)] for v in good]


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("p", T.DoubleType())]))
REDACTED = "redacted_text"


def find(docs: DataFrame, models: dict, text_col: str = "text", keep: list[str] | None = None, redact: bool = False) -> DataFrame:
    """``keep`` columns, ``spans`` (start, end, kind, base, p: the probability of added ones) by start, and ``redacted_text`` with ``<KIND>`` for each span if asked."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    fields = [T.StructField("spans", SPAN)] + [T.StructField(REDACTED, T.StringType())] * redact

    def run(texts: list[str]) -> list[pa.Array]:
        spans = [base_spans(t) for t in texts]
        more = added_spans(shared.value, texts, spans)
        both = [sorted([(s, KINDS.index(k), e, True, 1.0) for s, e, k in a] + [(s, KINDS.index(k), e, False, p) for s, e, k, p in b]) for a, b in zip(spans, more, strict=True)]
        flat = [x for v in both for x in v]
        values = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[2] for x in flat], pa.int32()), pa.array([KINDS[x[1]] for x in flat], pa.string()), pa.array([x[3] for x in flat], pa.bool_()), pa.array([x[4] for x in flat], pa.float64())], names=["start", "end", "kind", "base", "p"])
        out: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, both)]).astype(np.int32)), values)]
        if redact:
            out.append(pa.array([redacted(t, v) for t, v in zip(texts, both, strict=True)], pa.string()))
        return out

    return base.map_text(docs, text_col, run, fields, docs.columns if keep is None else keep)


def redacted(text: str, spans) -> str:
    """Each span becomes its kind; where spans of two kinds overlap, their union becomes the first one's kind."""
    if not spans:
        return text
    parts, at = [], 0
    for start, k, end, *_ in spans:
        if start >= at:
            parts += [text[at:start], f"<{KINDS[k].upper()}>"]
        at = max(at, end)
    return "".join(parts) + text[at:]

