"""Secrets: exact base patterns, and more spans by inferred credential grammars.

Labelled credentials (base matches of a bounded, hash-picked sample of texts) form a prefix tree for each kind, over characters where
many agree and over the token's alphabet elsewhere. States whose shares of stopping and going on are statistically compatible
(Hoeffding's bound, also in all states that follow) are merged, shallowest first, into a probabilistic automaton: states that differ stay, so that
lengths and separators of a format are kept. Every token of every text, and every base match, is then scored: log-likelihood a
character under the automaton against a character-pair model of ordinary tokens. The cut is above all ordinary tokens seen.

Edge cases: null and empty texts have no spans; with no labelled credentials only base spans are returned; added spans
never overlap base ones; a token that fits several kinds gets the one it is furthest over the cut of, then the first listed;
repeated rows and extra columns do not matter. Every pattern is linear in the text's length.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

KINDS = ("assign", "access", "hex")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")  # what the base patterns take as a value, at their least length

#: Kinds of characters that a whole token draws its letters and digits from; the first that holds them all is the token's alphabet.
ALPHABETS = ("0123456789", "0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
SETS = [frozenset(a) for a in ALPHABETS]
MARKS = "+/_.=-"
OTHER = len(ALPHABETS)  # a symbol below it is "a character of that alphabet", one above "that character"


def alphabet(token: str) -> int:
    letters = set(token).difference(MARKS)
    return next(i for i, s in enumerate(SETS) if letters <= s)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of every base match, by start and then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k], v) for s, k, e, v in sorted(found)]


@dataclass
class Automaton:
    """Deterministic: for each state, moves by symbol with a log share, and a log share for stopping.

    A symbol is a character, where many of the labelled strings have it in this place, or else the alphabet of the token, of
    which all characters are equally likely.
    """

    moves: list[dict[int, int]]
    logp: list[dict[int, float]]
    stop: list[float]

    def tables(self, letters: int) -> tuple[np.ndarray, np.ndarray]:
        """Next state and log-likelihood by state and character, for tokens of one alphabet. Characters without a move cost ``MISS`` and
        go the likeliest way."""
        n = len(self.moves)
        way = [moves[max(logp, key=logp.get)] if moves else i for i, (moves, logp) in enumerate(zip(self.moves, self.logp, strict=True))]
        to = np.repeat(np.array(way, dtype=np.int32)[:, None], 128, axis=1)
        cost = np.full((n, 128), MISS, np.float32)
        own = [ord(c) for c in ALPHABETS[letters]]
        for i, (moves, logp) in enumerate(zip(self.moves, self.logp, strict=True)):
            if letters in moves:
                to[i, own], cost[i, own] = moves[letters], logp[letters] - np.log(len(own))
            for sym, j in moves.items():
                if sym > OTHER:
                    to[i, sym - OTHER], cost[i, sym - OTHER] = j, logp[sym]
        return to, cost

    def score(self, token: str) -> float:
        """Log-likelihood a character."""
        to, cost = self.tables(alphabet(token))
        state, total = 0, 0.0
        for ch in token:
            total += float(cost[state, ord(ch)])
            state = int(to[state, ord(ch)])
        return (total + self.stop[state]) / max(1, len(token))


MISS = -12.0


def _tree(strings: list[str], literal: float, least: int) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Prefix tree of whole strings: children by symbol, strings that pass and that end. A character is a symbol of its own where
    at least ``least`` strings and a share ``literal`` of those that go on have it, and if it is a mark."""
    kids, count, final = [{}], [0], [0]
    letters = [alphabet(s) for s in strings]
    todo = [(0, 0, list(range(len(strings))))]
    while todo:
        node, depth, rows = todo.pop()
        count[node] = len(rows)
        on = [r for r in rows if len(strings[r]) > depth]
        final[node] = len(rows) - len(on)
        seen = Counter(strings[r][depth] for r in on)
        own = {c for c, n in seen.items() if c in MARKS or n >= least and n >= literal * len(on)}
        groups: dict[int, list[int]] = {}
        for r in on:
            c = strings[r][depth]
            groups.setdefault(OTHER + ord(c) if c in own else letters[r], []).append(r)
        for sym, part in sorted(groups.items()):
            kids[node][sym] = len(kids)
            todo.append((len(kids), depth + 1, part))
            kids.append({})
            count.append(0)
            final.append(0)
    return kids, count, final


def infer(strings: list[str], alpha: float = 0.02, literal: float = 0.5, least: int = 8) -> Automaton:
    """Merge compatible prefix-tree states, shallowest first: shares of stopping and of each symbol must agree by Hoeffding's bound,
    in the two states and in all that can be reached from them with enough strings to tell."""
    kids, count, final = _tree(strings, literal, least)
    bound = float(np.sqrt(0.5 * np.log(2 / alpha)))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)

    def compatible(a: int, b: int) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            x, y = todo.pop()
            if (x, y) in seen or bound * (count[x] ** -0.5 + count[y] ** -0.5) >= 1:  # too few strings here and below
                continue
            seen.add((x, y))
            if differ(final[x], count[x], final[y], count[y]):
                return False
            for c in kids[x].keys() | kids[y].keys():
                i, j = kids[x].get(c), kids[y].get(c)
                if differ(0 if i is None else count[i], count[x], 0 if j is None else count[j], count[y]):
                    return False
                if i is not None and j is not None and i != j:
                    todo.append((i, j))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            count[x] += count[y]
            final[x] += final[y]
            for c, j in kids[y].items():
                if c in kids[x]:
                    todo.append((kids[x][c], j))
                else:
                    kids[x][c] = j

    red, is_red, blue = [0], {0}, [(0, c) for c in sorted(kids[0])]
    while blue:
        x, c = blue.pop(0)
        j = kids[x].get(c)
        if j is None or j in is_red:
            continue
        into = next((r for r in red if compatible(r, j)), None)
        if into is None:
            red.append(j)
            is_red.add(j)
            blue += [(j, k) for k in sorted(kids[j])]
        else:
            kids[x][c] = into
            fold(into, j)
            blue += [(r, k) for r in red for k in sorted(kids[r]) if kids[r][k] not in is_red and (r, k) not in blue]
    number = {r: i for i, r in enumerate(red)}
    moves = [{c: number[j] for c, j in kids[r].items()} for r in red]
    use: list[dict[int, float]] = [dict.fromkeys(m, 0.5) for m in moves]
    ends = [0.5] * len(red)
    for s in strings:  # shares, counted by running the strings through the automaton
        state, letters = 0, alphabet(s)
        for ch in s:
            sym = OTHER + ord(ch)
            sym = sym if sym in moves[state] else letters
            if sym not in moves[state]:
                break
            use[state][sym] += 1
            state = moves[state][sym]
        else:
            ends[state] += 1
    total = [sum(u.values()) + e for u, e in zip(use, ends, strict=True)]
    return Automaton(moves, [{c: float(np.log(n / t)) for c, n in u.items()} for u, t in zip(use, total, strict=True)], [float(np.log(e / t)) for e, t in zip(ends, total, strict=True)])


@dataclass
class Model:
    automata: dict[str, Automaton]
    pairs: np.ndarray  # log-likelihood of a character after another, over 128 x 128
    cut: dict[str, float]
    dense: dict = field(default_factory=dict)

    def likelihoods(self, tokens: list[str]) -> np.ndarray:
        """How much likelier each token is, a character, under each kind's automaton than as ordinary text: tokens x kinds.

        All tokens step through the tables side by side, the longest first.
        """
        out = np.full((len(tokens), len(self.automata)), -np.inf)
        if not tokens or not self.automata:
            return out
        size = np.array([len(t) for t in tokens])
        letters = np.array([alphabet(t) for t in tokens])
        order = np.argsort(-size, kind="stable")
        lo = 0
        while lo < len(order):
            width = int(size[order[lo]])
            part = order[lo : lo + max(1, 2_000_000 // width)]
            lo += len(part)
            n = size[part]
            codes = np.zeros((len(part), width), np.uint8)
            codes[np.arange(width) < n[:, None]] = np.frombuffer("".join([tokens[i] for i in part]).encode(), np.uint8)
            live = np.searchsorted(-n, -np.arange(width), side="left")  # tokens with more than t characters
            plain, before = np.zeros(len(part)), np.full(len(part), 32, np.uint8)
            for t in range(width):
                k = live[t]
                plain[:k] += self.pairs[before[:k], codes[:k, t]]
                before[:k] = codes[:k, t]
            for j, (kind, a) in enumerate(self.automata.items()):
                if kind not in self.dense:
                    both = [a.tables(i) for i in range(len(ALPHABETS))]
                    self.dense[kind] = np.stack([x for x, _ in both]), np.stack([x for _, x in both]), np.array(a.stop)
                to, cost, stop = self.dense[kind]
                own, state, total = letters[part], np.zeros(len(part), np.int32), np.zeros(len(part))
                for t in range(width):
                    k = live[t]
                    total[:k] += cost[own[:k], state[:k], codes[:k, t]]
                    state[:k] = to[own[:k], state[:k], codes[:k, t]]
                out[part, j] = (total + stop[state] - plain) / n
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = 6000, per_kind: int = 500, ordinary: int = 20_000, longest: int = 1024) -> Model:
    """Automata from at most ``per_kind`` credentials of each kind among about ``n_docs`` texts, those of over ``longest`` characters
    left out, and cuts from at most ``ordinary`` other tokens, picked by hash. One pass over the sample gathers all of them."""
    rows = docs.select(F.col(base.quoted(id_col)).alias("k"), F.col(base.quoted(text_col)).alias("t"), F.lit(1).alias("g")).filter("t is not null")
    sample, sizes = base.bounded_sample(rows, "g", n_docs, ["k", "t"])
    if not sizes:
        return Model({}, np.zeros((128, 128)), {})
    most = {**dict.fromkeys(KINDS, per_kind), "": ordinary}

    def run(batches):
        for b in batches:
            out: set[tuple[str, str]] = set()
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                known = base.Spans(spans)
                out.update((k, v) for *_, k, v in spans if len(v) <= longest)
                out.update(("", m[0]) for m in TOKEN.finditer(t) if len(m[0]) <= longest and not known.meet(m.start(), m.end()))
            rows = sorted(out)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string())], names=["kind", "v"])

    got = sample.select("t").mapInArrow(run, "kind string, v string").distinct()
    ranked = got.withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("v"), "v"))).filter(F.col("r") <= max(most.values()))
    seen: dict[str, list[str]] = {}
    for k, v, r in ranked.collect():  # at most 20,000 tokens of each kind
        if r <= most[k]:
            seen.setdefault(k, []).append(v)
    plain = sorted(seen.pop("", []))
    return fitted({k: sorted(v) for k in KINDS if (v := seen.get(k))}, plain)


#: Tokens count as unlabelled credentials if they score like the labelled ones but for this share of these, as long as they are no more than
#: that share of all tokens.
LOWEST, MOST_SUSPECT = 0.05, 0.1


def _pair_model(tokens: list[str]) -> np.ndarray:
    pairs = np.full((128, 128), 0.05)
    for t in tokens:
        c = np.frombuffer(t.encode(), np.uint8)
        np.add.at(pairs, (np.concatenate(([32], c[:-1])), c), 1)
    return np.log(pairs / pairs.sum(1, keepdims=True))


def fitted(known: dict[str, list[str]], plain: list[str]) -> Model:
    """Automata of labelled credentials by kind, and what ordinary tokens are like: a model of neighbouring characters and a cut above all of them.

    Among the tokens there are credentials that nobody labelled. Were they taken as ordinary, the cut would lie above them and the model of
    characters would learn them. So tokens that score like credentials are set aside and the rest is fitted anew; unless they are
    many, as then the kind's automaton fits ordinary tokens too, and nothing is set aside for it. What credentials score is told by halves: each
    under an automaton of the other half, which has not seen it.
    """
    automata, nothing = {k: infer(v) for k, v in known.items()}, np.zeros((128, 128))
    alone = lambda a, tokens: Model({"": a}, nothing, {}).likelihoods(tokens)[:, 0]  # noqa: E731  under the automaton only
    suspect = np.zeros(len(plain), bool)
    for k, v in known.items():
        unseen = np.concatenate([alone(infer(v[1 - i :: 2] or v), v[i::2]) for i in range(2) if v[i::2]])
        alike = alone(automata[k], plain) >= np.quantile(unseen, LOWEST) if plain else suspect
        if len(plain) and alike.mean() <= MOST_SUSPECT:
            suspect |= alike
    rest = [t for t, out in zip(plain, suspect.tolist(), strict=True) if not out]
    model = Model(automata, _pair_model(rest), {})
    like = model.likelihoods(rest)
    for j, k in enumerate(model.automata):  # above all ordinary tokens seen, and no lower than 1 nat a character
        model.cut[k] = max(1.0, 0.1 + float(like[:, j].max(initial=-np.inf))) if len(rest) else 1.0
    return model


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("score", T.DoubleType())])
FIELDS = [T.StructField("spans", T.ArrayType(SPAN))]


def find(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``spans`` (start, end, kind, base, score) by start, then kind as listed.

    The score, of base spans too (null without an automaton of their kind), is how much likelier a character the credential is under its kind's automaton than as ordinary text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]) -> list[pa.Array]:
        m = shared.value
        kinds = list(m.automata)
        found = [base_spans(t) for t in texts]
        asked: dict[str, int] = {}
        where = []  # text, start, end, token
        for i, (t, spans) in enumerate(zip(texts, found, strict=True)):
            known = base.Spans(spans)
            for *_, v in spans:
                asked.setdefault(v, len(asked))
            if kinds:
                for c in TOKEN.finditer(t):
                    if not spans or not known.meet(c.start(), c.end()):
                        where.append((i, c.start(), c.end(), asked.setdefault(c[0], len(asked))))
        like = m.likelihoods(list(asked))
        over = like - np.array([m.cut[k] for k in kinds]) if kinds else like
        best = over.argmax(1) if kinds and len(like) else np.zeros(len(like), np.int64)
        hit = over[np.arange(len(like)), best] > 0 if kinds and len(like) else np.zeros(len(like), bool)
        both = [[(s, KINDS.index(k), e, True, round(float(like[asked[v], kinds.index(k)]), 6) if k in kinds else None) for s, e, k, v in spans] for spans in found]
        for i, s, e, token in where:
            if hit[token]:
                both[i].append((s, KINDS.index(kinds[best[token]]), e, False, round(float(like[token, best[token]]), 6)))
        flat = [x for v in both for x in sorted(v, key=lambda x: x[:3])]
        values = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[2] for x in flat], pa.int32()), pa.array([KINDS[x[1]] for x in flat], pa.string()), pa.array([x[3] for x in flat], pa.bool_()), pa.array([x[4] for x in flat], pa.float64())], names=SPAN.names)
        return [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, both)]).astype(np.int32)), values)]

    return base.map_text(docs, text_col, run, FIELDS, docs.columns if keep is None else keep)
