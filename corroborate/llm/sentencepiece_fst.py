"""SentencePiece encoding and decoding by shortest paths through weighted transducers.

The model file is compiled into these transducers:

- the normaliser: a tree of the map's keys with what they are rewritten to, longest match first; then white space as the model's flags
  say (runs and ends removed, a word mark for each space and before or after the text);
- the lexicon: a tree whose states are prefixes of pieces; reading a character follows an arc, and a final state writes its piece at the
  piece's cost;
- byte fallback: an arc that reads any one character that is no piece and writes its bytes (or the unknown piece).

Composing them with an input walks the lexicon from every position of the normalised text at once, a character at a time, for
many inputs side by side; each final state met is an arc of the composed lattice, and the tropical-semiring shortest path to each position is kept as it grows.
For a unigram model an arc weighs minus its score. For a byte-pair model it weighs 0, and a further transducer over neighbouring pieces gives weight infinity to pairs that the
merges would not have left side by side; then every prefix of the input has exactly one path of finite weight. Whether a pair
may stand is found by undoing the merges next to the boundary, latest first: a merge across the boundary that ranks before the
one undone would have come first.

Lattices are cut where no piece can cross (at word marks and around line feeds, if the pieces allow it). Each worker keeps a bounded cache of words already
encoded. User-defined pieces are taken first, as they stand; unused byte-pair pieces are taken apart again.

Edge cases: null and empty texts have no tokens and decode to the empty text; a word mark character in the input is read
as a space, so it does not round-trip; repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

MARK = "▁"
NO_RANK = np.int64(1) << 40
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces
UNKNOWN_COST = 10.0  # of an unknown character beyond the dearest piece
SLOTS = 1 << 20


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        elif key & 7 == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = 4 if key & 7 == 5 else 8
            value, at = data[at : at + n], at + n
        yield key >> 3, value


def charsmap(blob: bytes) -> dict[str, str]:
    """The rewriting rules of a precompiled map: the size of a double array, the array, and the texts that its leaves point to.

    A unit of the array holds its label in the low byte and the offset of its children; from node p byte b leads to p ^ offset ^ b.
    """
    if len(blob) < 4:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob[4 : 4 + size], "<u4").tolist(), blob[4 + size :]
    rules, todo = {}, [(0, b"")]
    while todo:
        at, key = todo.pop()
        unit = units[at]
        children = at ^ (unit >> 10) << ((unit & 512) >> 6)
        if key and unit >> 8 & 1:
            value = units[children] & 0x7FFFFFFF
            rules[key] = texts[value : texts.index(0, value)]
        for b in range(1, 256):
            if (to := children ^ b) < len(units) and units[to] & 0x800000FF == b:
                todo.append((to, key + bytes([b])))
    return {k.decode("utf-8", "surrogateescape"): v.decode() for k, v in rules.items()}


@dataclass
class Normaliser:
    """Rewriting rules as a tree of states, and what becomes of spaces."""

    rules: dict[str, str] = field(default_factory=dict)
    prefix: bool = True
    suffix: bool = False
    squeeze: bool = False  # runs of spaces become one, those at the ends go
    mark: str = MARK
    kept: re.Pattern | None = None  # user-defined pieces, which stay as they are
    arcs: list[dict[str, int]] = field(default_factory=list)
    output: list[str | None] = field(default_factory=list)
    first: re.Pattern | None = None

    def __post_init__(self):
        self.arcs, self.output = [{}], [None]
        for key, value in self.rules.items():
            state = 0
            for c in key:
                if c not in self.arcs[state]:
                    self.arcs[state][c] = len(self.arcs)
                    self.arcs.append({})
                    self.output.append(None)
                state = self.arcs[state][c]
            self.output[state] = value
        if self.rules:
            self.first = re.compile("[" + "".join(map(re.escape, sorted(self.arcs[0]))) + "]")

    def rewritten(self, text: str) -> str:
        """The longest key at each place rewritten; other characters stay."""
        out, at = [], 0
        m = self.first.search(text) if self.first else None
        while m:
            state, best, end, i = 0, None, m.start(), m.start()
            while i < len(text) and (state := self.arcs[state].get(text[i])) is not None:
                i += 1
                if self.output[state] is not None:
                    best, end = self.output[state], i
            if best is None:
                end = m.start() + 1
                out.append(text[at:end])
            else:
                out += [text[at : m.start()], best]
            at = end
            m = self.first.search(text, at)
        return "".join(out) + text[at:] if out else text

    def __call__(self, text: str) -> str:
        if not text:
            return ""
        if self.first:
            parts = [text] if self.kept is None else re.split(f"({self.kept.pattern})", text)
            text = "".join(p if i % 2 else self.rewritten(p) for i, p in enumerate(parts))
        if self.squeeze:
            text = re.sub(" {2,}", " ", text).strip(" ")
            if not text:
                return ""
        if self.prefix:
            text = text + " " if self.suffix else " " + text
        return text.replace(" ", self.mark)

    def plain(self, text: str) -> str:
        """The text that decoding gives back: what ``__call__`` makes of it, with spaces again and without the added one."""
        return self.stripped(self(text).replace(self.mark, " "))

    def stripped(self, text: str) -> str:
        return text[1:] if (self.prefix or self.squeeze) and text[:1] == " " else text


@dataclass
class Fst:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    byte_ids: np.ndarray  # id of each byte's piece, -1 without byte fallback
    bpe: bool
    unk: int
    normal: Normaliser
    rank: np.ndarray = field(default=None)  # merge rank of each piece, -1 for single characters
    left: np.ndarray = field(default=None)
    right: np.ndarray = field(default=None)
    ids: dict[str, int] = field(default_factory=dict)
    slot_keys: np.ndarray = field(default=None)  # the lexicon's arcs: state and character, by hash
    slot_to: np.ndarray = field(default=None)
    final: np.ndarray = field(default=None)  # piece of each state, -1 for none
    pair_keys: np.ndarray = field(default=None)
    pair_rank: np.ndarray = field(default=None)
    pair_present: np.ndarray = field(default=None)
    dearest: float = 0.0
    user: re.Pattern | None = None
    cut: str = ""  # where words end: before or after marks, or nowhere
    cut_lines: bool = True

    def merges(self, s: str, trace: dict | None = None) -> list[int]:
        """Byte-pair encoding by the merges themselves; ids of pieces, minus the code point less 1 for unknown characters."""
        part = list(s)
        nxt, prv = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[int, int, str]] = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < len(part):
                p = self.ids.get(part[i] + part[j])
                if p is not None:
                    heapq.heappush(heap, (int(self.rank[p]), i, part[i] + part[j]))

        for i in range(len(part) - 1):
            push(i)
        while heap:
            _, i, merged = heapq.heappop(heap)
            j = nxt[i]
            if part[i] is None or j >= len(part) or part[i] + part[j] != merged:
                continue
            if trace is not None:
                trace[merged] = (part[i], part[j])
            part[i], part[j] = merged, None
            nxt[i] = nxt[j]
            if nxt[i] < len(part):
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [self.ids[p] if p in self.ids else -1 - ord(p) for p in part if p is not None]

    def follow(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The lexicon's next state for each state and character, -1 where there is no arc."""
        key = state << 21 | code
        slot = _slot(key)
        found = self.slot_keys[slot]
        out = np.where(found == key, self.slot_to[slot], -1)
        on = np.flatnonzero((found != key) & (found >= 0))
        while len(on):  # the slot is another's: try the next one
            slot[on] = (slot[on] + 1) & (SLOTS - 1)
            found = self.slot_keys[slot[on]]
            hit = found == key[on]
            out[on[hit]] = self.slot_to[slot[on[hit]]]
            on = on[~hit & (found >= 0)]
        return out


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def _lexicon(m: Fst, usable: dict[str, int]) -> None:
    arcs: dict[int, int] = {}
    final = [-1]
    for p, i in usable.items():
        state = 0
        for c in p:
            key = state << 21 | ord(c)
            if key not in arcs:
                arcs[key] = len(final)
                final.append(-1)
            state = arcs[key]
        final[state] = i
    m.final = np.array(final)
    m.slot_keys, m.slot_to = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int64)
    if len(arcs) * 2 > SLOTS:
        raise ValueError("the vocabulary has too many prefixes")
    for key, slot in zip(arcs, _slot(np.array(list(arcs), np.int64)).tolist(), strict=True):
        while m.slot_keys[slot] >= 0:
            slot = (slot + 1) & (SLOTS - 1)
        m.slot_keys[slot], m.slot_to[slot] = key, arcs[key]


def compile_model(data: bytes) -> Fst:
    """Compile a serialised model."""
    pieces, scores, kinds, bpe, suffix, norm = [], [], [], False, False, {}
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            pieces.append(got.get(1, b"").decode())
            scores.append(np.frombuffer(got[2], "<f4")[0] if 2 in got else 0.0)
            kinds.append(got.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            bpe, suffix = trainer.get(3, 1) == 2, bool(trainer.get(24, 0))
            if trainer.get(3, 1) not in (1, 2):
                raise ValueError("only unigram and byte-pair models are known")
        elif number == 3:
            norm = dict(_fields(value))
    mark = MARK if norm.get(5, 1) else " "
    own = [p for p, k in zip(pieces, kinds, strict=True) if k == USER]
    longest_first = lambda texts: re.compile("|".join(map(re.escape, sorted(texts, key=len, reverse=True)))) if texts else None
    normal = Normaliser(charsmap(norm.get(2, b"")), bool(norm.get(3, 1)), suffix, bool(norm.get(4, 1)), mark, longest_first([p.replace(mark, " ") for p in own]))
    kind = np.array(kinds)
    m = Fst(pieces, np.array(scores, np.float64), kind, np.full(256, -1), bpe, kinds.index(UNKNOWN) if UNKNOWN in kinds else 0, normal)
    m.user = longest_first(own)
    for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
        if k == BYTE:
            m.byte_ids[int(p[3:5], 16)] = i
        elif k in (NORMAL, USER) or k == UNUSED and bpe:
            m.ids[p] = i
    m.dearest = float(min([m.scores[i] for i in range(len(pieces)) if kinds[i] == NORMAL], default=0.0))
    order = {s: r for r, s in enumerate(sorted({m.scores[i] for i in m.ids.values()}, reverse=True))}
    n = len(pieces)
    m.rank, m.left, m.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for p, i in m.ids.items():
        m.rank[i] = order[m.scores[i]]
    usable = {}
    pairs: dict[int, int] = {}
    single = [i for p, i in m.ids.items() if len(p) == 1]
    for p, i in m.ids.items():
        if kinds[i] == USER and len(p) > 1:
            continue
        if bpe and len(p) > 1:
            trace: dict[str, tuple[str, str]] = {}
            if m.merges(p, trace) == [i]:
                m.left[i], m.right[i] = m.ids[trace[p][0]], m.ids[trace[p][1]]
                usable[p] = i
            for k in range(1, len(p)):
                a, b = m.ids.get(p[:k]), m.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = int(m.rank[i])
        else:
            usable[p] = i
    m.rank[single] = -1
    _lexicon(m, usable)
    keys = np.array(sorted(pairs), np.uint64)
    m.pair_keys, m.pair_rank = keys, np.array([pairs[int(k)] for k in keys], np.int64)
    m.pair_present = np.zeros(SLOTS, bool)
    if len(keys):
        m.pair_present[_slot(keys)] = True
    later = re.escape(mark)
    m.cut = "before" if not any(re.search(f"[^{later}]{later}", p) for p in usable) else "after" if not any(re.search(f"{later}[^{later}]", p) for p in usable) else ""
    m.cut_lines = not any(len(p) > 1 and "\n" in p for p in usable)
    return m


def _pair_rank(m: Fst, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of the merge of two pieces; NO_RANK where there is none."""
    out = np.full(len(a), NO_RANK)
    key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
    at = np.flatnonzero(m.pair_present[_slot(key)])
    if len(at):
        k = np.minimum(np.searchsorted(m.pair_keys, key[at]), len(m.pair_keys) - 1)
        hit = m.pair_keys[k] == key[at]
        out[at[hit]] = m.pair_rank[k[hit]]
    return out


def may_stand(m: Fst, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the merges leave piece a followed by piece b (weight 0, else infinity)."""
    ok = np.ones(len(a), bool)
    live = np.arange(len(a))
    limit = np.full(len(a), 2 * NO_RANK)
    while len(live):
        bad = 2 * _pair_rank(m, a, b) < limit
        ok[live[bad]] = False
        ra, rb = m.rank[a], m.rank[b]
        go = ~bad & ((ra >= 0) | (rb >= 0))
        live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
        undo_left = ra > rb
        limit = np.where(undo_left, 2 * ra, 2 * rb + 1)  # of equal merges the left one comes first
        a, b = np.where(undo_left, m.right[a], a), np.where(undo_left, b, m.left[b])
    return ok


def compose(m: Fst, words: list[str]) -> list[list[int]]:
    """Shortest path of each word's lattice; ids of pieces, minus the code point less 1 for unknown characters."""
    out: list[list[int]] = [[] for _ in words]
    rest = sorted((i for i in range(len(words)) if words[i]), key=lambda i: -len(words[i]))
    lo = 0
    while lo < len(rest):  # words of like length side by side
        width = len(words[rest[lo]])
        group = rest[lo : lo + max(1, 400_000 // width)]
        lo += len(group)
        size = np.array([len(words[i]) for i in group])
        n = len(group)
        codes = np.zeros((width, n), np.int64)
        codes.T[np.arange(width) < size[:, None]] = np.frombuffer("".join([words[i] for i in group]).encode("utf-32-le", "surrogatepass"), "<u4")
        last = np.full((width + 1, n), -1, np.int64)  # the last arc of the shortest path to each position, and how far it reads
        step = np.zeros((width + 1, n), np.int32)
        cost = np.zeros((width + 1, n)) if not m.bpe else None
        live = np.searchsorted(-size, -np.arange(width), side="left")  # words with more than t characters
        word = begin = state = np.zeros(0, np.int64)  # walks through the lexicon that are under way
        for t in range(width):
            k = int(live[t])
            on = word < k
            word, begin = np.concatenate((word[on], np.arange(k))), np.concatenate((begin[on], np.full(k, t)))
            state = m.follow(np.concatenate((state[on], np.zeros(k, np.int64))), codes[t, word])
            on = state >= 0
            word, begin, state = word[on], begin[on], state[on]
            piece = m.final[state]
            arc = np.flatnonzero(piece >= 0)  # the longest first
            w, f, p = word[arc], begin[arc], piece[arc]
            if m.bpe:
                before = last[f, w]
                good = np.ones(len(w), bool)
                bound = np.flatnonzero((before >= 0) & (f > 0))  # an unknown character stands beside anything
                good[bound] = may_stand(m, before[bound], p[bound])
                w, f, p = w[good], f[good], p[good]
                stuck = np.ones(k, bool)
                stuck[w] = False
                last[t + 1, w], step[t + 1, w] = p, t + 1 - f
                x = np.flatnonzero(stuck)
                last[t + 1, x], step[t + 1, x] = -1 - codes[t, x], 1
            else:
                alone = np.ones(k, bool)
                alone[w[f == t]] = False
                x = np.flatnonzero(alone)
                w, f, p = np.concatenate((w, x)), np.concatenate((f, np.full(len(x), t))), np.concatenate((p, -1 - codes[t, x]))
                new = cost[f, w] + np.where(p >= 0, -m.scores[np.maximum(p, 0)], UNKNOWN_COST - m.dearest)
                order = np.lexsort((f, new, w))
                best = order[np.flatnonzero(np.diff(w[order], prepend=-1))]
                cost[t + 1, w[best]], last[t + 1, w[best]], step[t + 1, w[best]] = new[best], p[best], t + 1 - f[best]
        where, rows, back = size.copy(), np.arange(n), []
        while len(rows):
            at = where[rows]
            back.append((rows, last[at, rows]))
            where[rows] = at - step[at, rows]
            rows = rows[where[rows] > 0]
        whose, what = np.concatenate([r for r, _ in back[::-1]]), np.concatenate([p for _, p in back[::-1]])
        order = np.argsort(whose, kind="stable")
        ends = np.cumsum(np.bincount(whose, minlength=n))
        what = what[order].tolist()
        for i, a, z in zip(group, (ends - np.bincount(whose, minlength=n)).tolist(), ends.tolist(), strict=True):
            out[i] = what[a:z]
    return out


class Coder:
    """Encodes and decodes batches; keeps the words seen, up to ``cache_words``."""

    def __init__(self, model: Fst, cache_words: int = 300_000):
        self.m, self.cache, self.cache_words = model, {}, cache_words
        self.bytes_of = [b"" if k == CONTROL else " \u2047 ".encode() if k == UNKNOWN else p.replace(model.normal.mark, " ").encode() for p, k in zip(model.pieces, model.kinds.tolist(), strict=True)]
        for b, i in enumerate(model.byte_ids):
            if i >= 0:
                self.bytes_of[i] = bytes([b])
        self.user = {p: np.array([i], "<i4").tobytes() for p, i in model.ids.items() if model.kinds[i] == USER}
        mark = re.escape(model.normal.mark)
        ends = {"before": f"[^{mark}](?={mark})", "after": f"{mark}(?=[^{mark}])"}.get(model.cut, "")
        # Words are runs up to the next place where no piece can cross.
        self.word = re.compile({"before": f"{mark}*[^{mark}{{0}}]+|{mark}+", "after": f"[^{mark}{{0}}]*{mark}+|[^{mark}{{0}}]+"}[model.cut].replace("{0}", "\n" if model.cut_lines else "") + ("|\n" if model.cut_lines else "")) if ends else None

    def _written(self, path: list[int]) -> bytes:
        ids: list[int] = []
        todo = path[::-1]
        while todo:
            p = todo.pop()
            if p >= 0 and self.m.kinds[p] == UNUSED:  # taken apart into what it was merged from
                todo += [int(self.m.right[p]), int(self.m.left[p])]
            elif p >= 0:
                ids.append(p)
            elif self.m.byte_ids[0] >= 0:
                ids += [int(self.m.byte_ids[x]) for x in chr(-1 - p).encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.m.unk)
        return np.array(ids, "<i4").tobytes()

    def words(self, text: str) -> list[str]:
        """The normalised text, cut where no piece can cross; user-defined pieces stand alone."""
        s = self.m.normal(text)
        if not s:
            return []
        if self.m.user is None:
            return self.word.findall(s) if self.word else [s]
        out: list[str] = []
        at = 0
        for u in self.m.user.finditer(s):
            out += [*(self.word.findall(s[at : u.start()]) if self.word else [s[at : u.start()]]), u[0]]
            at = u.end()
        return [w for w in out + (self.word.findall(s[at:]) if self.word else [s[at:]]) if w]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian 32-bit numbers."""
        cut = [self.words(t) for t in texts]
        every = set().union(*cut)
        new = list(every - self.cache.keys())
        if len(self.cache) + len(new) > self.cache_words:
            self.cache.clear()
            new = list(every)
        plain = [w for w in new if w not in self.user]
        self.cache |= {w: self.user[w] for w in new if w in self.user}
        for w, path in zip(plain, compose(self.m, plain), strict=True):
            self.cache[w] = self._written(path)
        get = self.cache.__getitem__
        coded = [b"".join(map(get, ws)) for ws in cut]
        return coded if self.m.byte_ids[0] >= 0 else [self._once(c) for c in coded]

    def _once(self, coded: bytes) -> bytes:
        """Runs of unknown characters are one unknown piece."""
        ids = np.frombuffer(coded, "<i4")
        again = np.concatenate(([False], (ids[1:] == self.m.unk) & (ids[:-1] == self.m.unk)))[: len(ids)]
        return ids[~again].tobytes()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        first = next((i for i in ids if self.m.kinds[i] != CONTROL), self.m.unk)
        return text if self.m.kinds[first] == UNKNOWN else self.m.normal.stripped(text)


_CODERS: dict[str, Coder] = {}


def _coder(key: str, model: Fst) -> Coder:
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(model)
    return _CODERS[key]


def encode(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None, with_ids: bool = True, check: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_byte_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit numbers), the
    ids if asked, and with ``check`` whether decoding gives the (normalised) text back."""
    key = hashlib.sha256(model).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(compile_model(model))  # a few MB, set by the vocabulary
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("n_byte_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType())]
    fields += [T.StructField("token_ids", T.ArrayType(T.IntegerType()))] * with_ids + [T.StructField("round_trip", T.BooleanType())] * check

    def run(texts: list[str]) -> list[pa.Array]:
        coder = _coder(key, shared.value)
        coded = coder.encode(texts)
        is_byte = np.zeros(len(coder.m.pieces), bool)
        is_byte[coder.m.byte_ids[coder.m.byte_ids >= 0]] = True
        ids = np.frombuffer(b"".join(coded), "<i4")
        ends = np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)
        sums = np.concatenate(([0], np.cumsum(is_byte[ids])))[np.concatenate(([0], ends))]
        out = [pa.array(np.diff(ends, prepend=0)), pa.array(np.diff(sums).astype(np.int64)), pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string())]
        if with_ids:
            out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids)))
        if check:
            out.append(pa.array([coder.decode(np.frombuffer(c, "<i4").tolist()) == (coder.m.normal.plain(t) if coder.m.normal.first or coder.m.normal.squeeze else t) for c, t in zip(coded, texts, strict=True)], pa.bool_()))
        return out

    return base.map_text(docs, text_col, run, fields, docs.columns if keep is None else keep)


def decode(df: DataFrame, model: bytes, ids_col: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``decoded`` (null for null ids)."""
    key = hashlib.sha256(model).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(compile_model(model))
    keep = [c for c in (df.columns if keep is None else keep) if c != "decoded"]
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + [T.StructField("decoded", T.StringType())])

    def run(batches):
        for b in batches:
            coder = _coder(key, shared.value)
            texts = [None if v is None else coder.decode([x for x in v if x is not None]) for v in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string())], names=schema.names)

    return df.select(*[F.col(base.quoted(c)) for c in keep], F.col(base.quoted(ids_col)).alias("__ids__")).mapInArrow(run, schema)


def read_model(spark, path: str) -> bytes:
    """The model's bytes, by the driver: from its own disk, or from any store that Spark reads."""
    import os

    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return spark.read.format("binaryFile").load(path).head()["content"]
