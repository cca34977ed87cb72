"""Near duplicates by SimHash fingerprints and vantage-point trees.

A text's fingerprint takes the majority of each bit over the XXH64 hashes (seed 42) of its word shingles. Equal
fingerprints are one class before any pair is looked at. Two classes link where their fingerprints differ in at most
``max_bits`` bits.

Shards: the 64 bits are cut into b blocks. Of two fingerprints within max_bits, at least b - max_bits blocks are equal, so
for each choice of that many blocks the Hamming distance over those blocks alone (a pseudo-metric below the full one) puts
both into the same ball of radius 0 around it. Each class enters one ball for each choice, so that balls overlap and no link is
lost. b grows with the number of classes (5 below two million) to keep balls small; the links are the same for any b.
(Balls of the full distance do not shard fingerprints that are nearly random: two in three lie within 4 bits of
any vantage point's median distance, so that each halving would send two thirds of the queries both ways; see the README.)
Inside every ball a vantage-point tree halves the fingerprints by their full distance to a vantage point; queries go to both halves
where the boundary is within ``max_bits``, and branches that the triangle bound excludes are skipped. The trees of all balls of a
batch grow side by side. Balls of over ``ball_rows`` classes are dealt as pairs of parts over several tasks.
A ball gives the edges of a spanning forest, never all pairs of a group.

Near copies (``copies``) are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, counted exactly.
Candidates come from fingerprints over single words, where edits move few bits, and over shingles, a cheap way through large groups;
and, as an inserted passage moves both far, from an exact prefix filter on the shingle sets, in which
fingerprints of 256 bits rule out unlike pairs before any sets are fetched.

Edge cases: null and empty texts have fingerprint zero and link like any other; repeated rows and equal texts share a
class; an empty table gives an empty result; a null id takes part, and its component is the least id that is not null;
rows that share an id and differ in text are told apart by both; extra columns do not matter.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base
from .components import components, roots

#: Characters whose shingles are held as objects at once, unless a single text is longer; rows of sets likewise; pairs compared at once.
SET_CHARS = 1 << 17
SET_ROWS = 256
PAIRS = 1 << 18


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every shingle, repeats included. bytes.lower and bytes.split know just A-Z and the six ASCII white spaces."""
    digest = xxhash.xxh64_intdigest
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return []
    if words == 1:
        return [digest(x, 42) for x in w]
    joined = b" ".join(w)
    if len(w) <= words:
        return [digest(joined, 42)]
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = np.concatenate(([0], ends[:-words])).tolist()
    return [digest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each list; zero for an empty one."""
    n = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        bits = np.unpackbits(np.array([x for h in hashes for x in h], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, np.cumsum(n[full]) - n[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: list[str], words: int = 4) -> np.ndarray:
    return majority([shingle_hashes(t, words) for t in texts])


def with_fingerprint(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, words: int = 4) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed long)."""
    return base.map_text(docs, text_col, lambda texts: [pa.array(fingerprints(texts, words).view(np.int64))], [T.StructField("fp", T.LongType())], docs.columns if keep is None else keep)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def tree_links(ball: np.ndarray, fps: np.ndarray, radius: int, second: np.ndarray, second_radius: int, leaf: int = 8, block: int = PAIRS):
    """Index pairs that connect all rows of the same ball within both radii of each other, by a vantage-point tree for each ball.

    All trees grow together, a level at a time. A node's first row is its vantage point; its rows are halved at the median distance
    to it. Queries visit the inner half if their distance is at most the median plus the radius, and the outer half if it
    is over the median less the radius. In a leaf each query gives a pair with the first row near it, and the rows near one query are paired with
    each other's first.
    """
    start = np.flatnonzero(np.diff(ball, prepend=-1) != 0) if len(ball) else np.zeros(0, np.int64)
    node = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(ball))))
    members, queries = np.arange(len(ball)), np.arange(len(ball))
    m_node, q_node = node, node.copy()
    while len(members):
        n = int(m_node[-1]) + 1
        size = np.bincount(m_node, minlength=n)
        first = np.cumsum(size) - size
        vantage = fps[members[first[np.minimum(np.arange(n), n - 1)] * (size > 0)]]
        d, q = distance(fps[members], vantage[m_node]).astype(np.int64), distance(fps[queries], vantage[q_node]).astype(np.int64)
        order = np.lexsort((d, m_node))
        members, d = members[order], d[order]
        middle = d[np.minimum(first + (size - 1) // 2, len(d) - 1)]
        top = d[np.minimum(first + np.maximum(size, 1) - 1, len(d) - 1)]
        split = (size > leaf) & (top > middle)
        # Leaves: every query against every row, in blocks.
        on = np.flatnonzero(~split[q_node] & (size[q_node] > 0))
        each = size[q_node[on]]
        lo = 0
        sums = np.cumsum(each)
        while lo < len(on):
            hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + block, side="right")))
            part, k = on[lo:hi], each[lo:hi]
            row = np.repeat(np.arange(len(part)), k)
            at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[q_node[part]], k)
            x, y = queries[part][row], members[at]
            near = distance(fps[x], fps[y]) <= radius
            if second_radius < 64:
                near &= distance(second[x], second[y]) <= second_radius
            row, x, y = row[near], x[near], y[near]
            if len(row):
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                lead = np.repeat(y[begins], np.diff(np.append(begins, len(row))))
                yield x[begins], y[begins]
                both = np.unique(lead * len(fps) + y)
                yield both // len(fps), both % len(fps)
            lo = hi
        # The others: two nodes each.
        m_on, q_on = split[m_node], split[q_node]
        outer = d > middle[m_node]
        m_new = (2 * m_node + outer)[m_on]
        inner_q, outer_q = q_on & (q <= middle[q_node] + radius), q_on & (q > middle[q_node] - radius)
        q_new = np.concatenate((2 * q_node[inner_q], 2 * q_node[outer_q] + 1))
        members, queries = members[m_on], np.concatenate((queries[inner_q], queries[outer_q]))
        kept, m_new = np.unique(m_new, return_inverse=True)  # numbered anew, without empty nodes
        at = np.searchsorted(kept, q_new)
        fits = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == q_new) if len(kept) else np.zeros(len(q_new), bool)
        order = np.argsort(m_new, kind="stable")
        members, m_node, queries, q_node = members[order], m_new[order], queries[fits], at[fits]


def forest(fps: np.ndarray, radius: int, second: np.ndarray, second_radius: int, ball: np.ndarray | None = None) -> np.ndarray:
    """Index of the root of each row's component under links within both radii in one ball."""
    ball = np.zeros(len(fps), np.int64) if ball is None else ball
    root = np.arange(len(fps))
    for a, b in tree_links(ball, fps, radius, second, second_radius):
        on = root[a] != root[b]
        if on.any():
            root = roots(len(fps), np.concatenate((np.arange(len(fps)), a[on])), np.concatenate((root, b[on])))
    return root


def _ball_edges(max_bits: int, second_bits: int):
    def run(batches):
        held = None
        for b in _and_last(batches):
            now = None if b is None else np.stack([b.column(i).to_numpy() for i in range(5)])
            both = held if now is None else now if held is None else np.concatenate([held, now], axis=1)
            if both is None or not both.shape[1]:
                continue
            ball = (both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])
            cut = both.shape[1] if now is None else (np.flatnonzero(ball)[-1] + 1 if ball.any() else 0)
            held, done = both[:, cut:], np.ascontiguousarray(both[:, :cut])
            if not cut:
                continue
            group = np.concatenate(([0], np.cumsum(ball[: cut - 1])))
            alone = np.bincount(group)[group] == 1
            done, group = np.ascontiguousarray(done[:, ~alone]), group[~alone]
            root = forest(done[2].view(np.uint64), max_bits, done[3].view(np.uint64), second_bits, group)
            at = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(done[4][at]), pa.array(done[4][root[at]])], names=["a", "b"])

    return run


def _and_last(batches):
    yield from batches
    yield None


def links(classes: DataFrame, max_bits: int = 4, second_bits: int = 64, ball_rows: int = 8192, blocks: int | None = None) -> DataFrame:
    """Edges (a, b) that connect the rows of ``classes`` (fp, fp2, id) with fp within ``max_bits`` and fp2 within ``second_bits``."""
    if blocks is None:
        n = classes.count()
        blocks = max_bits + (1 if n < 2e6 else 2 if n < 3e8 else 3) + (max_bits > 5)
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    masks = [sum(((1 << int(edges[i + 1])) - (1 << int(edges[i]))) for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    ball = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])).alias("ball")
    dealt = classes.select("fp", "fp2", "id", ball)
    hot = dealt.groupBy("ball").count().filter(F.col("count") > ball_rows).select("ball", F.ceil(F.col("count") / ball_rows).cast("int").alias("parts"))
    with_parts = dealt.join(hot, "ball", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    # A part meets every part once: the pair (i, j), i <= j, has the number i * parts + j.
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(F.col("own"), j) * F.col("parts") + F.greatest(F.col("own"), j))).alias("pair")
    rows = with_parts.withColumn("own", own).select("ball", pair, "fp", "fp2", "id").select("ball", F.col("pair").cast("long").alias("pair"), "fp", "fp2", "id")
    return rows.repartition("ball", "pair").sortWithinPartitions("ball", "pair").mapInArrow(_ball_edges(max_bits, second_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """The id, ``fp`` (signed long) and ``component_id``, the least id reachable, for every row. Ids are integers."""
    marked = base.materialised(with_fingerprint(docs, text_col, [id_col], words))
    classes = base.materialised(marked.groupBy("fp").agg(F.min(F.col(base.quoted(id_col)).cast("long")).alias("least")))
    nodes = classes.select("fp", F.lit(0).cast("long").alias("fp2"), F.col("fp").alias("id"))
    found = components(links(nodes, max_bits), joined_up=True)
    of_class = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    of_class = base.materialised(of_class)
    least = of_class.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    named = of_class.join(least, F.col("component") == F.col("c")).select(F.col("fp").alias("__fp__"), "component_id")
    return marked.join(named, F.col("fp") == F.col("__fp__"), "left").drop("__fp__")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays without repeats; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / union if (union := len(a) + len(b) - both) else 1.0


SKETCH = ("fp2", "s1", "s2", "s3")  # 256 bits of fingerprint over shingles


def sketches(shingles: list[list[int]]) -> list[np.ndarray]:
    """Four fingerprints of each set, over as many hashes of its shingles; the first is the plain one."""
    flat = np.array([x for h in shingles for x in h], np.uint64)
    ends = np.cumsum([len(h) for h in shingles])
    n = np.diff(ends, prepend=0)
    out = []
    for i in range(4):
        bits = np.unpackbits((flat if i == 0 else base.mixed(flat + np.uint64(i))).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        fps, full = np.zeros(len(shingles), np.uint64), np.flatnonzero(n)
        if len(full):
            ones = np.add.reduceat(bits, (ends - n)[full], axis=0, dtype=np.int64)
            fps[full] = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
        out.append(fps)
    return out


def _marks(words: int):
    """Fingerprints over distinct words and (four) over distinct shingles, and a hash and the size of the shingle set."""

    def run(texts: list[str]) -> list[pa.Array]:
        one, many = [list(set(shingle_hashes(t, 1))) for t in texts], [list(set(shingle_hashes(t, words))) for t in texts]
        content = np.array([base.mixed(np.array(h, np.uint64)).sum(dtype=np.uint64) for h in many], np.uint64)
        return [pa.array(x.view(np.int64)) for x in (majority(one), *sketches(many), content)] + [pa.array([len(h) for h in many], pa.int64())]

    return run


def _sets(words: int):
    def run(texts: list[str]) -> list[pa.Array]:
        many = [np.unique(np.array(shingle_hashes(t, words), np.uint64)) for t in texts]
        return [pa.array(majority([h.tolist() for h in many]).view(np.int64)), pa.array([h.tobytes() for h in many], pa.binary())]

    return run


def _near_open(least: float, max_bits: int):
    """Edges (a, b) of near pairs of an open row (they come first in each task's group) and any row, less those that join nothing new."""

    def run(batches):
        now, open_rows, joined = None, [], None
        for batch in (b.slice(lo, SET_ROWS) for b in batches for lo in range(0, b.num_rows, SET_ROWS)):
            edges = []
            for group, task, member, covered, id_, fp, raw in zip(*[batch.column(c).to_pylist() for c in ("comp", "task", "member", "covered", "id", "fp2", "shingles")], strict=True):
                if (group, task) != now:
                    now, open_rows, joined = (group, task), [], None
                own = np.frombuffer(raw, "<u8")
                if not member:
                    open_rows.append((id_, fp, own))
                    continue
                if joined is None:  # node 0 stands for all rows that are near the leader
                    ids = {x[0]: i + 1 for i, x in enumerate(open_rows)}
                    fps, sizes = np.array([x[1] for x in open_rows], np.int64).view(np.uint64), np.array([len(x[2]) for x in open_rows])
                    joined = _Union(len(open_rows) + 1)
                if covered:
                    node = 0
                elif id_ in ids:
                    node = ids[id_]
                else:
                    node = ids[id_] = len(joined.up)
                    joined.up.append(node)
                fit = (distance(fps, np.array([fp], np.int64).view(np.uint64)) <= max_bits) & (np.minimum(sizes, len(own)) >= least * np.maximum(sizes, len(own)))
                for i in np.flatnonzero(fit).tolist():
                    other = open_rows[i]
                    if joined.find(node) != joined.find(i + 1) and similarity(own, other[2]) >= least:
                        joined.join(node, i + 1)
                        edges.append((id_, other[0]))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _against(rows: DataFrame, known: bool, least: float, max_bits: int, task_bytes: int, least_bytes: int) -> DataFrame:
    """Edges (a, b) between ``rows`` (comp, id, fp2, shingles) and those of their group that are ``open``, of which the group has ``n_open`` bytes of ``n_all``.

    A group's open rows are cut into parts of about ``task_bytes``, and the rows they are held against into slices as large as its open
    rows (between ``least_bytes`` and ``task_bytes``): a group spreads over many tasks, and open rows are copied once for a slice.
    Rows that are not open count as connected to each other if ``known``.
    """
    slice_bytes = F.greatest(F.lit(least_bytes), F.least(F.col("n_open"), F.lit(task_bytes)))
    rows = rows.withColumns({"parts": F.ceil(F.col("n_open") / task_bytes).cast("int"), "slices": F.ceil(F.col("n_all") / slice_bytes).cast("int")})
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int") * F.col("slices")
    mine = F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int")
    place = lambda member: lambda task: F.struct(task.alias("task"), F.lit(member).alias("member"))
    held = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: place(True)(i * F.col("slices") + mine))
    copied = F.when(F.col("open"), F.transform(F.sequence(own, own + F.col("slices") - 1), place(False))).otherwise(F.array().cast("array<struct<task:int,member:boolean>>"))
    covered = (~F.col("open") & F.lit(known)).alias("covered")
    # Both roles of a row in one pass: the sets are shuffled once.
    dealt = rows.select("comp", F.explode(F.concat(held, copied)).alias("at"), covered, "id", "fp2", "shingles").select("comp", "at.task", "at.member", "covered", "id", "fp2", "shingles")
    return dealt.repartition("comp", "task").sortWithinPartitions("comp", "task", "member").mapInArrow(_near_open(least, max_bits), "a long, b long")


def near_pairs(docs: DataFrame, groups: DataFrame, words: int, least: float, max_bits: int, task_bytes: int = 1 << 24, least_bytes: int = 1 << 18) -> DataFrame:
    """Edges (a, b) that connect the rows of ``docs`` (id, text) in the same group of ``groups`` (id, comp) whose shingle sets have
    at least that similarity.

    First every row is held against its group's leader, the least id: one pass, however large the group. Only rows that are
    not near it stay open, and only pairs with an open row are looked at again (fingerprints within ``max_bits`` and fitting
    sizes, then exactly): other pairs are connected through the leader. Sizes are worked out on a narrow table, without the sets.
    """
    sized = base.map_text(docs.join(groups, "id"), "text", _sets(words), [T.StructField("fp2", T.LongType()), T.StructField("shingles", T.BinaryType())], ["comp", "id"], SET_CHARS)
    sets = base.materialised(sized)
    bytes_ = base.materialised(sets.groupBy("comp", "id").agg(F.sum(F.octet_length("shingles") + 64).alias("n")))
    led = base.materialised(bytes_.groupBy("comp").agg(F.min("id").alias("leader"), F.min_by("n", "id").alias("n_open"), F.sum("n").alias("n_all")))
    first = base.materialised(_against(sets.join(led, "comp").withColumn("open", F.col("id") == F.col("leader")), False, least, max_bits, task_bytes, least_bytes))
    # An edge's second end is the leader.
    near = first.select(F.col("a").alias("id")).union(led.select(F.col("leader").alias("id")))
    rest = base.materialised(bytes_.join(near, "id", "left_anti"))
    again = rest.groupBy("comp").agg(F.sum("n").alias("n_open")).join(led.select("comp", "n_all"), "comp")
    rows = sets.join(again, "comp").join(rest.select("id", F.lit(True).alias("open")), "id", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    more = base.materialised(_against(rows, True, least, max_bits, task_bytes, least_bytes))
    base.dropped(sets, bytes_)
    return first.unionByName(more)


def common_shingles(texts: DataFrame, words: int, sample: int = 20_000, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that at least three of about ``sample`` texts hold, sorted, and how many do. They only order the shingles."""
    n = texts.count()
    some = texts.filter(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_000)) < F.lit(1_000_000 * sample / max(n, sample)))
    each = _shingle_rows(some, lambda t: np.unique(np.array(shingle_hashes(t, words), np.uint64)))
    top = each.groupBy("h").count().filter("count > 2").orderBy(F.desc("count"), "h").limit(most).toArrow()  # 16 bytes a row, without an object for each
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("count").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def prefix(shingles: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest shingles of a set, as many as two sets with at least that similarity must share one of (in any fixed order)."""
    known, counts = common
    n = np.zeros(len(shingles), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        n = np.where(known[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, n))[: len(shingles) - int(np.ceil(least * len(shingles) - 1e-9)) + 1]] if len(shingles) else shingles


def _shingle_rows(texts: DataFrame, chosen) -> DataFrame:
    """(h, id) for every shingle that ``chosen`` takes of each row of ``texts`` (id, text)."""

    def run(batches):
        for b in batches:
            for lo, hi, raw in base.pieces(b.column(1), SET_CHARS):
                own = [chosen(t) for t in raw]
                at = np.repeat(np.arange(lo, hi), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).astype(np.uint64).view(np.int64)), b.column(0).take(pa.array(at))], names=["h", "id"])

    return texts.select("id", "text").mapInArrow(run, "h long, id long")


def _shared(batches):
    """Rows (h, id), sorted by h, whose h does not stand alone."""
    held = None
    for b in _and_last(batches):
        now = None if b is None else np.stack([b.column(i).to_numpy() for i in range(2)])
        both = held if now is None else now if held is None else np.concatenate([held, now], axis=1)
        if both is None or not both.shape[1]:
            continue
        same = both[0, 1:] == both[0, :-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
        if now is None:
            held = None
        else:  # of the last h one row or two tell enough: all before them are out
            more = bool(keep[-1])
            held = both[:, -1:]
            keep[-1] = False
            if more:
                held = np.concatenate([both[:, -2:-1], held], axis=1)
                keep[-2] = False
        yield pa.RecordBatch.from_arrays([pa.array(both[i, keep]) for i in range(2)], names=["h", "id"])


def _cross_pairs(least: float, max_bits: int, small_bits: int, small: int, few: int = 64):
    """A spanning forest (a, b) of the pairs in one list of rows (h, pair, id, n, comp and the sketch, lists in one piece) that may be
    near and are not connected yet: never more edges than rows. Lists of up to ``few`` rows are paired together, row by distance in the table; longer ones each by itself, in blocks.
    """

    def good(rows: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        low, high = np.minimum(rows[3, x], rows[3, y]), np.maximum(rows[3, x], rows[3, y])
        on = (rows[4, x] != rows[4, y]) & (low >= least * high - 1e-9) & (rows[2, x] != rows[2, y])
        x, y, low = x[on], y[on], low[on]
        bits = sum(np.bitwise_count((rows[k, x] ^ rows[k, y]).view(np.uint64)).astype(np.int64) for k in range(5, 9))
        near = bits <= np.where(low < small, small_bits, max_bits)
        return x[near], y[near]

    def run(batches):
        held = None
        for b in _and_last(batches):
            now = None if b is None else np.stack([b.column(i).to_numpy() for i in range(9)])
            both = held if now is None else now if held is None else np.concatenate([held, now], axis=1)
            if both is None or not both.shape[1]:
                continue
            edge = np.flatnonzero((both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])) + 1
            cut = both.shape[1] if now is None else (int(edge[-1]) if len(edge) else 0)
            held, done = both[:, cut:], both[:, :cut]
            begin = np.concatenate(([0], edge[edge < cut])) if cut else np.zeros(0, np.int64)
            size = np.diff(np.append(begin, cut))
            group = np.repeat(np.arange(len(begin)), size)
            short, root = np.flatnonzero(size[group] <= few), np.arange(cut)
            some, group, a, b = done[:, short], group[short], [], []
            for lag in range(1, few):
                x = np.flatnonzero(group[lag:] == group[:-lag])
                if not len(x):
                    break
                x, y = good(some, x, x + lag)
                a.append(short[x])
                b.append(short[y])
            if a:
                root = roots(cut, np.concatenate(a), np.concatenate(b))
            for lo, n in zip(begin[size > few].tolist(), size[size > few].tolist(), strict=True):
                rows = done[:, lo : lo + n]
                if (rows[4] == rows[4, 0]).all():
                    continue
                step = max(1, PAIRS // n)
                for at in range(0, n, step):
                    x, y = np.nonzero(np.arange(at, min(at + step, n))[:, None] > np.arange(n)[None, :])
                    x, y = good(rows, x + at, y)
                    own = root[lo : lo + n] - lo
                    root[lo : lo + n] = roots(n, np.concatenate((np.arange(n), x)), np.concatenate((own, y))) + lo
            at = np.flatnonzero(root != np.arange(cut))
            pairs = np.unique(np.stack([done[2, at], done[2, root[at]]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


def prefix_pairs(texts: DataFrame, known: DataFrame, words: int, least: float, list_rows: int = 1024, max_bits: int = 78, small_bits: int = 100, small: int = 32) -> DataFrame:
    """Edges (a, b) of all near pairs of ``texts`` (id, text) that ``known`` (id, n, comp and the four parts of ``SKETCH``) does not connect yet.

    Sets of at least that similarity share one of their rarest shingles (``prefix``), whatever was edited. Rows with such a
    shingle in common form a list; a pair in it may be near if its components differ, the sizes fit and the sketches of 256 bits differ in
    at most ``max_bits`` bits (``small_bits`` where one has under ``small`` shingles). At similarity 0.8 bits differ with a probability of 0.15, 39 of them on average
    with a standard deviation of 5.7, so that the bound lies six of these beyond; in unlike sets 128 differ.
    Lists of over ``list_rows`` rows are dealt as pairs of parts; lists within one component are left out. A list gives a forest of its pairs, and what the
    forests connect are groups in which ``near_pairs`` counts exactly, so that large groups of near texts never become a table of pairs.
    """
    common = common_shingles(texts, words)
    rows = _shingle_rows(texts, lambda t: prefix(np.unique(np.array(shingle_hashes(t, words), np.uint64)), least, common))
    shared = base.materialised(rows.repartition("h").sortWithinPartitions("h").mapInArrow(_shared, "h long, id long"))
    listed = base.materialised(shared.join(known, "id").select("h", "id", "n", "comp", *SKETCH))
    base.dropped(shared)
    sizes = listed.groupBy("h").agg(F.count("*").alias("c"), (F.min("comp") != F.max("comp")).alias("open")).filter("open")
    parts = listed.join(base.materialised(sizes.select("h", F.ceil(F.col("c") / list_rows).cast("int").alias("parts"))), "h")
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(F.col("own"), j) * F.col("parts") + F.greatest(F.col("own"), j))).alias("pair")
    dealt = parts.withColumn("own", own).select("h", pair, "id", "n", "comp", *SKETCH).withColumn("pair", F.col("pair").cast("long"))
    pairs = base.materialised(dealt.repartition("h", "pair").sortWithinPartitions("h", "pair").mapInArrow(_cross_pairs(least, max_bits, small_bits, small), "a long, b long").distinct())
    base.dropped(listed)
    return near_pairs(texts, _groups(components(pairs, joined_up=True)), words, least, 32)


def _groups(found: DataFrame) -> DataFrame:
    """(id, comp) of all rows of components. A group's leader is its least node, which is a row of ``found`` only as a component."""
    comp = F.col("component")
    return found.select(F.col("node").alias("id"), comp.alias("comp")).union(found.select(comp.alias("id"), comp.alias("comp"))).distinct()


def row_key(df: DataFrame, id_col: str, text_col: str):
    """A hash of a row's id and text."""
    i, t = F.col(base.quoted(id_col)), F.col(base.quoted(text_col))
    return F.xxhash64(i.isNull(), t.isNull(), i, t)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8, max_bits: int = 7, second_bits: int = 16) -> DataFrame:
    """(row_key, id, component_id, stays) for every row: near copies are texts whose sets of ``words``-word shingles have a Jaccard
    similarity of ``least`` or more, counted exactly, and all that are connected through such pairs.

    ``component_id`` is the least id of the group that is not null. ``stays`` marks one id and text of each group: the least id (a null one only where
    there is no other), then the least key; repeated rows of both share the mark.

    First candidates are texts whose fingerprints over distinct words differ in at most ``max_bits`` bits and those over distinct
    shingles in at most ``second_bits`` (at similarity 0.8 the latter differ in 9.7 bits on average), or that are
    connected through such pairs: a cheap way through large groups. Pairs that these miss come from ``prefix_pairs``. Texts without words are copies of each other; texts under five words have one shingle.
    """
    long = T.LongType()
    side = docs.select(row_key(docs, id_col, text_col).alias("rk"), F.col(base.quoted(id_col)).cast("long").alias("id"), F.col(base.quoted(text_col)).alias("text"))
    key = ["fp", "fp2", "content", "n"]
    marked = base.materialised(base.map_text(side, "text", _marks(words), [T.StructField(c, long) for c in ("fp", *SKETCH, "content", "n")], ["rk", "id"], SET_CHARS))
    # A class's node is the key of its first row.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rk"))
    classes = base.materialised(marked.groupBy(*key).agg(first.alias("first"), *[F.min(c).alias(c) for c in SKETCH[1:]]).withColumn("id", F.col("first.rk")))
    loose = components(links(classes.select("fp", "fp2", "id"), max_bits, second_bits), joined_up=True)
    texts = side.select(F.col("rk").alias("id"), "text")
    close = components(near_pairs(texts, _groups(loose), words, least, second_bits + 6), joined_up=True)
    known = base.materialised(classes.filter("n > 0").join(close.withColumnRenamed("node", "id"), "id", "left").select("id", "n", F.coalesce("component", "id").alias("comp"), *SKETCH))
    more = prefix_pairs(base.materialised(texts.join(known.select("id"), "id", "left_semi")), known, words, least)
    found = components(close.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), joined_up=True)
    of_class = base.materialised(classes.join(found, F.col("id") == F.col("node"), "left").select(*[F.col(c).alias(f"__{c}") for c in key], "first", F.coalesce("component", "id").alias("comp")))
    best = of_class.groupBy(F.col("comp").alias("comp2")).agg(F.min("first").alias("best"))
    named = of_class.join(best, F.col("comp") == F.col("comp2"))
    out = marked.join(named, [F.col(c) == F.col(f"__{c}") for c in key])
    return out.select(F.col("rk").alias("row_key"), "id", F.col("best.id").alias("component_id"), (F.col("rk") == F.col("best.rk")).alias("stays"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``."""
    found = base.materialised(copies(docs, id_col, text_col, **options))
    keep = found.filter("stays").groupBy("row_key").agg(F.count("*").alias("times"))
    rows = docs.select(row_key(docs, id_col, text_col).alias("rk"), F.struct(*[F.col(base.quoted(c)) for c in docs.columns]).alias("row"))
    kept = rows.join(keep, F.col("rk") == F.col("row_key"))
    return kept.filter("times = 1").select("row").union(kept.filter("times > 1").dropDuplicates(["rk"]).select("row")).select("row.*")
