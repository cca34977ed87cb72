"""Exact repeats of long byte strings across a corpus, by longest previous factors in content-defined shards.

The factor of a position is the string of ``length`` bytes that starts there; it is a repeat if the longest previous
factor (or, when every copy goes, the longest factor starting anywhere else) reaches ``length``. Factors are dealt to
shards by their anchor, the k-byte string in them with the least hash (the leftmost of equals): equal factors have equal
anchors at equal offsets, so no shard needs another one. Neighbouring factors mostly share an anchor, so a shard's row is
a run of factors: the hash of the anchor, a digest of all bytes of the run, and where it lies.

1. One scan gives the runs (two for every ``length - k + 1`` bytes on average).
2. Runs whose anchor occurs once are dropped: counts by anchor, combined before their shuffle, and a join, whose hot
   anchors (a line repeated in a third of all texts) adaptive execution splits over several tasks.
3. Equal runs (same anchor, same bytes: 128 bits of two unrelated hashes) are one class; all factors of a class of two are repeats.
4. Where classes of one anchor differ, one run of each fetches its bytes. The shard's suffixes are put in order by
   their bytes to a depth of ``length``; among equal ones positions rise, so the entries before and after are the previous and the next
   smaller position, and the longest previous factor reaches ``length`` where the bytes agree.
5. Shards of over ``shard_runs`` runs are never held whole: their factors are dealt to narrower shards, of 17, then 4, then
   1 offset from the anchor, keyed by the bytes that all factors at these offsets share, until a shard is small or all its rows agree.
6. The intervals found are joined to the texts.

``longest_previous_factor`` is the uncut array for one string by the same order; the tests hold the job against it.

Edge cases: null and empty texts and texts shorter than ``length`` lose nothing; factors never cross texts; repeated rows
with the same id and text count as copies of each other (as one text with ``keep_first``); an empty table gives an empty result; extra columns do not matter.
A long text is scanned a megabyte at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
CHUNK_BYTES = 1 << 20
#: Offsets from the anchor that one shard covers, by round of splitting.
WIDTHS = (17, 4, 1)


def _powers(b: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, b, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = base.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_CACHE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _CACHE["up"], _CACHE["down"] = _powers(ODD, size), _powers(INVERSE, size)
    return _CACHE["up"][:n], _CACHE["down"][:n]


class Rolling:
    """Hashes of substrings, from running sums of byte values times rising powers."""

    def __init__(self, data: np.ndarray):
        up, self.down = _tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self.sums[1:])

    def at(self, starts, ends) -> np.ndarray:
        return base.mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return base.mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])


def anchored_runs(data: np.ndarray, starts: np.ndarray, length: int, k: int):
    """Runs of factors with one anchor, over texts joined without a gap (text i at starts[i]:starts[i + 1]).

    Per run: text, hash of the anchor, digest of the run's bytes, first factor (in the text), number of factors, and how far
    the anchor lies after the first factor.
    """
    n, w = len(data), length - k + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    anchor = Rolling(data).all(k)
    least = (anchor & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(anchor), dtype=np.uint64)
    have = 1
    while have < w:  # the least of every w neighbours, by doubling
        more = min(have, w - have)
        least = np.minimum(least[:-more], least[more:])
        have += more
    pos = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(starts)
    valid = np.zeros(len(pos) + 1, np.int8)
    long_texts = np.flatnonzero(size >= length)
    valid[starts[long_texts]] += 1
    np.add.at(valid, starts[long_texts] + size[long_texts] - length + 1, -1)
    inside = np.cumsum(valid[:-1], dtype=np.int8) > 0
    first = inside & np.concatenate(([True], (pos[1:] != pos[:-1]) | ~inside[:-1]))
    begin_text = np.zeros(len(pos), bool)
    begin_text[starts[long_texts]] = True
    first |= begin_text
    s = np.flatnonzero(first)
    ends_at = np.flatnonzero(inside & ~np.concatenate((inside[1:] & ~first[1:], [False]))) + 1
    text = np.searchsorted(starts, s, side="right") - 1
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    content = np.array([digest(view[a:b]) for a, b in zip(s.tolist(), (ends_at + length - 1).tolist(), strict=True)], np.uint64)
    return text, anchor[pos[s]], content, s - starts[text], ends_at - s, pos[s] - s


def _byte_chunks(raw: list[bytes]):
    lo = size = 0
    for i, r in enumerate(raw):
        if i > lo and size + len(r) > CHUNK_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(r)
    if lo < len(raw):
        yield lo, len(raw)


def _joined(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)


def pieces(raw: bytes, length: int, size: int) -> list[tuple[int, bytes]]:
    """(start, bytes) of a long text's parts; each factor lies in exactly one."""
    return [(at, raw[at : at + size + length - 1]) for at in range(0, max(1, len(raw) - length + 1), size)]


def runs(rows: DataFrame, length: int, k: int) -> DataFrame:
    """(rk, doc, h, content, place) of every run of rows (rk, doc, text); place packs first, n and lead as in ``unpacked``."""

    def scan(batches):
        for b in batches:
            cut = [(i, at, p) for i, t in enumerate(b.column(2).to_pylist()) for at, p in pieces((t or "").encode("utf-8", "surrogatepass"), length, CHUNK_BYTES)]
            row, begin, raw = np.array([c[0] for c in cut], np.int64), np.array([c[1] for c in cut], np.int64), [c[2] for c in cut]
            for lo, hi in _byte_chunks(raw):
                data, starts = _joined(raw[lo:hi])
                piece, h, content, first, n, lead = anchored_runs(data, starts, length, k)
                at = pa.array(row[piece + lo])
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(h.view(np.int64)), pa.array(content.view(np.int64)), pa.array((first + begin[piece + lo]) << 24 | n << 12 | lead)], names=["rk", "doc", "h", "content", "place"])

    return rows.select("rk", "doc", "text").mapInArrow(scan, "rk long, doc long, h long, content long, place long")


def unpacked(place: str) -> tuple[Column, Column]:
    """First factor and number of factors of a run."""
    return F.shiftright(place, 24), F.shiftright(place, 12).bitwiseAND(F.lit(4095))


def repeated_factors(data: np.ndarray, starts: np.ndarray, length: int, keep_first: bool) -> np.ndarray:
    """For the factors of several strings (all strings' factors in a row): whether an equal one lies elsewhere, or earlier if
    the first is kept. Strings come in the order in which their texts count.

    Factors whose rolling hash stands alone have no equal. The others are put in suffix order by their bytes.
    """
    n = np.diff(starts) - length + 1
    at = np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    key = Rolling(data).at(at, at + length)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    open_ = np.zeros(len(key), bool)
    open_[order[1:]] = same
    open_[order[:-1]] |= same
    out, asked = np.zeros(len(key), bool), np.flatnonzero(open_)
    if len(asked):
        suffix = np.lib.stride_tricks.sliding_window_view(data, length)[at[asked]].view(f"S{length}").ravel()
        order = np.argsort(suffix, kind="stable")  # equal suffixes by rising position
        same = suffix[order[1:]] == suffix[order[:-1]]
        out[asked[order[1:]]] = same  # the previous smaller position has the same factor
        if not keep_first:
            out[asked[order[:-1]]] |= same  # the next one has
    return out


ROW = "h long, content long, doc long, place long, lo int, lead int, shard long, block long, raw binary"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
NAMES = [c.split()[0] for c in ROW.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(KINDS)], names=NAMES)


def _resolver(length: int, keep_first: bool):
    """Repeated factors (h, content, a, z) of whole shards, which arrive one after the other."""

    def run(batches):
        held: pa.Table | None = None
        for b in _and_last(batches):
            if b is not None:
                now = pa.Table.from_batches([b])
                held = now if held is None else pa.concat_tables([held, now])
            if held is None or not len(held):
                continue
            if keep_first:  # a row that the table holds twice is one text
                again = [held.column(c).to_numpy() for c in ("shard", "doc", "place", "content", "lo")]
                held = held.filter(pa.array(np.append(True, np.any([x[1:] != x[:-1] for x in again], axis=0))))
            shard = held.column("shard").to_numpy()
            cut = len(shard) if b is None else int(np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))[-1])  # the last shard may go on
            if not cut:
                continue
            done, held = held.slice(0, cut), held.slice(cut)
            yield from _resolve(done, length, keep_first)

    return run


def _resolve(table: pa.Table, length: int, keep_first: bool):
    shard, h, content, begin = [table.column(c).to_numpy() for c in ("shard", "h", "content", "lo")]
    raw = table.column("raw").to_pylist()
    lo = 0
    while lo < len(h):  # whole shards, about 1 MB of strings at a time
        hi, size = lo, 0
        while hi < len(h) and (size < 1 << 20 or shard[hi] == shard[hi - 1]):
            size += len(raw[hi])
            hi += 1
        data, starts = _joined(raw[lo:hi])
        rep = repeated_factors(data, starts, length, keep_first)
        n = np.diff(starts) - length + 1
        ends = np.cumsum(n)
        begins = ends - n
        head, tail = np.zeros(len(rep), bool), np.zeros(len(rep), bool)
        head[begins] = tail[ends - 1] = True
        a = np.flatnonzero(rep & (head | ~np.concatenate(([False], rep[:-1]))))
        z = np.flatnonzero(rep & (tail | ~np.concatenate((rep[1:], [False])))) + 1
        row = np.searchsorted(ends, a, side="right")
        off = begin[lo:hi][row] - begins[row]
        yield pa.RecordBatch.from_arrays([pa.array(h[lo:hi][row]), pa.array(content[lo:hi][row]), pa.array((a + off).astype(np.int32)), pa.array((z + off).astype(np.int32))], names=["h", "content", "a", "z"])
        lo = hi


def _narrower(length: int, width: int):
    """Rows of ``ROW`` cut by the factors' offset from the anchor; the new shard is what all factors of such a block have in common."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out = []
            for h, content, doc, place, lo, lead, _, _, raw in zip(*[b.column(i).to_pylist() for i in range(len(NAMES))], strict=True):
                n = len(raw) - length + 1
                for j in range((lead - n + 1) // width, lead // width + 1):
                    a, z = max(0, lead - (j + 1) * width + 1), min(n, lead - j * width + 1)
                    core = raw[lead - j * width : lead - (j + 1) * width + 1 + length]
                    part = raw[a : z - 1 + length]
                    shard = digest(h.to_bytes(8, "little", signed=True) + j.to_bytes(2, "little") + core)
                    out.append((h, content, doc, place, lo + a, lead - a, shard - (shard >> 63 << 64), (x := digest(part)) - (x >> 63 << 64), part))
            for at in range(0, len(out), 4096):
                yield _batch(out[at : at + 4096])

    return run


def _and_last(batches):
    yield from batches
    yield None


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, k: int = 48, keep_first: bool = False, keep: list[str] | None = None, with_text: bool = False, shard_runs: int = 1024) -> DataFrame:
    """``keep`` columns (the id alone by default), n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept_text.

    By default every byte that a repeated factor covers goes. With ``keep_first`` the first copy (least id, then least
    position) stays. Ids are integers.
    """
    if length - k + 1 > 4095:
        raise ValueError("length - k must stay below 4095")
    keep = [id_col] if keep is None else [c for c in keep if c not in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")]
    doc = F.col(base.quoted(id_col)).cast("long")
    text = F.col(base.quoted(text_col))
    own = F.struct(*[F.col(base.quoted(c)).alias(f"c{i}") for i, c in enumerate(keep)])
    side = docs.select(F.xxhash64(F.coalesce(doc, F.lit(-1)), text).alias("rk"), doc.alias("doc"), own.alias("own"), text.alias("text"))
    # The order in which copies count; without keep_first the ids stay behind.
    order = ["doc", "place", "rk"] if keep_first else ["place", "rk"]

    found = runs(side.select("rk", (F.col("doc") if keep_first else F.lit(0).cast("long")).alias("doc"), "text"), length, k).select("h", "content", *order)
    by_anchor = found.groupBy(F.col("h").alias("h2")).agg(F.count("*").alias("c"), (F.min("content") != F.max("content")).alias("mixed")).filter("c > 1")
    by_anchor = base.materialised(by_anchor.select("h2", "mixed", (F.col("mixed") & (F.col("c") > shard_runs)).alias("hot")))  # a table of its own, so that the join's sides are plain shuffles that can be split
    shared = base.materialised(found.join(by_anchor, F.col("h") == F.col("h2")).select("h", "content", *order, "mixed", "hot"))

    first, n = unpacked("place")
    full = [F.col("rk"), first.alias("a"), (first + n + length - 1).alias("z")]
    whole = shared.filter("not mixed")
    mixed = shared.filter("mixed").drop("mixed")
    heads = mixed.groupBy("h", "content").agg(F.count("*").alias("copies"), F.min(F.struct(*order)).alias("at"), F.max("hot").alias("hot"))
    if keep_first:  # all copies of a content but the first go as a whole
        tops = shared.groupBy(F.col("h").alias("h2"), F.col("content").alias("content2")).agg(F.min(F.struct(*order)).alias("top"))
        whole = shared.join(tops, (F.col("h") == F.col("h2")) & (F.col("content") == F.col("content2"))).filter(F.struct(*order) != F.col("top"))
    texts = side.select("rk", "own", "text")

    def fetched(some: DataFrame) -> DataFrame:
        wanted = some.select(F.col("at.rk").alias("rk"), F.struct("h", "content", *[F.col(f"at.{c}").alias(c) for c in order if c != "rk"]).alias("w")).groupBy("rk").agg(F.collect_list("w").alias("wanted")).withColumnRenamed("rk", "rk2")
        once = wanted.join(texts.select("rk", "text"), F.col("rk2") == F.col("rk"))
        return once.select("text", "wanted").mapInArrow(_fetch(length), ROW)

    def resolved(rows: DataFrame) -> DataFrame:
        in_order = rows.repartition("shard").sortWithinPartitions("shard", "doc", "place", "content", "lo")
        return in_order.mapInArrow(_resolver(length, keep_first), "h long, content long, a int, z int")

    answers = resolved(fetched(heads.filter("not hot")))
    if not keep_first:  # a class of two needs no more
        answers = answers.union(heads.filter("copies > 1").select("h", "content", F.lit(0).alias("a"), F.shiftright("at.place", 12).bitwiseAND(F.lit(4095)).cast("int").alias("z")))
    if not by_anchor.filter("hot").isEmpty():
        rows = fetched(heads.filter("hot"))
        for width in WIDTHS:
            level = base.materialised(rows.mapInArrow(_narrower(length, width), ROW))
            at = F.struct("doc", "place", "h", "content")
            shards = base.materialised(level.groupBy(F.col("shard").alias("shard2")).agg(F.count("*").alias("c"), (F.min("block") != F.max("block")).alias("differ"), F.min(at).alias("top")).filter("c > 1"))
            several = base.materialised(level.join(shards, F.col("shard") == F.col("shard2")))
            base.dropped(level, shards)
            equal = several.filter("not differ")
            if keep_first:
                equal = equal.filter(at != F.col("top"))
            answers = answers.union(equal.select("h", "content", F.col("lo").alias("a"), (F.col("lo") + F.octet_length("raw") - length + 1).alias("z")))
            answers = answers.union(resolved(several.filter(F.col("differ") & (F.col("c") <= shard_runs)).select(*NAMES)))
            rows = several.filter(F.col("differ") & (F.col("c") > shard_runs)).select(*NAMES)
            if rows.isEmpty():
                break
    answers = answers.select(F.col("h").alias("h2"), F.col("content").alias("content2"), "a", "z")
    back = mixed.join(answers, (F.col("h") == F.col("h2")) & (F.col("content") == F.col("content2")))
    part = back.select("rk", (first + F.col("a")).alias("a"), (first + F.col("z") + length - 1).alias("z"))
    spans = whole.select(*full).union(part).select("rk", F.shiftleft("a", 32).bitwiseOR(F.col("z")).alias("span"))
    spans = spans.repartition("rk").groupBy(F.col("rk").alias("rk2")).agg(F.collect_set("span").alias("spans"))  # equal rows have equal spans

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept_text", T.StringType())] * with_text
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep] + fields)
    return texts.join(spans, F.col("rk") == F.col("rk2"), "left").select("own", "text", "spans").mapInArrow(_cut(len(keep), schema.names, with_text), schema)


def _fetch(length: int):
    """The bytes of the wanted runs, as rows of ``ROW``."""

    def run(batches):
        for b in batches:
            texts, wanted = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for t, ws in zip(texts, wanted, strict=True):
                raw = (t or "").encode("utf-8", "surrogatepass")
                for w in ws:
                    first, n, lead = w["place"] >> 24, w["place"] >> 12 & 4095, w["place"] & 4095
                    out.append((w["h"], w["content"], w.get("doc"), w["place"], 0, lead, w["h"], w["content"], raw[first : first + n + length - 1]))
                    if len(out) == 4096:
                        yield _batch(out)
                        out = []
            yield _batch(out)

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _cut(n_keep: int, names: list[str], with_text: bool):
    def run(batches):
        for b in batches:
            texts, lists = b.column(1).to_pylist(), b.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            a, z = flat >> 32, flat & 0xFFFFFFFF
            size, gone, count, sha, kept_texts = [], [], [], [], []
            for i, t in enumerate(texts):
                raw = (t or "").encode("utf-8", "surrogatepass")
                spans = merged(list(zip(a[offsets[i] : offsets[i + 1]].tolist(), z[offsets[i] : offsets[i + 1]].tolist(), strict=True)))
                parts, at = [], 0
                for lo, hi in spans:
                    parts.append(raw[at:lo])
                    at = hi
                kept = b"".join([*parts, raw[at:]])
                size.append(len(raw))
                gone.append(len(raw) - len(kept))
                count.append(len(spans))
                sha.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    kept_texts.append(kept.decode("utf-8", "ignore"))
            own = [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())] + [pa.array(kept_texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays([b.column(0).field(i) for i in range(n_keep)] + own, names=names)

    return run


def suffix_array(data: bytes) -> np.ndarray:
    """Starts of the suffixes in their order, by prefix doubling."""
    n = len(data)
    rank = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    width = 1
    while n:
        second = np.concatenate((rank[width:], np.zeros(min(width, n), np.int64)))[:n]
        order = np.lexsort((second, rank))
        new = np.concatenate(([0], np.cumsum((rank[order[1:]] != rank[order[:-1]]) | (second[order[1:]] != second[order[:-1]])))) + 1
        rank[order] = new
        if new[-1] == n:
            return order
        width *= 2
    return np.zeros(0, np.int64)


def longest_previous_factor(data: bytes) -> np.ndarray:
    """For each position, the length of the longest string from there that also starts earlier.

    It starts at the previous or the next smaller position in suffix order; its length is the longer of the two matches.
    """
    order = suffix_array(data).tolist()
    out = np.zeros(len(data), np.int64)
    stack: list[int] = []
    smaller: list[list[int]] = [[] for _ in order]
    for walk in (order, order[::-1]):
        stack.clear()
        for p in walk:
            while stack and stack[-1] > p:
                stack.pop()
            if stack:
                smaller[p].append(stack[-1])
            stack.append(p)
    for p, sources in enumerate(smaller):
        for q in sources:
            m = 0
            while p + m < len(data) and data[p + m] == data[q + m]:
                m += 1
            out[p] = max(out[p], m)
    return out
