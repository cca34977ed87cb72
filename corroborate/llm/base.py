"""Helpers shared by the text operators: batching, character arrays, bounded samples."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that one call of a text function gets at most, unless a single text is longer.
CHUNK_CHARS = 1 << 19


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chunks(texts: list[str], budget: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows of at most ``budget`` characters (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > budget:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def pieces(texts: pa.Array, budget: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """The same runs of a column, each with its texts (null reads as empty): the other texts are not held as objects meanwhile."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + budget, side="right")))
        yield lo, hi, ["" if t is None else t for t in texts.slice(lo, hi - lo).to_pylist()]
        lo = hi


def map_text(df: DataFrame, text_col: str, fn: Callable[[list[str]], list[pa.Array]], fields: list[T.StructField], keep: list[str], budget: int = CHUNK_CHARS) -> DataFrame:
    """``keep`` columns plus what ``fn`` makes of the texts (null reads as empty); input columns named as a field give way.

    ``fn`` gets texts of ``budget`` characters at a time, unless a single one is longer."""
    names = {f.name for f in fields}
    keep = [c for c in keep if c not in names]
    out = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + fields)
    src = df.select(*[F.col(quoted(c)) for c in keep], F.col(quoted(text_col)).cast("string").alias("__text__"))
    n, labels = len(keep), [*keep, *[f.name for f in fields]]

    def run(batches):
        for b in batches:
            for lo, hi, texts in pieces(b.column(n), budget):
                kept = [b.column(i).slice(lo, hi - lo) for i in range(n)]
                yield pa.RecordBatch.from_arrays(kept + fn(texts), names=labels)
            b = kept = None  # the next batch is read without this one

    return src.mapInArrow(run, out)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    chars = [chr(i) for i in range(0x10000)]
    letter = np.array([unicodedata.category(c)[0] == "L" for c in chars])
    lower = np.array([ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(chars)], dtype=np.uint32)
    return letter, lower


def char_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and where each text starts (one more entry than texts)."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return codes, starts


def is_letter(codes: np.ndarray) -> np.ndarray:
    """Unicode letters (category L)."""
    table, _ = _tables()
    out = table[np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        at = np.flatnonzero(codes > 0xFFFF)
        out = out.copy()
        out[at] = [unicodedata.category(chr(c))[0] == "L" for c in codes[at]]
    return out


def lowered(codes: np.ndarray) -> np.ndarray:
    """Lower case where it is one character; characters beyond the basic plane stay."""
    _, lower = _tables()
    return np.where(codes > 0xFFFF, codes, lower[np.minimum(codes, 0xFFFF)])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def not_held_out(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text leaves a remainder other than 2 modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(~not_held_out(doc_id), F.lit(False))


def bounded_sample(df: DataFrame, group: str, per_group: int, keys: list[str], max_groups: int = 4096) -> tuple[DataFrame, dict]:
    """About ``per_group`` rows of each group (all rows of smaller groups), picked by a hash of ``keys``, and the sizes of the groups.

    Rows whose hash falls below per_group / size of their group are taken; equal keys are taken together. In case a key is
    repeated very often, twice the expected number of rows is a hard bound for each group, in the order of the hashes, so that no
    key takes the place of another group and a sample does not depend on partitions. Groups, of which there may be ``max_groups``, are not dropped: more raise.
    """
    sizes = {r[0]: r[1] for r in df.filter(F.col(group).isNotNull()).groupBy(group).count().orderBy(F.desc("count"), group).limit(max_groups + 1).collect()}
    if len(sizes) > max_groups:
        raise ValueError(f"{group} has more than {max_groups} values")
    if not sizes:
        return df.filter("false"), {}
    rate = F.lit(0.0)
    for value, n in sizes.items():
        rate = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, per_group / n))).otherwise(rate)
    hashed = F.xxhash64(*[F.col(k).cast("string") for k in keys], F.lit("sample"))
    u = F.shiftrightunsigned(hashed, 12) / F.lit(float(1 << 52))
    some = df.filter(F.col(group).isNotNull()).withColumns({"__h__": hashed, "__u__": u}).filter(F.col("__u__") < rate)
    ranked = some.withColumn("__r__", F.row_number().over(Window.partitionBy(group).orderBy("__h__", *keys)))
    return ranked.filter(F.col("__r__") <= 2 * per_group + 100).drop("__h__", "__u__", "__r__"), sizes


class Spans:
    """Intervals, sorted once, that are asked whether they meet another one."""

    def __init__(self, spans: list[tuple]):
        self.starts = sorted(s[0] for s in spans)
        self.ends, most = [], -1
        for s in sorted(spans):
            self.ends.append(most := max(most, s[1]))

    def meet(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start


def without_overlap(spans: list[tuple]) -> list[tuple]:
    """Of (rank, start, end, …) the ones, best rank first, that meet none taken before, by start."""
    starts: list[int] = []
    taken: list[tuple] = []
    for x in sorted(spans):
        at = bisect_left(starts, x[2])
        if at == 0 or taken[at - 1][2] <= x[1]:
            starts.insert(at, x[1])
            taken.insert(at, x)
    return taken


def shared_folder(spark) -> str:
    """The folder that all executors share, as the cluster names it in spark.checkpoint.dir. Where that is unset, as in tests on one
    machine, a temporary one; on a cluster that raises, since executors would write to their own disks."""
    import tempfile

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir names no folder that executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialised(df: DataFrame) -> DataFrame:
    """Write to a table of its own in the shared folder and read it back: cuts the lineage and survives lost executors.

    The table goes with ``dropped`` once nothing reads it any more; what is still read when a query returns stays until the
    cluster cleans that folder.
    """
    import uuid

    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``materialised`` wrote."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            if "/table-" in f:
                path = jvm.org.apache.hadoop.fs.Path(f)
                path.getFileSystem(conf).delete(path, True)
