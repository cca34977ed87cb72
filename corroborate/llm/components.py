"""Connected components of a distributed edge table by alternating star contractions.

Edge cases: edges from a node to itself and edges with a null end connect nothing; repeated edges count once; the least node names a component, so
that there are no ties; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base


#: Edges that a task holds at most, but for the batch that it reads, before it hands their stars on.
HELD_EDGES = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows is connected to by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        for x in (a, b, root[a], root[b]):
            np.minimum.at(new, x, least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges that hang every node on the least one reachable by the given ones: never more of them than were given."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = roots(len(nodes), at[: len(a)], at[len(a) :])
    on = root != np.arange(len(nodes))
    return nodes[on], nodes[root[on]]


def _joined_up(batches):
    """The stars of the edges (a, b) of one partition, or of one piece after the other where it has many."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = (np.concatenate((old, batch.column(i).to_numpy())) for i, old in enumerate((a, b)))
        if len(a) > HELD_EDGES:
            a, b = _stars(a, b)
        if len(a) > HELD_EDGES // 2:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            a = b = np.zeros(0, np.int64)
    a, b = _stars(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or its smaller) neighbours on the least node among them and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = near.join(least, "u")
    if large:
        return out.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    hung = out.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end ``a`` hangs on one node only, on which nothing but such ends hangs."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(F.count_if(F.col("up") + F.col("down") > 1)).first()[0]


def components(edges: DataFrame, joined_up: bool = False) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), which are longs: the least node reachable. Rounds are logarithmic in the longest chain.

    Every round is written to the shared folder; only a count comes back to the driver. Edges that are stars already, as at the end, take no further
    round: every round is a dozen jobs, which are planned and kept account of in the driver's memory. So each task joins up what it holds after a round,
    and with ``joined_up`` before the first: edges of few partitions then need no round or one, whatever their chains.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = base.materialised(now.mapInArrow(_joined_up, "a long, b long") if joined_up else now)
    while not _are_stars(now):
        now = base.materialised(_star(_star(now, large=True), large=False).mapInArrow(_joined_up, "a long, b long"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
