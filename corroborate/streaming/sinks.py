"""A sink that takes every micro-batch once: rows are written under their batch id, so that a batch that is run again replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def once_per_batch(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. A batch's folder is replaced as a whole, and its rows show only when the write is committed: after a
    failure between the write and the stream's own commit the batch is run again under the same id and no row counts twice."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that batches wrote, with their ``batch_id``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)


def latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the last batch wrote: the state of a stream in complete mode. Only that batch's folder is read."""
    rows = batches(spark, path, schema)
    last = rows.agg(F.max("batch_id").alias("b")).first()["b"]
    return rows.filter(F.col("batch_id") == F.lit(-1 if last is None else last)).drop("batch_id")
