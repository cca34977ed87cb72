"""Tables of the library's own, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset, a temporary one on one machine; on a cluster that raises."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not root and not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return f"{root or 'file://' + tempfile.mkdtemp(prefix='spark-')}/files-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The same rows, written and read again: what several steps read is worked out once, and outlives lost executors."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
