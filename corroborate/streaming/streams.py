"""Streaming evidence jobs: ingest, windowed counts, stale claims, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(src: DataFrame, time: str) -> DataFrame:
    """Event time as a timestamp with zone, as watermarks need it."""
    return src.withColumn(time, F.col(time).cast("timestamp"))


def stream_warrants(src: DataFrame, keys: list[str], time: str = "created_at", late: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return _timed(src, time).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def stream_evidence_counts(src: DataFrame, size: str = "1 day", slide: str | None = None, time: str = "created_at", late: str = "1 day", source: str = "source_id") -> DataFrame:
    """New evidence by source and tumbling (or sliding) window; rows later than the watermark are dropped by Spark."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    out = _timed(src, time).withWatermark(time, late).groupBy(w.alias("w"), F.col(source).alias("source")).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "n")


def stream_stale(warrants: DataFrame, claims: DataFrame) -> DataFrame:
    """(claim_id, warrant_id): evidence that arrives after a claim on its pair was approved. ``claims`` is static."""
    c = claims.filter("status = 'approved'").select(F.col("id").alias("claim_id"), "plant_id", "attribute_id", "approved_at")
    return warrants.filter("status <> 'excluded'").join(c, ["plant_id", "attribute_id"]).filter("created_at > approved_at").select("claim_id", F.col("id").alias("warrant_id"), "created_at")


def stream_sessions(src: DataFrame, gap: str = "30 minutes", time: str = "ts", user: str = "user_id", late: str = "1 hour") -> DataFrame:
    out = _timed(src, time).withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), user).agg(F.count("*").alias("n"))
    return out.select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
