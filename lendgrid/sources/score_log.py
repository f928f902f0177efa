"""Append-only log of scores, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.sources.schemas import LOG_SCHEMA


def log_entries(scores: DataFrame, timestamp: str) -> DataFrame:
    """Log rows for scored applicants; the time is given, so a run can be repeated."""
    return scores.select(
        F.lit(timestamp).alias("timestamp"),
        F.col("sk_id_curr").cast("long").alias("sk_id_curr"),
        F.col("probability").cast("double").alias("probability"),
        F.col("threshold").cast("double").alias("threshold"),
        "decision",
    )


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)


def summarize_log(log: DataFrame, by: tuple[str, ...] = ("decision",)) -> DataFrame:
    """Volume, mean probability and high-risk share."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("probability").alias("mean_probability"),
        F.avg((F.col("probability") >= F.col("threshold")).cast("double")).alias("high_risk_share"),
    )
