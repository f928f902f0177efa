"""The prediction log as a stream: windowed summary with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lendgrid.sources.schemas import LOG_SCHEMA


def stream_log(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)


def windowed_summary(log: DataFrame, window: str = "1 day", lateness: str = "2 hours") -> DataFrame:
    """Volume, mean probability and high-risk share per event-time window and decision.

    Works on the streamed and on the stored log alike; on a stream a window is
    final once the watermark passes it.
    """
    timed = log.withColumn("event_time", F.to_timestamp("timestamp"))
    if log.isStreaming:
        timed = timed.withWatermark("event_time", lateness)
    grouped = timed.groupBy(F.window("event_time", window), "decision").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("probability").alias("mean_probability"),
        F.avg((F.col("probability") >= F.col("threshold")).cast("double")).alias("high_risk_share"),
    )
    return grouped.select(F.col("window.start").alias("window_start"), "decision", "n", "mean_probability", "high_risk_share")


def start_summary(log: DataFrame, output: str, checkpoint: str, window: str = "1 day", lateness: str = "2 hours") -> StreamingQuery:
    """Append finished windows to parquet, taking all present files and then stopping."""
    return (
        windowed_summary(log, window, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(output)
    )


def start_log_sink(scores: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append streamed log entries as JSON lines."""
    return (
        scores.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("json")
        .start(output)
    )
