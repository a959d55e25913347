"""The metric log followed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def metrics_windows(metrics: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Per run, metric and time window: count, mean and largest value, once the window is closed.

    Sums are combined in every task before the shuffle, so a busy run is no hot spot.
    """
    return (
        metrics.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window), "run_id", "name")
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"))
        .select(F.col("window.start").alias("start"), "run_id", "name", "n", "mean", "max")
    )


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes everything available to a table and stops; a later start goes on where this ended."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
