"""The typed, append-only log of numbers per run and step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = "run_id bigint, step bigint, ts timestamp, name string, value double"


def append_metrics(df: DataFrame, path: str) -> None:
    """Adds rows to the log, in folders per day so that readers prune by time.

    Rows are rebalanced by day, which splits a busy day over tasks and keeps files few.
    """
    typed = df.selectExpr(
        "CAST(run_id AS bigint) run_id", "CAST(step AS bigint) step", "CAST(ts AS timestamp) ts",
        "CAST(name AS string) name", "CAST(value AS double) value",
    )
    daily = typed.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
    daily.write.mode("append").partitionBy("day").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{METRICS}, day date").parquet(path)


def event_metrics(events: DataFrame, micro_batches: int = 32) -> DataFrame:
    """The event table as a log: a user is a run, `micro_batches` event ids make one step."""
    return events.select(
        F.col("user_id").alias("run_id"),
        F.floor(F.col("event_id") / micro_batches).alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("name"),
        "value",
    )
