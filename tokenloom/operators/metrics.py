"""Roll-ups of the metric log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metrics_steps(metrics: DataFrame, tokens_per_row: int, by: list[str] | None = None) -> DataFrame:
    """Per run, metric and step: micro-batches, mean, milliseconds and tokens per second.

    `tokens_per_row` is the size of a micro-batch. A step of no measurable time has no rate.
    """
    by = by or ["run_id", "name"]
    seconds = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6
    steps = metrics.groupBy(*by, "step").agg(
        F.count("*").alias("micro_batches"), (F.sum("value") / F.count("*")).alias("mean"), seconds.alias("seconds"))
    rate = F.when(F.col("seconds") > 0, F.col("micro_batches") * tokens_per_row / F.col("seconds"))
    return steps.select(*by, "step", "micro_batches", "mean", (F.col("seconds") * 1000).alias("ms"), rate.alias("tokens_per_second"))


def metrics_rollup(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per run and metric: step means over micro-batches, their mean, last and best, and the rate.

    Both levels are aggregates of sums, so a run with most of the rows is combined in every task
    before the shuffle. The rate is micro-batches per second of wall time.
    """
    by = by or ["run_id", "name"]
    steps = metrics.groupBy(*by, "step").agg(
        F.count("*").alias("n"),
        (F.sum("value") / F.count("*")).alias("mean"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    best = F.min(F.struct(F.round("mean", 9).alias("mean"), "step"))
    seconds = (F.unix_micros(F.max("last_ts")) - F.unix_micros(F.min("first_ts"))) / 1e6
    rolled = steps.groupBy(*by).agg(
        F.count("*").alias("steps"),
        F.sum("n").alias("micro_batches"),
        F.avg("mean").alias("mean"),
        F.max("mean").alias("max"),
        F.max_by("mean", "step").alias("last"),
        best.alias("best"),
        seconds.alias("seconds"),
    )
    rate = F.when(F.col("seconds") > 0, F.col("micro_batches") / F.col("seconds"))
    return rolled.select(
        *by, "steps", "micro_batches", "mean", "max", "last",
        F.col("best.step").alias("best_step"), F.col("best.mean").alias("best"), "seconds", rate.alias("per_second"),
    )
