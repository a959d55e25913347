"""Metric logs: writing, rolling up, and following as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators.metrics import metrics_rollup, metrics_steps
from tokenloom.plans.registry import query, six
from tokenloom.session import staging_path
from tokenloom.sources.corpus import table
from tokenloom.sources.metric_log import append_metrics, event_metrics, read_metrics

LOG_SQL = """log AS (SELECT user_id AS run_id, event_id // 32 AS step, CAST(ts AS TIMESTAMP) AS ts,
  event_type AS name, value FROM events)"""


# Means of two-decimal values often end in a 5; a nudge keeps both engines rounding alike.
NUDGE = 1e-9


@query("metric_log", f"WITH {LOG_SQL} SELECT run_id, step, epoch_us(ts) AS ts_us, name, value FROM log")
def metric_log(spark, folder):
    place = staging_path(spark, "metrics")
    append_metrics(event_metrics(table(spark, folder, "events")), place)
    log = read_metrics(spark, place)
    return log.select("run_id", "step", F.unix_micros("ts").alias("ts_us"), "name", "value")


@query(
    "metrics_rollup",
    f"""WITH {LOG_SQL},
    steps AS (SELECT run_id, name, step, count(*) AS n, sum(value) / count(*) AS m, min(ts) AS a, max(ts) AS b
      FROM log GROUP BY ALL),
    rolled AS (SELECT run_id, name, count(*) AS steps, CAST(sum(n) AS BIGINT) AS micro_batches, avg(m) AS mean,
      max(m) AS "max", arg_max(m, step) AS "last", arg_min(step, (round(m, 9), step)) AS best_step,
      min(round(m, 9)) AS best, (epoch_us(max(b)) - epoch_us(min(a))) / 1e6 AS seconds
      FROM steps GROUP BY run_id, name)
    SELECT run_id, name, steps, micro_batches, round(mean + 1e-9, 6) + 0.0 AS mean, round("max" + 1e-9, 6) + 0.0 AS "max",
    round("last" + 1e-9, 6) + 0.0 AS "last", best_step, round(best + 1e-9, 6) + 0.0 AS best,
    round(seconds + 1e-9, 6) + 0.0 AS seconds, round(micro_batches / nullif(seconds, 0) + 1e-9, 6) + 0.0 AS per_second FROM rolled""",
)
def rollup(spark, folder):
    rolled = metrics_rollup(event_metrics(table(spark, folder, "events")))
    numbers = ["mean", "max", "last", "best", "seconds", "per_second"]
    return rolled.select(
        "run_id", "name", "steps", "micro_batches", "best_step", *[six(F.col(c) + NUDGE).alias(c) for c in numbers]
    )


ROW_TOKENS = 16 * 1024


@query(
    "metrics_steps",
    f"""WITH {LOG_SQL}, steps AS (SELECT run_id, name, step, count(*) AS micro_batches, sum(value) / count(*) AS mean,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM log GROUP BY run_id, name, step)
    SELECT run_id, name, step, micro_batches, round(mean + {NUDGE}, 6) AS mean, round(seconds * 1000, 3) AS ms,
    round(CASE WHEN seconds > 0 THEN micro_batches * {ROW_TOKENS} / seconds END, 6) AS tokens_per_second FROM steps""",
)
def metrics_steps_query(spark, folder):
    steps = metrics_steps(event_metrics(table(spark, folder, "events")), ROW_TOKENS)
    return steps.select(
        "run_id", "name", "step", "micro_batches", six(F.col("mean") + NUDGE).alias("mean"),
        F.round("ms", 3).alias("ms"), six(F.col("tokens_per_second")).alias("tokens_per_second"),
    )
