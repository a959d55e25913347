"""Counts of longer contexts, and scores that back off to shorter ones."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import lookup_join, stage

BACKOFF = 0.4  # published factor of the scoring rule
NONE = -1  # stands for "before the start of the text"


def _context_names(order: int) -> list[str]:
    return [f"c{k}" for k in range(order - 1, 0, -1)]


def gram_counts(docs: DataFrame, order: int, by: list[str], ids: str = "ids") -> DataFrame:
    """`(…by, c{order-1}, …, c1, next, n)`: each token with the tokens before it.

    One row per token reaches the aggregation, in columns of numbers; shorter contexts are
    derived later from the far smaller table of distinct rows.
    """
    names = _context_names(order)
    size = F.size(ids)
    shifted = [
        F.slice(F.concat(F.array_repeat(F.lit(NONE), k), F.col(ids)), F.lit(1), size)
        for k in range(order - 1, 0, -1)
    ]
    return (
        docs.filter(size > 0)
        .select(*by, F.inline(F.arrays_zip(*shifted, F.col(ids))).alias(*names, "next"))
        .groupBy(*by, *names, "next")
        .agg(F.count("*").alias("n"))
    )


def _context(length: int) -> Column:
    """The last `length` context tokens as text, or null where the text starts too late."""
    cols = [F.col(f"c{k}") for k in range(length, 0, -1)]
    whole = cols[0] != NONE if cols else F.lit(True)
    return F.when(whole, F.concat_ws(" ", *[c.cast("string") for c in cols]))


def level_counts(grams: DataFrame, order: int) -> DataFrame:
    """`(n, context, next, count)` for contexts of n - 1 tokens, n = 1 … order."""
    levels = F.array(*[F.struct(F.lit(n).alias("level"), _context(n - 1).alias("context")) for n in range(1, order + 1)])
    return (
        grams.select(F.col("n").alias("count"), "next", F.inline(levels))
        .filter(F.col("context").isNotNull())
        .groupBy(F.col("level").alias("n"), "context", "next")
        .agg(F.sum("count").alias("count"))
    )


def fit_ngram(grams: DataFrame, order: int) -> DataFrame:
    """`(n, context, next, count, total, rank)` for n = 1 … order."""
    counts = level_counts(grams, order)
    same = Window.partitionBy("n", "context")
    return counts.withColumn("total", F.sum("count").over(same)).withColumn(
        "rank", F.row_number().over(same.orderBy(F.desc("count"), "next"))
    )


def score_ngram(model: DataFrame, docs: DataFrame, order: int, key: str, ids: str = "ids") -> DataFrame:
    """`(key, tokens, backoff_score)`: log score of each document, from the longest seen context.

    Every distinct gram is scored once, then met by the documents' own counts. A token the model
    never saw scores as one seen once. The scores do not sum to one over tokens.
    """
    names = _context_names(order) + ["next"]
    counts = stage(gram_counts(docs, order, [key], ids), "grams")
    scored = counts.select(*names).distinct()
    choices = []
    for n in range(order, 0, -1):
        level = model.filter(F.col("n") == n).select(
            F.col("context").alias(f"x{n}"), "next", F.log(F.col("count") / F.col("total")).alias(f"s{n}")
        )
        scored = scored.withColumn(f"x{n}", _context(n - 1)).join(level, [f"x{n}", "next"], "left")
        choices.append(F.col(f"s{n}") + (order - n) * math.log(BACKOFF))
    seen = model.filter(F.col("n") == 1).agg(F.max("total").alias("total")).first()["total"] or 1
    floor = F.lit((order - 1) * math.log(BACKOFF) - math.log(seen))
    table = stage(scored.select(*names, F.coalesce(*choices, floor).alias("score")), "scores")
    return (
        lookup_join(counts, table, names, "inner", [key])
        .groupBy(key)
        .agg(F.sum("n").alias("tokens"), F.sum(F.col("n") * F.col("score")).alias("backoff_score"))
    )
