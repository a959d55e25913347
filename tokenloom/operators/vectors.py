"""Statistics and pooling over sequences of vectors."""

from __future__ import annotations

import math
from functools import partial
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.vectors import (
    block_pool,
    fold_sorted_vectors,
    fold_vectors,
    pooled_vectors,
    position_vector,
    running_sorted_vectors,
    standardized,
)
from tokenloom.session import MAX_BROADCAST_ROWS, lookup_join, stage

BLOCK = 1024
MAX_BROADCAST_BYTES = 256 << 20


def width(vectors: DataFrame, v: str = "v") -> int:
    row = vectors.select(F.size(v)).first()
    return row[0] if row else 0


def row_standardize(vectors: DataFrame, variant: str, v: str = "v", into: str = "z", **params) -> DataFrame:
    return vectors.withColumn(into, standardized(F.col(v), variant, **params))


def column_moments(vectors: DataFrame, v: str = "v") -> DataFrame:
    """Mean and sample deviation of each place over all vectors."""
    places = vectors.select(F.posexplode(v).alias("dim", "value"))
    return places.groupBy("dim").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


def summed(rows: DataFrame, keys: list[str], v: str = "v") -> DataFrame:
    """`(…keys, v)`: sums of equally long vectors. Each task adds up what it has before anything is shuffled."""
    schema = rows.select(*keys, F.col(v).cast("array<double>").alias("v")).schema
    parts = rows.select(*keys, F.col(v).cast("array<double>").alias("v")).mapInArrow(partial(fold_vectors, keys=keys), schema)
    ordered = parts.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(partial(fold_sorted_vectors, keys=keys), schema)


def running_vectors(rows: DataFrame, seq: str, order: str, v: str = "v", block: int = 4096) -> DataFrame:
    """`(seq, order, v)`: inclusive running sums of vectors along `order` in each `seq`.

    Blocks as in `running_sums`; a vector stays one column, so the plan does not grow with its length.
    """
    last = rows.agg(F.max(order)).first()[0]
    vectors = rows.select(seq, F.col(order).cast("bigint").alias(order), F.col(v).cast("array<double>").alias("v"))
    return _running_vectors(vectors, seq, order, block, 0 if last is None else last)


def _running_vectors(rows: DataFrame, seq: str, order: str, block: int, last: int) -> DataFrame:
    if last < block:
        ordered = rows.withColumn("carry", F.array().cast("array<double>")).repartition(seq).sortWithinPartitions(seq, order)
        keys = [seq]
    else:
        place = f"{order}_block"
        blocked = rows.withColumn(place, F.floor(F.col(order) / block).cast("bigint"))
        totals = stage(summed(blocked, [seq, place]), "totals")
        upto = _running_vectors(totals, seq, place, block, last // block)
        carried = upto.withColumnRenamed("v", "_upto").join(totals.withColumnRenamed("v", "_own"), [seq, place]).select(
            seq, place, F.zip_with("_upto", "_own", lambda x, y: x - y).alias("carry"))
        keys = [seq, place]
        ordered = blocked.join(carried, keys).repartition(*keys).sortWithinPartitions(*keys, order)
    schema = rows.schema
    return ordered.select(*rows.columns, *keys[1:], "carry").mapInArrow(
        partial(running_sorted_vectors, keys=keys, out=[seq, order]), schema)


def causal_mean(vectors: DataFrame, seq: str = "seq_id", order: str = "t", v: str = "v", block: int = 4096) -> DataFrame:
    """`(seq, order, mean)`: mean of the vectors up to each position; long sequences in blocks."""
    counted = vectors.select(seq, order, F.concat(F.col(v).cast("array<double>"), F.array(F.lit(1.0))).alias("v"))
    sums = running_vectors(counted, seq, order, "v", block)
    n = F.element_at("v", -1)
    return sums.select(seq, order, F.transform(F.slice("v", F.lit(1), F.size("v") - 1), lambda x: x / n).alias("mean"))


def _blocks(df: DataFrame, seq: str, order: str, block: int, *fields: Column) -> DataFrame:
    """`(seq, at, rows)`: each sequence in blocks of at most `block` positions, ordered inside."""
    row = F.struct(F.col(order).alias("t"), *fields)
    place = F.floor(F.col(order) / block).alias("at")
    return df.groupBy(seq, place).agg(F.array_sort(F.collect_list(row)).alias("rows"))


def _merged(parts: DataFrame, seq: str, order: str) -> DataFrame:
    """Query positions with the parts of all key blocks put together.

    A part has the largest score m, the sum s and the weighted sum of values acc relative to it, and
    the weights e of its keys, so parts of different blocks only differ by the factor exp(m - top).
    """
    part = F.struct("at", "m", "s", "acc", "e")
    rows = parts.groupBy(seq, order).agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    top = F.array_max(F.transform("_parts", lambda p: p["m"]))
    rows = rows.withColumn("_top", top).withColumn("_parts", F.transform("_parts", lambda p: p.withField(
        "s", F.when(p["m"] == F.lit(float("-inf")), 0.0).otherwise(F.exp(p["m"] - F.col("_top"))))
        .withField("m", p["s"])))
    # Now s is the factor of a part and m its own sum.
    whole = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["s"] * p["m"])
    rows = rows.withColumn("_whole", F.greatest(whole, F.lit(2.2250738585072014e-308)))
    zero = F.transform(F.get(F.col("_parts"), F.lit(0))["acc"], lambda x: F.lit(0.0))
    pooled = F.aggregate("_parts", zero, lambda a, p: F.zip_with(a, p["acc"], lambda x, y: x + p["s"] * y))
    weights = F.flatten(F.transform("_parts", lambda p: F.transform(p["e"], lambda w: w * p["s"] / F.col("_whole"))))
    return rows.select(seq, order, weights.alias("weights"), F.transform(pooled, lambda x: x / F.col("_whole")).alias("pooled"))


def causal_pooling(
    vectors: DataFrame,
    seq: str = "seq_id",
    order: str = "t",
    v: str = "v",
    scale: float | None = None,
    block: int = BLOCK,
    w_q=None,
    w_k=None,
    w_v=None,
) -> DataFrame:
    """`(seq, order, pooled)`: similarity-weighted mean over all earlier positions and itself.

    Sequences of any length: a block of `block` queries meets every earlier block of keys in a task of
    its own, and the parts are put together. Scale is 1/sqrt(d) unless given; `w_*` are optional
    projection matrices.
    """
    blocks = stage(_blocks(vectors, seq, order, block, F.col(v).alias("v")), "blocks")
    asked = blocks.select(seq, F.col("at").alias("_q"), F.col("rows").alias("_asked"))
    met = asked.join(blocks, seq).filter(F.col("at") <= F.col("_q"))
    part = block_pool(scale, w_q, w_k, w_v, causal=True, weights=False)
    seen = F.transform("rows", lambda r: F.lit(1))
    parts = met.select(seq, "at", F.inline(part("_asked.t", "_asked.v", "rows.t", "rows.v", seen)))
    return _merged(parts.withColumnRenamed("t", order), seq, order).drop("weights")


def cross_pooling(
    queries: DataFrame,
    keys: DataFrame,
    seq: str = "seq_id",
    order: str = "t",
    v: str = "v",
    visible: str = "visible",
    scale: float | None = None,
    block: int = BLOCK,
    w_q=None,
    w_k=None,
    w_v=None,
) -> DataFrame:
    """`(seq, order, weights, pooled)`: queries of one table over the visible keys of another.

    Sequences of any length, in blocks as in `causal_pooling`. Hidden keys (`visible` = 0) get no weight;
    a row of `weights` has one number per key.
    """
    asked = _blocks(queries, seq, order, block, F.col(v).alias("v")).select(
        seq, F.col("at").alias("_q"), F.col("rows").alias("_asked"))
    given = _blocks(keys, seq, order, block, F.col(v).alias("v"), F.col(visible).cast("int").alias("seen"))
    part = block_pool(scale, w_q, w_k, w_v, causal=False, weights=True)
    parts = asked.join(given, seq).select(
        seq, "at", F.inline(part("_asked.t", "_asked.v", "rows.t", "rows.v", "rows.seen")))
    return _merged(parts.withColumnRenamed("t", order), seq, order)


def embed_tokens(
    tokens: DataFrame,
    table: DataFrame,
    scaled: bool = False,
    positions: bool = False,
    salt_by: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    missing: Literal["error", "zero"] = "error",
) -> DataFrame:
    """Adds `v`, the vector of `id`; times sqrt(d) and plus the vector of `pos` if asked for.

    An id without a vector stops the job, or has zeros if `missing` says so. The table is broadcast
    if it has at most `max_rows` rows and MAX_BROADCAST_BYTES bytes.
    """
    d = width(table)
    max_rows = min(max_rows, MAX_BROADCAST_BYTES // (8 * max(1, d)))
    joined = lookup_join(tokens, table.select("id", "v"), ["id"], "left", salt_by, max_rows)
    absent = F.array_repeat(F.lit(0.0), d) if missing == "zero" else F.raise_error(
        F.concat(F.lit("no vector for id "), F.col("id").cast("string"))).cast("array<double>")
    joined = joined.withColumn("v", F.coalesce("v", absent))
    if scaled:
        joined = joined.withColumn("v", F.transform("v", lambda x: x * math.sqrt(d)))
    if positions:
        at = position_vector(F.col("pos"), d)
        joined = joined.withColumn("v", F.zip_with("v", at, lambda x, p: x + p))
    return joined


def mean_pool(
    docs: DataFrame,
    table: DataFrame,
    key: str,
    ids: str = "ids",
    scaled: bool = False,
    missing: Literal["error", "zero"] = "error",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """`(key, v)`: mean vector of the ids of every row; zeros for a row without ids. `key` must be unique.

    A table within the broadcast bounds is looked up where the rows are, and nothing moves. A larger one is
    met by the distinct ids of each row, whose weighted vectors are added up per task and then per row.
    """
    d = width(table)
    max_rows = min(max_rows, MAX_BROADCAST_BYTES // (8 * max(1, d)))
    factor = math.sqrt(d) if scaled else 1.0
    rows = table.select("id", "v").limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        pooled = pooled_vectors(rows, d, missing == "error")
        return docs.select(key, F.transform(pooled(F.col(ids)), lambda x: x * factor).alias("v"))
    counts = docs.select(key, F.explode(ids).alias("id")).groupBy(key, "id").agg(F.count("*").alias("n"))
    placed = embed_tokens(counts, table, salt_by=[key], max_rows=max_rows, missing=missing)
    weighted = F.concat(F.transform("v", lambda x: x * F.col("n")), F.array(F.col("n").cast("double")))
    sums = summed(placed.select(key, weighted.alias("v")), [key])
    means = sums.select(key, F.transform(F.slice("v", 1, d), lambda x: x / F.element_at("v", -1) * factor).alias("v"))
    zeros = F.array_repeat(F.lit(0.0), d)
    return docs.select(key).join(means, key, "left").withColumn("v", F.coalesce("v", zeros))
