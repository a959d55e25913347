"""Where each document's tokens lie in the one stream they form, and exact global ranks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import stage

PART_BITS = 33  # low bits of a generated row id, which count rows inside one part
HASH_DIGITS = 4  # 65,536 buckets of a hash order


@dataclass(frozen=True)
class StreamIndex:
    """Offsets of documents in the stream: `offsets(key, size, offset)` and the token total."""

    offsets: DataFrame
    key: str
    total: int

    def attach(self, df: DataFrame) -> DataFrame:
        """Adds `offset`. Best done while rows are still text, which is smaller than ids to shuffle."""
        return df.join(self.offsets.select(self.key, "offset"), self.key)

    def locate(self, position: int) -> tuple[int | None, int]:
        """The document that holds `position`, and the position inside it."""
        if position >= self.total:
            return None, 0
        inside = (F.col("offset") <= position) & (F.col("offset") + F.col("size") > position)
        row = self.offsets.filter(inside).first()
        return row[self.key], position - row["offset"]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the sum of `size` over the rows before."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        upto = total + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(upto - sizes)],
            [*batch.schema.names, "part", "before"])
        total = int(upto[-1]) if len(upto) else total


def part_starts(sized: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`(…by, part, start)`: the sum of `size` in all earlier parts. One row per part reaches a task."""
    by = by or []
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sized.groupBy(*by, "part").agg(F.sum("size").alias("size"))
    return totals.select(*by, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))


def stream_index(sizes: DataFrame, key: str, size: Column) -> StreamIndex:
    """Running total of `size` in `key` order, in two phases.

    The (key, size) table, far smaller than the text, is sorted by range, and each task adds up its own
    rows as it writes them. Parts then start where the totals of earlier parts end. The number of
    parts follows the rows, and only one row per part meets in a task. `key` must be a unique number.
    """
    rows = sizes.select(F.col(key), size.cast("bigint").alias("size")).repartitionByRange(key).sortWithinPartitions(key)
    kind = rows.schema[key].dataType.simpleString()
    sized = stage(rows.mapInArrow(_numbered, f"`{key}` {kind}, size bigint, part int, before bigint"), "sizes")
    offsets = sized.join(F.broadcast(part_starts(sized)), "part").select(
        key, "size", (F.col("start") + F.col("before")).alias("offset"))
    return StreamIndex(offsets, key, sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])


def dense_order(df: DataFrame, *order: Column | str, into: str = "idx") -> DataFrame:
    """Adds the place of every row, from 0, in the given order, which must be total.

    A distributed sort is staged with the place inside each of its parts; the parts are then counted
    and their counts summed. One task orders one row per part.
    """
    at = F.monotonically_increasing_id()
    placed = stage(df.orderBy(*order).select("*", at.alias("_at")), "sorted")
    part = F.shiftright("_at", PART_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("_part")).count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(into, F.col("_start") + inside)
        .drop("_at", "_part", "_start")
    )


def row_index(df: DataFrame, digest: Column, *tie_break: str) -> DataFrame:
    """`idx`: dense rank from 0 in the order of a hex digest, ties by `tie_break`.

    The leading digits split a digest evenly, so they serve as buckets without looking at the data.
    """
    placed = df.withColumn("_digest", digest).withColumn(
        "_bucket", F.substring("_digest", 1, HASH_DIGITS)
    )
    # At most 16 ** HASH_DIGITS rows, so one task may order them.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_bucket").count().select(
        "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", *tie_break)
    return (
        placed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .withColumn("idx", F.col("_start") + F.col("_rank") - 1)
        .drop("_digest", "_bucket", "_start", "_rank")
    )


def running_sums(df: DataFrame, seq: str, order: str, cols: list[str], block: int = 4096) -> DataFrame:
    """Inclusive running sums of `cols` along `order` inside each `seq`.

    A long sequence is cut into blocks of `block` positions: block totals are summed first (again
    in blocks if there are many), then rows within their block, so no task gets a whole long
    sequence. `order` must be a whole number from 0 up, unique in its sequence.
    """
    last = df.agg(F.max(order)).first()[0]
    return _running_sums(df, seq, order, cols, block, 0 if last is None else last)


def _running_sums(df, seq, order, cols, block, last):
    frame = (Window.unboundedPreceding, 0)
    if last < block:
        upto = Window.partitionBy(seq).orderBy(order).rowsBetween(*frame)
        return df.select("*", *[F.sum(c).over(upto).alias(f"sum_{c}") for c in cols])
    place = f"{order}_block"
    blocked = df.withColumn(place, F.floor(F.col(order) / block).cast("bigint"))
    totals = blocked.groupBy(seq, place).agg(*[F.sum(c).alias(c) for c in cols])
    carried = _running_sums(totals, seq, place, cols, block, last // block).select(
        seq, place, *[(F.col(f"sum_{c}") - F.col(c)).alias(f"_carry_{c}") for c in cols]
    )
    upto = Window.partitionBy(seq, place).orderBy(order).rowsBetween(*frame)
    inside = blocked.select("*", *[F.sum(c).over(upto).alias(f"_in_{c}") for c in cols])
    sums = [(F.col(f"_in_{c}") + F.col(f"_carry_{c}")).alias(f"sum_{c}") for c in cols]
    return inside.join(carried, [seq, place]).select(*df.columns, *sums)
