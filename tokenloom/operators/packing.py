"""Training windows cut from the one stream that all documents form.

Documents are sorted by range and encoded where they arrive; each task joins its documents to blocks of
ids as it writes them. A block knows its place in the stream from the totals of the parts before it, so
windows are cut from blocks without looking at documents again. Only windows that cross the end of a block
are put together from several rows, each of at most T tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import list_lengths, list_offsets, row_slices
from tokenloom.functions.words import value_sizes
from tokenloom.operators.encode import CharEncoder
from tokenloom.operators.positions import StreamIndex, part_starts
from tokenloom.session import MAX_BROADCAST_ROWS, fits, hash_below, stage

BLOCK = 1 << 14  # tokens of a block
ROW_GROUP = 4 << 20  # bytes of staged blocks that a task holds at a time

Encoder = Callable[[DataFrame], DataFrame]


def with_separator(docs: DataFrame, sep_id: int, ids: str = "ids") -> DataFrame:
    """Ends every document with a separator id."""
    return docs.withColumn(ids, F.concat(ids, F.array(F.lit(sep_id))))


def _whole(value: Column) -> Column:
    return F.floor(value).cast("bigint")


@dataclass(frozen=True)
class TokenBlocks:
    """`blocks(…by, ids, head, tail, size, start)`: the stream in order, with the first and last T ids of each block.

    With `by` there is a stream for each of its values. `totals(…by, total)` has their lengths.
    """

    blocks: DataFrame
    totals: DataFrame
    T: int
    by: tuple[str, ...] = ()

    @property
    def total(self) -> int:
        return self.totals.first()["total"]


def _blocks_of(batches: Iterator[pa.RecordBatch], by: tuple[str, ...], T: int, block: int) -> Iterator[pa.RecordBatch]:
    """Joins rows, sorted by `by`, to blocks of ids; a block ends with its value of `by`."""
    part = TaskContext.get().partitionId()
    value, held, room, before = None, [], 0, 0

    def flush() -> pa.RecordBatch:
        ids = np.concatenate(held)
        lists = [pa.array([x], pa.list_(pa.int32())) for x in (ids, ids[:T], ids[-T:])]
        numbers = [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64())]
        keys = [pa.array([v], k) for v, k in zip(value or (), kinds)]
        return pa.RecordBatch.from_arrays([*keys, *numbers, *lists], [*by, "part", "before", "size", "ids", "head", "tail"])

    for batch in batches:
        kinds = [batch.column(c).type for c in by]
        flat = pc.list_flatten(batch.column("ids")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(list_lengths(batch.column("ids")))
        keys = list(zip(*(batch.column(c).to_pylist() for c in by))) if by else [None] * len(ends)
        at, row = 0, 0
        while row < len(keys):
            if keys[row] != value:
                if room:
                    yield flush()
                value, held, room, before = keys[row], [], 0, 0
            last = row
            while by and last < len(keys) and keys[last] == value:
                last += 1
            last = last if by else len(keys)
            stop = int(ends[last - 1])
            while at < stop:
                some = flat[at : min(stop, at + block - room)]
                held.append(some)
                room += len(some)
                at += len(some)
                if room == block:
                    yield flush()
                    held, room, before = [], 0, before + block
            row = last
    if room:
        yield flush()


def _coded(batches: Iterator[pa.RecordBatch], by: tuple[str, ...], code: Callable[[pa.Array], pa.Array]) -> Iterator[pa.RecordBatch]:
    """The rows with ids instead of texts, some at a time, so that the ids of a batch are never held together."""
    for batch in batches:
        for a, b in row_slices(value_sizes(batch.column("ids"))):
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in by), code(rows.column("ids"))], [*by, "ids"])


def token_blocks(
    docs: DataFrame, order: str | list[str], T: int, encode: Encoder | None = None, by: tuple[str, ...] = (), block: int = BLOCK
) -> TokenBlocks:
    """The stream of all documents in the order of `order`, which must be total, staged once.

    `encode` adds `ids` to the sorted documents, so that text is moved and not ids. One scan, one encoding.
    A `CharEncoder` works in the tasks that join the blocks.
    """
    keys = [*by, *([order] if isinstance(order, str) else order)]
    ordered = docs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    code = encode.in_task() if isinstance(encode, CharEncoder) else None
    if code:
        encoded = ordered.select(*by, F.col(encode.text).alias("ids"))
    else:
        encoded = (encode(ordered) if encode else ordered).select(*by, "ids")
    kinds = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in by)
    rows = encoded.mapInArrow(
        lambda batches: _blocks_of(_coded(batches, by, code) if code else batches, by, T, block),
        f"{kinds}part int, before bigint, size bigint, ids array<int>, head array<int>, tail array<int>")
    # A reader takes thousands of rows of a row group at once, so it is the row groups that bound its memory.
    staged = stage(rows, "blocks", ROW_GROUP)
    starts = part_starts(staged, list(by))
    starts = starts if by and not fits(starts) else F.broadcast(starts)
    blocks = staged.join(starts, [*by, "part"]).withColumn("start", F.col("start") + F.col("before")).drop("part", "before")
    total = F.coalesce(F.sum("size"), F.lit(0)).alias("total")
    return TokenBlocks(blocks, staged.groupBy(*by).agg(total) if by else staged.agg(total), T, by)


def _joined_parts() -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("start", "part")))
    return F.flatten(F.transform(ordered, lambda p: p["part"]))


def _shifted(df: DataFrame, T: int) -> DataFrame:
    """Inputs and targets of a run of T + 1 tokens."""
    return df.withColumn("x", F.slice("run", 1, T)).withColumn("y", F.slice("run", 2, T)).drop("run")


def _upto(low: Column, high: Column) -> Column:
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def cut_windows(stream: TokenBlocks) -> DataFrame:
    """`(…by, window_id, run)`: every window of T + 1 tokens that begins at a multiple of T and is whole."""
    T, by = stream.T, list(stream.by)
    start, end = F.col("start"), F.col("start") + F.col("size")
    first = _whole((start + T - 1) / T)
    inside = _upto(first, _whole((end - T - 1) / T))
    runs = F.transform(inside, lambda w: F.struct(
        w.alias("window_id"), F.slice("ids", (w * T - start + 1).cast("int"), T + 1).alias("run")))
    whole = stream.blocks.select(*by, F.inline(runs))
    # Windows over the begin of a block, and those over its end only: at most two of either.
    over_begin = _upto(_whole((start - T - 1) / T) + 1, _whole((start - 1) / T))
    over_end = F.filter(_upto(F.greatest(first, _whole((end - T - 1) / T) + 1), _whole((end - 1) / T)), lambda w: w * T + T + 1 > end)
    head = F.transform(F.filter(over_begin, lambda w: w >= 0), lambda w: F.struct(
        w.alias("window_id"), start.alias("start"), F.slice("head", 1, (F.least(w * T + T + 1, end) - start).cast("int")).alias("part")))
    tail = F.transform(over_end, lambda w: F.struct(
        w.alias("window_id"), (w * T).alias("start"),
        F.slice("tail", (F.size("tail") - (end - w * T) + 1).cast("int"), (end - w * T).cast("int")).alias("part")))
    parts = stream.blocks.select(*by, F.inline(F.concat(head, tail)))
    crossing = parts.groupBy(*by, "window_id").agg(_joined_parts().alias("run")).filter(F.size("run") == T + 1)
    return whole.unionByName(crossing)


def pack_windows(stream: TokenBlocks, B: int) -> DataFrame:
    """`(window_id, batch_id, row, x, y)`: consecutive windows in batches of B, the tail dropped."""
    T = stream.T
    n_windows = max(0, stream.total - 1) // (B * T) * B
    batch, row = _whole(F.col("window_id") / B), F.col("window_id") % B
    kept = _shifted(cut_windows(stream).filter(F.col("window_id") < n_windows), T)
    return kept.select("window_id", batch.alias("batch_id"), row.alias("row"), "x", "y")


def sample_begins(index: StreamIndex, n: int, T: int, seed: int, low: int = 0, high: int | None = None) -> DataFrame:
    """`(sample_id, begin)`: n starts with replacement, uniform in [low, high - T), from a hash of (sample, seed)."""
    high = index.total if high is None else high
    if high - low <= T:
        raise ValueError("the stream is not longer than one window")
    begin = F.lit(low) + hash_below(high - low - T, F.col("id"), F.lit(seed))
    return index.offsets.sparkSession.range(n).select(F.col("id").alias("sample_id"), begin.alias("begin"))


def _met_documents(index: StreamIndex, begins: DataFrame, T: int, max_rows: int) -> DataFrame:
    """`(key, offset, begins)`: documents that share tokens with [begin, begin + T], found in the table of offsets.

    A bounded list of begins is sorted and searched inside the tasks. A longer one is met on blocks of the
    stream that are long enough for about four blocks per begin, so that a document lies in few of them.
    """
    rows = begins.select("begin").distinct()
    offsets = index.offsets.filter("size > 0")
    found = rows.limit(max_rows + 1).toArrow().column("begin").to_numpy()
    if len(found) <= max_rows:
        sought = np.sort(found)

        @F.arrow_udf("array<bigint>")
        def meeting(offset: pa.Array, size: pa.Array) -> pa.Array:
            o = offset.to_numpy(zero_copy_only=False)
            low = np.searchsorted(sought, o - T, "left")
            high = np.searchsorted(sought, o + size.to_numpy(zero_copy_only=False), "left")
            counts = high - low
            at = np.arange(int(counts.sum())) + np.repeat(low - np.cumsum(counts) + counts, counts)
            return pa.ListArray.from_arrays(list_offsets(counts), pa.array(sought[at], pa.int64()))

        met = offsets.withColumn("begins", meeting.asNondeterministic()(F.col("offset"), F.col("size")))
        return met.filter(F.size("begins") > 0).select(index.key, "offset", "begins")
    length = max(T + 1, index.total // (4 * rows.count()))
    block = lambda c: _whole(c / length)
    wanted = rows.withColumn("_block", F.explode(F.sequence(block(F.col("begin")), block(F.col("begin") + T))))
    end = F.col("offset") + F.col("size") - 1
    placed = offsets.withColumn("_block", F.explode(F.sequence(block(F.col("offset")), block(end))))
    overlap = (F.col("begin") <= end) & (F.col("begin") + T >= F.col("offset"))
    # Begins look small to the planner, which would send them all through the driver.
    return (placed.join(wanted.hint("merge"), "_block").filter(overlap).groupBy(index.key, "offset")
            .agg(F.collect_set("begin").alias("begins")))


def windows_at(
    docs: DataFrame, index: StreamIndex, samples: DataFrame, T: int, encode: Encoder | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """`samples` (with `begin`) with x and y: the T tokens from `begin` on, and the same one further.

    The documents under the samples are found from their offsets before anything is encoded; only they are.
    """
    met = stage(_met_documents(index, samples, T, max_rows), "met")
    small = fits(met.select(F.explode("begins")), max_rows)
    chosen = docs.join(F.broadcast(met) if small else met.hint("merge"), index.key)
    chosen = encode(chosen) if encode else chosen
    first, last = F.col("offset"), F.col("offset") + F.size("ids")
    parts = F.transform("begins", lambda b: F.struct(
        b.alias("begin"), F.greatest(b, first).alias("start"),
        F.slice("ids", (F.greatest(b, first) - first + 1).cast("int"),
                (F.least(b + T + 1, last) - F.greatest(b, first)).cast("int")).alias("part")))
    runs = chosen.select(F.inline(parts)).groupBy("begin").agg(_joined_parts().alias("run"))
    return _shifted(samples.join(runs if small else runs.hint("merge"), "begin"), T)


def random_windows(
    docs: DataFrame, index: StreamIndex, n: int, T: int, seed: int, low: int = 0, high: int | None = None,
    encode: Encoder | None = None, max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """`(sample_id, start, x, y)`: n windows with replacement from [low, high) of the stream."""
    made = windows_at(docs, index, sample_begins(index, n, T, seed, low, high), T, encode, max_rows)
    return made.select("sample_id", F.col("begin").alias("start"), "x", "y")


def next_tokens(docs: DataFrame, ids: str = "ids") -> DataFrame:
    """Adds x and y: the tokens of a row, and the same shifted by one."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return docs.withColumn("x", F.slice(ids, F.lit(1), n)).withColumn("y", F.slice(ids, F.lit(2), n))


def prefix_expand(windows: DataFrame) -> DataFrame:
    """Every prefix of x with the token that follows it, as `(…, t, context, target)`."""
    rest = [c for c in windows.columns if c not in ("x", "y")]
    pairs = F.transform("y", lambda y, t: F.struct(t.alias("t"), F.slice("x", F.lit(1), t + 1).alias("context"), y.alias("target")))
    return windows.select(*rest, F.inline(pairs))


def epoch_plan(index: StreamIndex, B: int, T: int, total_batch: int) -> DataFrame:
    """Tokens, batches, windows, dropped tail and micro-batches per optimizer step."""
    if total_batch % (B * T):
        raise ValueError("total_batch must be a multiple of B * T")
    n = F.coalesce(F.sum("size"), F.lit(0))
    batches = _whole(F.greatest(n - 1, F.lit(0)) / (B * T))
    return index.offsets.agg(
        n.alias("n_tokens"),
        batches.alias("n_batches"),
        (batches * B).alias("n_windows"),
        (n - batches * B * T).alias("tail_tokens"),
        F.lit(total_batch // (B * T)).cast("bigint").alias("micro_batches"),
    )


def batches_for_steps(windows: DataFrame, n_batches: int, start: int, n_steps: int) -> DataFrame:
    """The batch of every step; after the last batch the cursor returns to the first.

    No window moves: each meets the numbers of the epochs, which tell the steps that come to its batch.
    Without batches there are no rows.
    """
    first, last = (start // n_batches, (start + n_steps - 1) // n_batches) if n_batches else (0, -1)
    epochs = windows.sparkSession.range(first, last + 1).select(F.col("id").alias("_epoch"))
    if last - first < MAX_BROADCAST_ROWS:
        epochs = F.broadcast(epochs)
    at = F.col("_epoch") * n_batches + F.pmod("batch_id", F.lit(n_batches))
    met = (at % n_batches == F.col("batch_id")) & at.between(start, start + n_steps - 1)
    rest = [c for c in windows.columns if c != "batch_id"]
    return windows.join(epochs, met).select("batch_id", *rest, (at - start).alias("step"), F.col("_epoch").alias("epoch"))
