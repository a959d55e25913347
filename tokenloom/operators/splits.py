"""Exact train/validation splits and shuffled batches without moving more than they must."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.positions import HASH_DIGITS, StreamIndex, row_index
from tokenloom.session import fits, stage

BLOOM_BITS = 1 << 26  # 8 MB
HASHES = 5
PIECE = 1 << 12  # bytes of a filter that are combined at a time


def _inside(index: StreamIndex, position: int, size: Column) -> Column:
    """How many tokens of a document lie before a stream position."""
    if position <= 0:
        return F.lit(0)
    doc, within = index.locate(position)
    if doc is None:
        return size
    key = F.col(index.key)
    return F.when(key < doc, size).when(key == doc, F.lit(within)).otherwise(F.lit(0))


def stream_split(
    docs: DataFrame, index: StreamIndex, bounds: dict[str, tuple[int, int]], ids: str = "ids"
) -> DataFrame:
    """Documents cut at stream positions: one row per document and named [low, high) it meets.

    Only the documents at the bounds are looked up; all others are placed by their key alone, so
    the corpus is not shuffled.
    """
    size = F.size(ids)
    before = {at: _inside(index, at, size) for at in {p for pair in bounds.values() for p in pair}}
    parts = []
    for name, (low, high) in bounds.items():
        begin, end = before[low], before[high]
        part = F.slice(F.col(ids), begin + 1, F.greatest(end - begin, F.lit(0)))
        parts.append(F.struct(F.lit(name).alias("split"), part.alias("_part")))
    met = F.filter(F.array(*parts), lambda p: F.size(p["_part"]) > 0)
    rest = [c for c in docs.columns if c != ids]
    return docs.select(*rest, F.inline(met)).withColumnRenamed("_part", ids)


def prefix_split(docs: DataFrame, index: StreamIndex, fraction: float = 0.9, ids: str = "ids") -> DataFrame:
    """The first int(fraction * N) tokens of the stream are `train`, the rest `val`."""
    cut = int(fraction * index.total)
    return stream_split(docs, index, {"train": (0, cut), "val": (cut, index.total)}, ids)


def tiny_subset(
    docs: DataFrame, index: StreamIndex, train: float = 0.01, val: float = 0.005, ids: str = "ids"
) -> DataFrame:
    """A small head of the stream as `train` and the next tokens as `val`, to check overfitting."""
    first, second = int(train * index.total), int((train + val) * index.total)
    return stream_split(docs, index, {"train": (0, first), "val": (first, second)}, ids)


def random_split(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Adds `split` with exactly int(fraction * n) rows in `train`, in order of a keyed hash.

    The hash at the cut is found from counts per hash prefix and a look inside one prefix; after
    that the split is a plain comparison, so no row moves. `key` must be unique.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    hashed = df.select(key, digest.alias("h"), F.substring(digest, 1, HASH_DIGITS).alias("bucket"))
    # At most 16 ** HASH_DIGITS rows, so one task may order them.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = (
        hashed.groupBy("bucket")
        .count()
        .select("bucket", "count", F.sum("count").over(upto).alias("upto"), F.sum("count").over(everything).alias("n"))
        .withColumn("cut", F.floor(F.lit(fraction) * F.col("n")))
        .filter((F.col("upto") >= F.col("cut")) & (F.col("upto") - F.col("count") < F.col("cut")))
        .first()
    )
    if edge is None:
        return df.withColumn("split", F.lit("val"))
    rank = edge["cut"] - (edge["upto"] - edge["count"])
    in_edge = hashed.filter(F.col("bucket") == edge["bucket"]).orderBy("h", key).limit(rank)
    last = in_edge.agg(F.max(F.struct("h", key)).alias("last")).first()["last"]
    before = (digest < last["h"]) | ((digest == last["h"]) & (F.col(key) <= F.lit(last[key])))
    return df.withColumn("split", F.when(before, "train").otherwise("val"))


def split_leakage(parts: DataFrame, key: str, text: str, seen: str = "train", held: str = "val") -> DataFrame:
    """`(key, n_train)`: rows of the `held` split whose text the `seen` split has, and how often.

    Texts meet by their 256-bit digest and are not shuffled; copies in the `seen` split are counted
    before the join, so a text with many copies is one row there.
    """
    digests = parts.select(key, "split", F.sha2(F.col(text), 256).alias("_digest"))
    known = digests.filter(F.col("split") == seen).groupBy("_digest").agg(F.count("*").alias("n_train"))
    return digests.filter(F.col("split") == held).join(known, "_digest").select(key, "n_train")


def _bloom_places(one: np.ndarray, two: np.ndarray, bits: int) -> np.ndarray:
    """The places of hashed texts in a filter of `bits` bits, HASHES rows of them."""
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (one.view(np.uint64) + steps * (two.view(np.uint64) | np.uint64(1))) % np.uint64(bits)


def bloom_filter(texts: DataFrame, text: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of the texts as bytes of bits. Its size is `bits`, however many texts there are.

    Every task fills a filter of its own and passes on the pieces it used; the pieces are combined per place.
    """
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits, bool)
        for batch in batches:
            one, two = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("one", "two"))
            own[_bloom_places(one, two, bits).ravel().astype(np.int64)] = True
        packed = np.packbits(own).reshape(-1, PIECE)
        used = np.flatnonzero(packed.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([packed[i].tobytes() for i in used], pa.binary())], ["piece", "bits"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, b in zip(batch.column("piece").to_pylist(), batch.column("bits").to_pylist()):
                found[i] = np.frombuffer(b, np.uint8) | found.get(i, 0)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([b.tobytes() for b in found.values()], pa.binary())],
                                         ["piece", "bits"])

    kind = "piece bigint, bits binary"
    hashed = texts.select(F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two"))
    whole = np.zeros((-(-bits // (8 * PIECE)), PIECE), np.uint8)
    for r in hashed.mapInArrow(fill, kind).repartition("piece").mapInArrow(combine, kind).toLocalIterator():
        whole[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return whole.ravel()


def drop_leakage(
    parts: DataFrame, key: str, text: str, seen: str = "train", held: str = "val", bits: int = BLOOM_BITS
) -> DataFrame:
    """`parts` without the rows of the `held` split whose text the `seen` split has.

    Held rows that a Bloom filter of the seen texts rules out are not shuffled at all; the others meet the
    seen texts by digest, so the result is exact. The filter is broadcast: its size is a parameter, and a
    corpus that fills it up only rules out less.
    """
    sent = parts.sparkSession.sparkContext.broadcast(bloom_filter(parts.filter(F.col("split") == seen), text, bits))

    @F.arrow_udf("boolean")
    def maybe(one: pa.Array, two: pa.Array) -> pa.Array:
        places = _bloom_places(*(c.to_numpy(zero_copy_only=False) for c in (one, two)), bits)
        hit = sent.value[(places >> np.uint64(3)).astype(np.int64)] >> (7 - (places & np.uint64(7))).astype(np.uint8) & 1
        return pa.array(hit.all(0))

    rows = parts.select(key, "split", F.sha2(text, 256).alias("_digest"), F.xxhash64(text).alias("_one"), F.xxhash64(F.lit(1), text).alias("_two"))
    asked = rows.filter(F.col("split") == held).filter(maybe.asNondeterministic()("_one", "_two"))
    known = rows.filter(F.col("split") == seen).select("_digest").distinct()
    leaked = stage(asked.join(known, "_digest", "left_semi").select(key), "leaked")
    return parts.join(F.broadcast(leaked) if fits(leaked) else leaked, key, "left_anti")


def shuffle_batches(df: DataFrame, key: str, batch_size: int, seed: int, epoch: int = 0) -> DataFrame:
    """Adds `batch_id` and `row` in a hash order that differs by seed and epoch; last batch kept."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(epoch))))
    return (
        row_index(df, digest, key)
        .withColumn("batch_id", F.floor(F.col("idx") / batch_size))
        .withColumn("row", F.col("idx") % batch_size)
        .drop("idx")
    )
