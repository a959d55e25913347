"""Windows cut from endless token streams, with the leftover carried to the next batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.operators.packing import Encoder, _shifted, _whole, cut_windows, token_blocks
from tokenloom.session import lookup_join, stage

WINDOWS = "source string, window_id bigint, x array<int>, y array<int>"
LEFT = "source string, next_id bigint, ids array<int>"


def pack_batch(docs: DataFrame, left: DataFrame, T: int, encode: Encoder | None = None, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Windows of one batch, and what is left of every source's stream after them.

    `docs` has source, the key and what `encode` needs; `left` (LEFT) is what earlier batches left: at
    most T tokens per source, which go before its documents. All sources are packed together, by range: a
    source with most of the tokens is spread over as many tasks as its tokens need.
    """
    named = docs.withColumn("source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    kept = [c for c in named.columns if c not in ("source", "_first", "_left")]
    carried = left.select("source", F.lit(0).alias("_first"), F.col("ids").alias("_left"))
    rows = carried.unionByName(named.select("source", *kept, F.lit(1).alias("_first")), allowMissingColumns=True)

    def with_left(df: DataFrame) -> DataFrame:
        made = encode(df) if encode else df
        return made.withColumn("ids", F.coalesce("_left", "ids"))

    stream = token_blocks(rows, ["_first", key], T, with_left, ("source",))
    known = left.select("source", F.col("next_id").alias("_id"))
    ends = stage(
        stream.totals.join(known, "source", "full").select(
            "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("_id", F.lit(0)).alias("_id"))
        .withColumn("_n", _whole(F.greatest(F.col("total") - 1, F.lit(0)) / T)), "ends")
    windows = lookup_join(cut_windows(stream), ends, ["source"], "inner", ["window_id"])
    windows = _shifted(windows, T).select("source", (F.col("_id") + F.col("window_id")).alias("window_id"), "x", "y")
    # The last tokens lie in the tails of a source's last blocks.
    size, end = F.col("size"), F.col("start") + F.col("size")
    last = lookup_join(stream.blocks.select("source", "start", "size", "tail"), ends, ["source"], "inner", ["start"])
    take = F.least(end - F.col("_n") * T, size, F.lit(T)).cast("int")
    rest = (last.filter(end > F.col("_n") * T).select("source", "start", F.slice("tail", F.size("tail") - take + 1, take).alias("part"))
            .groupBy("source").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "part"))), lambda p: p["part"])).alias("ids")))
    none = F.array().cast("array<int>")
    after = ends.join(rest, "source", "left").select(
        "source", (F.col("_id") + F.col("_n")).alias("next_id"), F.coalesce("ids", none).alias("ids"))
    return windows, after


def pack_stream(
    docs: DataFrame, path: str, checkpoint: str, T: int, encode: Encoder | None = None, key: str = "doc_id"
) -> StreamingQuery:
    """Packs each micro-batch into a folder of its own under `path` and stops when nothing is left.

    What a batch leaves is written beside its windows under the batch's number, and the next batch
    reads it from there. A repeated batch starts from the same leftover and writes the same folders again,
    so no token is lost or used twice, whenever a run breaks off.
    """
    spark = docs.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            left = spark.read.schema(LEFT).parquet(f"{path}/left/{batch_id - 1}")
        else:
            left = spark.createDataFrame([], LEFT)
        windows, after = pack_batch(batch, left, T, encode, key)
        windows.write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
        after.write.mode("overwrite").parquet(f"{path}/left/{batch_id}")

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def packed_windows(spark: SparkSession, path: str) -> DataFrame:
    """`(source, window_id, x, y)` of all batches so far."""
    return spark.read.schema(f"{WINDOWS}, batch bigint").parquet(f"{path}/windows").drop("batch")
