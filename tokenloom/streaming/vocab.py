"""Token counts kept up to date as documents arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.operators.vocab import word_counts

FAN = 8  # segments of a level that are merged into one of the next
COUNTS = "token string, freq bigint"
MANIFEST = "level int, first bigint, last bigint"

Segment = tuple[int, int, int]  # level, first and last batch


def compacted(live: list[Segment], batch_id: int, fan: int = FAN) -> tuple[list[Segment], list[tuple[Segment, list[Segment]]]]:
    """Segments after a batch, and the merges that lead there: (new segment, what it is made of).

    As in counting with `fan` digits: when a level has `fan` segments they become one of the next
    level, so after n batches there are fewer than fan * (log n to base fan + 1) of them, and a count is
    rewritten once per level.
    """
    live = [*live, (0, batch_id, batch_id)]
    merges = []
    while True:
        level = live[-1][0]
        same = [s for s in live if s[0] == level]
        if len(same) < fan:
            return live, merges
        made = (level + 1, same[0][1], same[-1][2])
        merges.append((made, same))
        live = [s for s in live if s[0] != level] + [made]


def _place(path: str, segment: Segment) -> str:
    return f"{path}/segments/{'-'.join(map(str, segment))}"


def _manifest(spark: SparkSession, path: str, batch_id: int) -> list[Segment]:
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/live/batch={batch_id}").collect()
    return sorted((tuple(r) for r in rows), key=lambda s: s[1])


def _read(spark: SparkSession, path: str, segments: list[Segment]) -> DataFrame:
    counts = spark.read.schema(COUNTS).parquet(*[_place(path, s) for s in segments])
    return counts.groupBy("token").agg(F.sum("freq").alias("freq"))


def follow_counts(corpus: DataFrame, path: str, checkpoint: str, text: str = "text", fan: int = FAN) -> StreamingQuery:
    """Counts each micro-batch into a segment of its own and stops when nothing is left.

    Segments are merged level by level, and a list of the live ones is written last, under the batch's
    number. A repeated batch starts from the list of the batch before and writes the same segments again, so
    counts are never added twice, and no state that grows with the vocabulary stays in memory.
    """
    spark = corpus.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _manifest(spark, path, batch_id - 1) if batch_id else []
        live, merges = compacted(before, batch_id, fan)
        word_counts(batch, text).write.mode("overwrite").parquet(_place(path, (0, batch_id, batch_id)))
        for made, parts in merges:
            _read(spark, path, parts).write.mode("overwrite").parquet(_place(path, made))
        spark.createDataFrame(live, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/live/batch={batch_id}")

    return (
        corpus.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_segments(spark: SparkSession, path: str) -> list[Segment]:
    """The segments that hold all batches so far."""
    last = spark.read.schema(f"{MANIFEST}, batch bigint").parquet(f"{path}/live").agg(F.max("batch")).first()[0]
    return _manifest(spark, path, last)


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """`(token, freq)` over all batches so far, from the live segments only."""
    return _read(spark, path, live_segments(spark, path))
