"""Reading corpora and sentence pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.positions import dense_order
from tokenloom.session import lookup_join, spread, stage

TURNS = 1 << 20  # turns of a conversation that a key has room for
ROW_BITS = 33  # low bits of a generated row id, which count rows inside one task


def _row():
    return F.monotonically_increasing_id()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """`corpus(doc_id, text)` from a parquet table, from whole text files, or from lines of text.

    Whole files are numbered in path order. Use `lines` for files too large for one row: every
    line is a row that keeps its newline (if it has one), numbered in path and line order without a sort of the
    text, so that joining the rows in `doc_id` order gives the files back.
    """
    if fmt == "parquet":
        return spread(spark.read.parquet(path).select(F.col("doc_id").cast("bigint"), "text"))
    if fmt == "text":
        files = spark.read.text(path, wholetext=True).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
        )
        ranked = files.select("path").orderBy("path").select("path", _row().alias("doc_id"))
        return lookup_join(files, stage(ranked, "files"), ["path"], "inner").select("doc_id", "text")
    if fmt == "lines":
        lines = spark.read.text(path, lineSep="\n").select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            _row().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row"),
            F.col("_metadata.file_size").alias("file_size"),
            "value",
        )
        # A file whose lines with a newline each are longer than the file ends without one.
        splits = lines.groupBy("path", "start").agg(
            F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("row").alias("last"), F.max("file_size").alias("file_size"))
        splits = stage(dense_order(splits, "path", "start", into="split"), "splits")
        ends = splits.groupBy("path").agg(
            F.max("split").alias("split"), (F.sum("bytes") > F.max("file_size")).alias("open_end"))
        splits = splits.join(ends, ["path", "split"], "left").select(
            "path", "start", "split", F.when(F.col("open_end"), F.col("last")).alias("bare"))
        placed = lookup_join(lines, splits, ["path", "start"], "inner", ["row"])
        newline = F.when(F.coalesce(F.col("bare") == F.col("row"), F.lit(False)), "").otherwise("\n")
        return placed.select(
            (F.shiftleft(F.col("split").cast("bigint"), ROW_BITS) + F.col("row")).alias("doc_id"),
            F.concat("value", newline).alias("text"),
        )
    raise ValueError(f"unknown corpus format {fmt!r}")


def read_pairs(df: DataFrame, src_lang: str, trg_lang: str, pair_id: str = "id") -> DataFrame:
    """`pairs(pair_id, src, trg)` from a `translation` map or struct keyed by language."""
    side = F.col("translation")
    return df.select(
        F.col(pair_id).cast("bigint").alias("pair_id"),
        side[src_lang].alias("src"),
        side[trg_lang].alias("trg"),
    )


def turn_key(conv: Column, turn: Column) -> Column:
    """One number for a turn of a conversation; a turn that would run into the next stops the job."""
    fits_in = (turn >= 0) & (turn < TURNS)
    stop = F.raise_error(F.concat(F.lit("no key for turn "), turn.cast("string"))).cast("bigint")
    return F.when(fits_in | turn.isNull(), conv * TURNS + turn).otherwise(stop)


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Each user turn beside the assistant turn that answers it, as a translation map."""
    asked = conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("src")
    )
    answered = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("trg")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        turn_key(F.col("conv_id"), F.col("turn")).alias("id"),
        F.create_map(F.lit("user"), F.col("src"), F.lit("assistant"), F.col("trg")).alias("translation"),
    )
