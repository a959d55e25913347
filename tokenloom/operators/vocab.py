"""Vocabularies of characters and words, and joins of tokens with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.text import SPECIALS, UNK_ID, distinct_chars
from tokenloom.functions.words import counted_words, word_cutter
from tokenloom.operators.positions import dense_order
from tokenloom.session import MAX_BROADCAST_ROWS, lookup_join

def char_vocab(corpus: DataFrame, text: str = "text") -> DataFrame:
    """`vocab(token, id)`: distinct characters in code-point order, ids from 0.

    Each task passes on the set of its characters. There are at most 1.1 million code points, so
    one task may order the distinct table.
    """
    chars = corpus.select(text).mapInArrow(distinct_chars, "token string").distinct()
    return chars.select("token", (F.row_number().over(Window.orderBy("token")) - 1).alias("id"))


def word_counts(corpus: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """`(…by, token, freq)` over all texts. Each task passes on a word once for many texts."""
    cut = word_cutter(corpus.sparkSession)
    rows = corpus.select(*by, F.col(text).alias("_text"))
    kinds = T.StructType([*rows.schema.fields[:-1], T.StructField("token", T.StringType()), T.StructField("n", T.LongType())])
    counted = rows.mapInArrow(lambda batches: counted_words(batches, by, "_text", cut), kinds)
    return counted.groupBy(*by, "token").agg(F.sum("n").alias("freq"))


def ranked_vocab(counts: DataFrame, min_frequency: int = 2, max_size: int | None = None) -> DataFrame:
    """`vocab(token, id, freq, is_special)`: special tokens first, then words by falling frequency.

    All words of the frequency are kept, unless `max_size` (special tokens included) is given. They
    are numbered by a distributed sort.
    """
    spark = counts.sparkSession
    frequent = dense_order(counts.filter(F.col("freq") >= min_frequency), F.desc("freq"), "token", into="place")
    if max_size is not None:
        frequent = frequent.filter(F.col("place") < max_size - len(SPECIALS))
    numbered = frequent.select(
        "token",
        (F.col("place") + F.lit(len(SPECIALS))).cast("int").alias("id"),
        "freq",
        F.lit(False).alias("is_special"),
    )
    specials = spark.createDataFrame(
        [(t, i, 0, True) for i, t in enumerate(SPECIALS)],
        "token string, id int, freq bigint, is_special boolean",
    )
    return specials.unionByName(numbered)


def word_vocab(
    corpus: DataFrame, text: str = "text", min_frequency: int = 2, max_size: int | None = None
) -> DataFrame:
    return ranked_vocab(word_counts(corpus, text), min_frequency, max_size)


def fit_vocab(
    parts: DataFrame, fit_on: str | None = None, text: str = "text", min_frequency: int = 2, max_size: int | None = None
) -> DataFrame:
    """`word_vocab` of one split of a corpus, as `fit_on="train"`; of all rows if none is named."""
    rows = parts if fit_on is None else parts.filter(F.col("split") == fit_on)
    return word_vocab(rows, text, min_frequency, max_size)


def token_id_join(
    tokens: DataFrame,
    vocab: DataFrame,
    salt_by: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Adds `id` to a table with a `token` column; tokens outside the vocabulary get [UNK]."""
    table = vocab.select("token", "id")
    joined = lookup_join(tokens, table, ["token"], "left", salt_by, max_rows)
    known = F.col("id").isNotNull()
    return joined.withColumn("known", known).withColumn("id", F.coalesce("id", F.lit(UNK_ID)))


def coverage(corpus: DataFrame, vocab: DataFrame, by: str, text: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """Tokens, unknown tokens and their share per group; counted before the join, or given as `word_counts` by group."""
    counts = word_counts(corpus, text, [by]) if counts is None else counts
    return (
        token_id_join(counts.withColumnRenamed("freq", "n"), vocab, salt_by=[by])
        .groupBy(by)
        .agg(
            F.sum("n").alias("n_tokens"),
            F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).cast("bigint").alias("n_unknown"),
        )
        .withColumn("unknown_rate", F.round(F.col("n_unknown") / F.col("n_tokens"), 6))
    )
