"""Vocabularies kept as tables, found again by what they were built from."""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.vocab import word_vocab


def fingerprint(corpus: DataFrame, text: str, params: dict) -> str:
    """Digest of the parameters and of the texts, whatever their order."""
    row = corpus.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(text).cast("decimal(20,0)")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("salt"), F.col(text))).alias("b"),
    ).first()
    facts = [json.dumps(params, sort_keys=True), str(row["n"]), str(row["a"]), str(row["b"])]
    return hashlib.md5("|".join(facts).encode()).hexdigest()


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab.write.mode("overwrite").parquet(f"{path}/tokens")
    # Written last: a vocabulary without it is unfinished.
    vocab.agg(F.count("*").alias("n_tokens")).write.mode("overwrite").parquet(f"{path}/finished")


def load_vocab(spark, path: str) -> DataFrame | None:
    """The stored vocabulary, or None if there is none or its write did not finish."""
    try:
        if spark.read.schema("n_tokens bigint").parquet(f"{path}/finished").isEmpty():
            return None
    except AnalysisException:
        return None
    return spark.read.parquet(f"{path}/tokens")


def load_or_build_vocab(
    corpus: DataFrame,
    path: str,
    text: str = "text",
    min_frequency: int = 2,
    max_size: int | None = None,
) -> DataFrame:
    """The vocabulary of this corpus with these parameters, built only if not stored yet."""
    params = {"min_frequency": min_frequency, "max_size": max_size}
    place = f"{path}/{fingerprint(corpus, text, params)}"
    stored = load_vocab(corpus.sparkSession, place)
    if stored is None:
        save_vocab(word_vocab(corpus, text, min_frequency, max_size), place)
        stored = load_vocab(corpus.sparkSession, place)
    return stored
