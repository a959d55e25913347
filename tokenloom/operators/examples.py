"""Padded source/target examples of one fixed length."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import EOS_ID, PAD_ID, SOS_ID
from tokenloom.operators.encode import encode_words


def encode_pairs(pairs: DataFrame, src_vocab: DataFrame, trg_vocab: DataFrame) -> DataFrame:
    """Adds `src_ids` and `trg_ids`, each side by its own vocabulary."""
    one = encode_words(pairs, src_vocab, "pair_id", "src", "src_ids")
    return encode_words(one, trg_vocab, "pair_id", "trg", "trg_ids")


def length_guard(
    pairs: DataFrame, seq_len: int, on_violation: Literal["reject", "error"] = "reject"
) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a source leaves room for two special tokens, a target for one.

    Rejected rows carry a `reason`; with `on_violation="error"` the first one stops the job.
    """
    reason = F.when(F.size("src_ids") > seq_len - 2, "source too long").when(
        F.size("trg_ids") > seq_len - 1, "target too long"
    )
    checked = pairs.withColumn("reason", reason)
    kept, rejected = checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL")
    if on_violation == "error":
        message = F.concat(F.lit("pair "), F.col("pair_id").cast("string"), F.lit(": "), F.col("reason"))
        stop = F.when(F.col("reason").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
        kept = checked.filter(stop).drop("reason")
    return kept, rejected


def _padded(seq_len: int, *parts: Column) -> Column:
    tokens = F.concat(*parts)
    return F.concat(tokens, F.array_repeat(F.lit(PAD_ID), F.lit(seq_len) - F.size(tokens)))


def assemble_examples(pairs: DataFrame, seq_len: int) -> DataFrame:
    """Encoder input, decoder input and label of exactly `seq_len` ids for pairs that fit."""
    sos, eos = F.array(F.lit(SOS_ID)), F.array(F.lit(EOS_ID))
    src, trg = F.col("src_ids"), F.col("trg_ids")
    return pairs.select(
        "pair_id",
        _padded(seq_len, sos, src, eos).alias("encoder_input"),
        _padded(seq_len, sos, trg).alias("decoder_input"),
        _padded(seq_len, trg, eos).alias("label_output"),
        (F.size(src) + 2).alias("enc_len"),
        (F.size(trg) + 1).alias("dec_len"),
        F.col("src").alias("src_text"),
        F.col("trg").alias("trg_text"),
    )


def padding_mask(ids: str) -> Column:
    """1 for tokens, 0 for padding."""
    return F.transform(ids, lambda x: (x != PAD_ID).cast("int"))


def causal_mask(examples: DataFrame) -> DataFrame:
    """`(pair_id, q_pos, visible)`: position q may look at positions 0 … visible - 1.

    A row of the mask is a run of ones up to the query position or to the padding, so its length
    says all of it and no position pairs are stored.
    """
    positions = F.sequence(F.lit(0), F.size("decoder_input") - 1)
    return examples.select("pair_id", "dec_len", F.explode(positions).alias("q_pos")).select(
        "pair_id", "q_pos", F.least(F.col("q_pos") + 1, "dec_len").alias("visible")
    )


def mask_row(visible: Column, seq_len: int) -> Column:
    """A row of the mask as 0/1 values."""
    return F.concat(
        F.array_repeat(F.lit(1), visible), F.array_repeat(F.lit(0), F.lit(seq_len) - visible)
    )


def length_profile(pairs: DataFrame) -> DataFrame:
    """Token lengths per side, to choose a sequence length from."""
    stats = []
    for side in ("src", "trg"):
        n = F.size(f"{side}_ids")
        stats += [
            F.max(n).alias(f"max_{side}"),
            F.min(n).alias(f"min_{side}"),
            F.avg(n).alias(f"avg_{side}"),
            F.percentile_approx(n, 0.95, 100_000).alias(f"p95_{side}"),
        ]
    return pairs.agg(*stats)
