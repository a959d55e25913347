"""Error rates and n-gram overlap of predicted texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import word_tokens
from tokenloom.functions.vectors import bind

FIRST_SURROGATE, SURROGATES = 0xD800, 0x800


def char_error_rate(table: DataFrame) -> DataFrame:
    """Edits between predicted and expected characters over expected characters."""
    edits, length = F.levenshtein("predicted", "expected"), F.length("expected")
    return table.agg(
        F.sum(edits).alias("edits"),
        F.sum(length).alias("length"),
        (F.sum(edits) / F.sum(length)).alias("cer"),
    )


def _letter(number: Column) -> Column:
    """The character with a code point that stands for a number, past the surrogates."""
    shift = F.when(number >= FIRST_SURROGATE, SURROGATES).otherwise(0)
    return F.decode(F.unhex(F.lpad(F.hex(number + shift), 8, "0")), "UTF-32")


def word_edits(a: Column, b: Column) -> Column:
    """Edit distance of two word arrays: each distinct word of the row becomes one character."""
    def spelled(words: Column, known: Column) -> Column:
        return F.array_join(F.transform(words, lambda w: _letter(F.array_position(known, w))), "")

    return bind(
        F.array_distinct(F.concat(a, b)), lambda known: F.levenshtein(spelled(a, known), spelled(b, known))
    )


def word_error_rate(table: DataFrame) -> DataFrame:
    """Edits between predicted and expected words over expected words."""
    words = table.select(
        word_tokens(F.col("predicted")).alias("a"), word_tokens(F.col("expected")).alias("b")
    )
    edits = words.select(word_edits(F.col("a"), F.col("b")).alias("edits"), F.size("b").alias("length"))
    return edits.agg(
        F.sum("edits").alias("edits"),
        F.sum("length").alias("length"),
        (F.sum("edits") / F.sum("length")).alias("wer"),
    )


def _grams(words: Column, max_n: int) -> Column:
    """All runs of 1 … max_n words as (n, gram)."""
    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - n + 1)
        runs = F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), F.slice(words, i, F.lit(n)).alias("gram")))
        return F.when(F.size(words) >= n, runs)

    parts = [of_length(n) for n in range(1, max_n + 1)]
    empty = F.filter(F.array(F.struct(F.lit(0).alias("n"), words.alias("gram"))), lambda _: F.lit(False))
    return F.flatten(F.array(*[F.coalesce(p, empty) for p in parts]))


def corpus_bleu(table: DataFrame, max_n: int = 4) -> DataFrame:
    """Corpus-level overlap: clipped n-gram precisions, their geometric mean, brevity penalty.

    Predicted and expected runs are counted together in one aggregation, so nothing is joined.
    """
    words = table.select(
        "id", word_tokens(F.col("predicted")).alias("a"), word_tokens(F.col("expected")).alias("b")
    )
    both = words.select("id", F.lit(1).alias("made"), F.inline(_grams(F.col("a"), max_n))).unionByName(
        words.select("id", F.lit(0).alias("made"), F.inline(_grams(F.col("b"), max_n)))
    )
    made, given = F.sum("made"), F.sum(1 - F.col("made"))
    counts = both.groupBy("id", "n", "gram").agg(
        made.alias("made"), given.alias("given"), F.least(made, given).alias("hits")
    )

    def level(n: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("n") == n, F.col(name))), F.lit(0))

    levels = range(1, max_n + 1)
    sums = counts.agg(
        *[level(n, "hits").alias(f"hits_{n}") for n in levels],
        *[level(n, "made").alias(f"made_{n}") for n in levels],
        level(1, "made").alias("pred_len"),
        level(1, "given").alias("exp_len"),
    )
    precisions = [F.when(F.col(f"made_{i}") > 0, F.col(f"hits_{i}") / F.col(f"made_{i}")).otherwise(0.0) for i in range(1, max_n + 1)]
    mean_log = sum((F.log(p) for p in precisions), F.lit(0.0)) / max_n
    none = F.least(*precisions) == 0 if max_n > 1 else precisions[0] == 0
    penalty = F.when(F.col("pred_len") > F.col("exp_len"), 1.0).otherwise(
        F.exp(1 - F.col("exp_len") / F.greatest("pred_len", F.lit(1)))
    )
    return sums.select(
        *[p.alias(f"precision_{i}") for i, p in enumerate(precisions, 1)],
        "pred_len",
        "exp_len",
        penalty.alias("brevity"),
        F.when(none, 0.0).otherwise(penalty * F.exp(mean_log)).alias("bleu"),
    )
