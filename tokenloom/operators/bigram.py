"""Next-token tables from counts, and the losses they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import EOS_ID, PAD_ID, SOS_ID


def framed(docs: DataFrame, ids: str = "ids") -> DataFrame:
    """Documents between start and end ids."""
    return docs.withColumn(ids, F.concat(F.array(F.lit(SOS_ID)), F.col(ids), F.array(F.lit(EOS_ID))))


def pair_counts(docs: DataFrame, by: list[str], ids: str = "ids") -> DataFrame:
    """`(…by, prev, next, n)`: adjacent tokens of each row, counted before anything is joined."""
    n = F.size(ids) - 1
    pairs = F.arrays_zip(
        F.slice(ids, F.lit(1), n).alias("prev"), F.slice(ids, F.lit(2), n).alias("next")
    )
    return (
        docs.filter(F.size(ids) > 1)
        .select(*by, F.inline(pairs).alias("prev", "next"))
        .groupBy(*by, "prev", "next")
        .agg(F.count("*").alias("n"))
    )


def fit_bigram(counts: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """`(prev, next, n, total, p)` with add-alpha smoothing; a context has at most V rows."""
    total = F.sum("n").over(Window.partitionBy("prev"))
    return counts.select("prev", "next", "n", total.alias("total")).withColumn(
        "p", (F.col("n") + alpha) / (F.col("total") + alpha * vocab_size)
    )


def _with_probability(counts: DataFrame, model: DataFrame, vocab_size: int, alpha: float) -> DataFrame:
    """Smoothed probability of each counted pair, seen by the model or not."""
    seen = model.select("prev", "next", F.col("n").alias("seen"))
    contexts = model.groupBy("prev").agg(F.max("total").alias("total"))
    joined = counts.join(contexts, "prev", "left").join(seen, ["prev", "next"], "left")
    n, total = F.coalesce("seen", F.lit(0)), F.coalesce("total", F.lit(0))
    return joined.withColumn("p", (n + alpha) / (total + alpha * vocab_size))


def bigram_loss(
    counts: DataFrame, model: DataFrame, by: list[str], vocab_size: int, alpha: float = 1.0
) -> DataFrame:
    """Mean cross-entropy and perplexity per group, in natural logs."""
    scored = _with_probability(counts, model, vocab_size, alpha)
    nll = F.sum(-F.col("n") * F.log("p")) / F.sum("n")
    return scored.groupBy(*by).agg(
        F.sum("n").alias("tokens"), nll.alias("nll"), F.exp(nll).alias("perplexity")
    )


def uniform_loss(vocab: DataFrame) -> DataFrame:
    """Loss of a model that knows nothing but the vocabulary size."""
    return vocab.agg(F.count("*").alias("vocab_size"), F.log(F.count("*")).alias("uniform_nll"))


def split_loss(
    windows: DataFrame, model: DataFrame, batch_size: int, vocab_size: int, alpha: float = 1.0
) -> DataFrame:
    """Mean over batches of the mean loss per batch, for each split of sampled windows."""
    batch = F.floor(F.col("sample_id") / batch_size).alias("batch")
    tokens = windows.select("split", batch, F.inline(F.arrays_zip(F.col("x"), F.col("y"))).alias("prev", "next"))
    counts = tokens.groupBy("split", "batch", "prev", "next").agg(F.count("*").alias("n"))
    losses = bigram_loss(counts, model, ["split", "batch"], vocab_size, alpha)
    return losses.groupBy("split").agg(F.count("*").alias("batches"), F.avg("nll").alias("loss"))


def smoothed_loss(
    examples: DataFrame,
    model: DataFrame,
    vocab_size: int,
    eps: float = 0.1,
    alpha: float = 1.0,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """Cross-entropy over label positions with label smoothing; padding is left out.

    The smoothing term needs the log-probability of every token after a context: the seen ones are
    summed once per context, the unseen ones all have the same value.
    """
    zipped = F.arrays_zip(F.col("decoder_input"), F.col("label_output"))
    counts = (
        examples.select(F.inline(zipped).alias("prev", "next"))
        .filter(F.col("next") != pad_id)
        .groupBy("prev", "next")
        .agg(F.count("*").alias("n"))
    )
    rest = (vocab_size - F.count("*")) * F.log(alpha / (F.max("total") + alpha * vocab_size))
    spread = model.groupBy("prev").agg((F.sum(F.log("p")) + rest).alias("sum_log"))
    no_context = F.lit(vocab_size) * F.log(F.lit(1.0 / vocab_size))
    scored = _with_probability(counts, model, vocab_size, alpha).join(spread, "prev", "left")
    loss = -(1 - eps) * F.log("p") - eps / vocab_size * F.coalesce("sum_log", no_context)
    return scored.agg(F.sum("n").alias("positions"), (F.sum(F.col("n") * loss) / F.sum("n")).alias("loss"))
