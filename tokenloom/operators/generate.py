"""Continuing many prompts at once from a trie of contexts.

A context is up to order - 1 tokens, and the trie has one row for each context that something follows:
its followers, the most frequent first, as arrays of tokens, of cumulative counts and of the number of
tokens the next context has. That last number is the way on through the trie: the context after a follower
is the longest end of (context, follower) that is a context itself, found once when the trie is built. So a
prompt meets a single row in every step, always that of its longest known context, and finds its draw there
by binary search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import EOS_ID
from tokenloom.operators.ngram import level_counts
from tokenloom.session import HOT_SHARE, MAX_BROADCAST_ROWS, hash_below, lookup_join, salted, stage

CUT_EVERY = 12  # steps between staged states
MAX_TRIE_CELLS = 4_000_000  # followers of a trie that is broadcast, 16 bytes each
ROOT = ""


def _end(tokens: Column, length: Column | int) -> Column:
    """The context of the last `length` tokens."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.array_join(F.slice(tokens, F.size(tokens) - length + 1, length).cast("array<string>"), " ")


def _known_end(rows: DataFrame, tokens: str, contexts: DataFrame, order: int, salt_by: list[str], into: str) -> DataFrame:
    """Adds how many of the last tokens form the longest context, 0 if none do."""
    columns, found = rows.columns, []
    for k in range(order - 1, 0, -1):
        long_enough = F.size(tokens) >= k
        rows = rows.withColumn("_end", F.when(long_enough, _end(F.col(tokens), k)).otherwise(F.lit(ROOT)))
        ends = contexts.select(F.col("context").alias("_end"), F.lit(True).alias(f"_has{k}"))
        rows = lookup_join(rows, ends, ["_end"], "left", salt_by).drop("_end")
        found.append(F.when(F.col(f"_has{k}") & long_enough, F.lit(k)))
    return rows.select(*columns, F.coalesce(*found, F.lit(0)).alias(into))


def context_counts(grams: DataFrame, order: int) -> DataFrame:
    """`(context, next, count)` of all lengths of context from `gram_counts`, staged."""
    return stage(level_counts(grams, order).drop("n"), "contexts")


def context_trie(counts: DataFrame, order: int, top_k: int | None = None) -> DataFrame:
    """`trie(context, next, upto, keep)` from `context_counts`, staged; at most `top_k` followers each if given.

    Followers are ordered by falling count, smaller id first; `upto` sums their counts.
    """
    order_by = Window.partitionBy("context").orderBy(F.desc("count"), "next")
    ranked = counts.withColumn("rank", F.row_number().over(order_by)).withColumn(
        "upto", F.sum("count").over(order_by.rowsBetween(Window.unboundedPreceding, 0)))
    if top_k is not None:
        ranked = ranked.filter(F.col("rank") <= top_k)
    prior = F.when(F.col("context") == ROOT, F.array().cast("array<int>")).otherwise(F.split("context", " ").cast("array<int>"))
    ranked = ranked.withColumn("tokens", F.slice(F.reverse(F.concat(prior, F.array("next"))), 1, order - 1))
    ranked = ranked.withColumn("tokens", F.reverse("tokens"))
    contexts = stage(counts.select("context").distinct(), "nodes")
    led = _known_end(ranked, "tokens", contexts, order, ["context", "next"], "keep")
    followers = F.array_sort(F.collect_list(F.struct("rank", "next", "upto", "keep")))
    trie = led.groupBy("context").agg(followers.alias("f"))
    return stage(trie.select("context", F.col("f.next").alias("next"), F.col("f.upto").alias("upto"),
                             F.col("f.keep").alias("keep")), "trie")


def _first_above(upto: str, draw: str) -> Column:
    """Place (from 1) of the first cumulative count above `draw`, by binary search."""
    above = f"element_at({upto}, CAST((s.lo + s.hi) div 2 AS INT)) > {draw}"
    return F.expr(f"""aggregate(sequence(1, CAST(length(bin(size({upto}))) AS INT)),
        named_struct('lo', 1, 'hi', size({upto})),
        (s, k) -> named_struct(
            'lo', IF(s.lo >= s.hi OR {above}, s.lo, CAST((s.lo + s.hi) div 2 + 1 AS INT)),
            'hi', IF(s.lo < s.hi AND {above}, CAST((s.lo + s.hi) div 2 AS INT), s.hi)),
        s -> s.lo)""")


def _frequent(trie: DataFrame) -> DataFrame:
    """Contexts that many prompts come by, as they hold much of their level's counts: a bounded table."""
    sized = trie.select("context", F.element_at("upto", -1).alias("n"))
    everything = sized.agg(F.max("n")).first()[0] or 0
    return sized.filter(F.col("n") * HOT_SHARE > everything).select("context")


def _fits(trie: DataFrame, max_rows: int) -> bool:
    size = trie.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("next")), F.lit(0)).alias("cells")).first()
    return size["rows"] <= max_rows and size["cells"] <= MAX_TRIE_CELLS


def generate(
    prompts: DataFrame,
    trie: DataFrame,
    order: int,
    steps: int,
    seed: int | None = None,
    n_return: int = 1,
    eos_id: int = EOS_ID,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """`(prompt_id, out)`: up to `steps` tokens after each of `prompts(prompt_id, ids)`.

    Without a seed the most frequent follower is taken. With one, followers are drawn in proportion to
    their counts by whole numbers from a hash of (prompt, step, seed), so a repeated task draws the same.
    With `n_return` > 1 each prompt gives that many rows, numbered prompt_id * n_return + i. A row ends
    after `eos_id`. A trie within the broadcast bounds goes to the prompts; with a larger one both are
    shuffled by context, frequent contexts to many tasks.
    """
    if n_return > 1:
        copy = F.explode(F.sequence(F.lit(0), F.lit(n_return - 1)))
        prompts = prompts.select("ids", "prompt_id", copy.alias("copy")).select(
            (F.col("prompt_id") * n_return + F.col("copy")).alias("prompt_id"), "ids")
    begin = F.greatest(F.size("ids") - order + 2, F.lit(1))
    state = prompts.select("prompt_id", F.slice("ids", begin, order - 1).alias("recent"))
    state = _known_end(state, "recent", trie.select("context"), order, ["prompt_id"], "known")
    state = state.select("prompt_id", "recent", "known", F.array().cast("array<int>").alias("out"))
    hot = None if _fits(trie, max_rows) else stage(_frequent(trie), "hot")
    for step in range(steps):
        # A row that has ended meets nothing; its key of its own keeps such rows apart.
        ended = F.concat(F.lit("end "), F.col("prompt_id").cast("string"))
        state = state.withColumn("context", F.coalesce(_end(F.col("recent"), F.col("known")), ended))
        if hot is None:
            met = state.join(F.broadcast(trie), "context", "left")
        else:
            left, right = salted(state, trie, ["context"], hot, ["prompt_id"])
            met = left.join(right, ["context", "_salt"], "left")
        if seed is None:
            at = F.lit(1)
        else:
            draw = hash_below(F.element_at("upto", -1), F.col("prompt_id"), F.lit(step), F.lit(seed))
            met, at = met.withColumn("draw", draw), _first_above("upto", "draw")
        met = met.withColumn("at", F.when(F.col("next").isNotNull(), at))
        met = met.select("prompt_id", "recent", "out", F.element_at("next", F.col("at")).alias("next"),
                         F.element_at("keep", F.col("at")).alias("keep"))
        goes_on, moved = F.col("next").isNotNull(), F.concat("recent", F.array("next"))
        state = met.select(
            "prompt_id",
            F.when(goes_on, F.slice(moved, F.greatest(F.size(moved) - order + 2, F.lit(1)), order - 1))
            .otherwise(F.col("recent")).alias("recent"),
            F.when(F.col("next") != eos_id, F.col("keep")).alias("known"),
            F.when(goes_on, F.concat("out", F.array("next"))).otherwise(F.col("out")).alias("out"),
        )
        if (step + 1) % CUT_EVERY == 0 and step + 1 < steps:
            state = stage(state, "prompts")
    return state.select("prompt_id", "out")


def generate_greedy(
    prompts: DataFrame, counts: DataFrame, order: int, steps: int, eos_id: int = EOS_ID, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Always the most frequent follower of the longest known context, smaller id first on ties.

    `counts` are `context_counts`.
    """
    return generate(prompts, context_trie(counts, order, 1), order, steps, None, 1, eos_id, max_rows)


def generate_sample(
    prompts: DataFrame,
    counts: DataFrame,
    order: int,
    steps: int,
    seed: int,
    top_k: int | None = None,
    n_return: int = 1,
    eos_id: int = EOS_ID,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Draws followers of the longest known context, among the `top_k` most frequent if given."""
    trie = context_trie(counts, order, top_k)
    return generate(prompts, trie, order, steps, seed, n_return, eos_id, max_rows)
