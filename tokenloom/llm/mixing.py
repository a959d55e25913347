"""Mixing overlapping sources to target weights by minimum-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). A flow routes the
words of each pattern to the quotas of its sources; the first use of a word is free and each
repetition costs one more than the last, so nothing is repeated while fresh words can fill a quota.
Documents are then taken in a seeded order until their pattern has sent what the flow asks of it.

The driver sees one row per pattern, up to `max_patterns`; more is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tokenloom.llm.flow import FlowNetwork
from tokenloom.llm.shared import mixed, own_prefix

MAX_PATTERNS = 20_000
ROWS_PER_RANGE = 2_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tagged(source: Column) -> Column:
    """A source name that tells null from every text: patterns hold no nulls."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def targets(sizes: dict[str, int], weights: tuple[float, ...], share: float, most: float) -> dict[str, float]:
    """Words wanted of each source.

    Sources by code point (the null source last) get `weights` in turn and divide `share` times all
    sizes. No target is above `most` times its source; what is above goes to the others by weight.
    """
    ordered = sorted(sizes, key=lambda s: (s == "~", s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    wanted: dict[str, float] = {}
    left, open_ = share * sum(sizes.values()), set(ordered)
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = [s for s in ordered if s in open_ and each * weight[s] > most * sizes[s]]
        if not full:
            wanted |= {s: each * weight[s] for s in open_}
            break
        for s in full:
            wanted[s] = most * float(sizes[s])
            left -= wanted[s]
            open_.discard(s)
        left = max(left, 0.0)
    return wanted


def route(
    patterns: dict[tuple[str, ...], int], wanted: dict[str, float], most: int
) -> dict[tuple[tuple[str, ...], str], int]:
    """Words each pattern sends to each of its sources, at the least cost of repetition."""
    names, sources = list(patterns), list(wanted)
    net = FlowNetwork(len(names) + len(sources) + 2)
    start, end = len(names) + len(sources), len(names) + len(sources) + 1
    at = {s: len(names) + j for j, s in enumerate(sources)}
    for s in sources:
        net.edge(at[s], end, round(wanted[s]))
    lanes = {}
    for i, pattern in enumerate(names):
        for repeat in range(most):
            net.edge(start, i, patterns[pattern], repeat)
        for s in pattern:
            lanes[pattern, s] = net.edge(i, at[s], most * patterns[pattern])
    net.solve(start, end)
    return {lane: net.sent(e) for lane, e in lanes.items()}


@dataclass(frozen=True)
class Mixture:
    rows: DataFrame
    """The input with `copies` and `taken` (copies times size)."""
    sources: DataFrame
    """tag, source_size, target."""
    routes: dict
    """(pattern, source tag) -> words sent."""


def mix_sources(
    rows: DataFrame, size: str, sources: Column, order: list[str],
    weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: int = 2,
    seed: int = 7, max_patterns: int = MAX_PATTERNS, rows_per_range: int = ROWS_PER_RANGE,
) -> Mixture:
    """Choose how often each document is used.

    `sources` is an array of `tagged` names: every source that has the document (none: the document
    is left out with zero copies). `order` are the columns that identify a row. A copy is whole, so
    a pattern misses its flow by half a document at most. A document of size 0 is used as its place
    in the order says and takes nothing. Runs with the same seed agree.

    The running sum is taken in two steps: over hash ranges of about `rows_per_range` rows of each pattern,
    then inside a range, so that a pattern with a third of all rows is many groups. Columns named
    `copies` or `taken` are replaced; any other columns stay.
    """
    spark = rows.sparkSession
    p = own_prefix(rows, "_mix_")
    rows = rows.withColumn(f"{p}pattern", F.array_sort(F.array_distinct(sources)))
    sums = rows.groupBy(f"{p}pattern").agg(F.sum(size).alias("s"), F.count("*").alias("n")).limit(max_patterns + 1).collect()
    if len(sums) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(r[f"{p}pattern"]): r["s"] for r in sums}
    sizes: dict[str, int] = {}
    for pattern, words in patterns.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + words
    wanted = targets(sizes, weights, share * sum(patterns.values()) / max(1, sum(sizes.values())), most)
    routes = route(patterns, wanted, most)
    sent = dict.fromkeys(patterns, 0)
    for (pattern, _), v in routes.items():
        sent[pattern] += v
    plan = F.broadcast(spark.createDataFrame(
        [(list(x), n, patterns[x], sent[x]) for n, x in enumerate(patterns)],
        f"{p}pattern array<string>, {p}id int, {p}whole long, {p}sent long"))
    place = mixed(*[F.col(c) for c in order], seed=seed)
    # Ranges of the hash by its leading bits: how many there are does not change the order.
    bits = max(1, (max((r["n"] for r in sums), default=0) // rows_per_range).bit_length())
    rows = (rows.join(plan, f"{p}pattern").withColumn(f"{p}place", place)
            .withColumn(f"{p}bucket", F.shiftright(f"{p}place", 64 - bits)))
    totals = rows.groupBy(f"{p}id", f"{p}bucket").agg(F.sum(size).alias(f"{p}in"))
    totals = totals.withColumn(f"{p}base", F.sum(f"{p}in").over(W.partitionBy(f"{p}id").orderBy(f"{p}bucket")) - F.col(f"{p}in"))
    inside = W.partitionBy(f"{p}id", f"{p}bucket").orderBy(f"{p}place", *order, size).rowsBetween(W.unboundedPreceding, 0)
    rows = (rows.withColumn(f"{p}upto", F.sum(size).over(inside))
            .join(totals.select(f"{p}id", f"{p}bucket", f"{p}base"), [f"{p}id", f"{p}bucket"])
            .withColumn(f"{p}middle", F.col(f"{p}base") + F.col(f"{p}upto") - F.col(size) / 2))
    copies = sum((F.when(F.col(f"{p}middle") + F.col(f"{p}whole") * k <= F.col(f"{p}sent"), 1).otherwise(0)
                  for k in range(most)), F.lit(0))
    copies = F.when(F.size(f"{p}pattern") == 0, 0).otherwise(copies)
    rows = (rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col(size))
            .drop(f"{p}pattern", f"{p}id", f"{p}whole", f"{p}sent", f"{p}place", f"{p}bucket", f"{p}upto", f"{p}base", f"{p}middle"))
    table = spark.createDataFrame(
        [(s, sizes[s], float(wanted[s])) for s in sorted(sizes)], "tag string, source_size long, target double")
    return Mixture(rows, table, routes)
