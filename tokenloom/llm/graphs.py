"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.shared import partitions, stage_small

MAX_ROUNDS = 60
EDGES_PER_TASK = 100_000


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Smallest neighbour of each node, itself included."""
    return edges.groupBy(F.col(node).alias("_n")).agg(F.least(F.min(other), F.first(node)).alias("_m"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of `links` can reach.

    Self-links, repeated links and either direction are fine; null ends are left out. Each round
    joins the links with one row per node; the number of rounds grows with the logarithm of the
    longest path. Links are dealt by node to as many tasks as their number asks for, so that the joins of a
    round need no further exchange. Every round is written to the shared folder, so none depends on any executor.
    """
    x, y = F.col(a), F.col(b)
    edges = stage_small(links.filter(x != y).select(F.least(x, y).alias("v"), F.greatest(x, y).alias("u")).distinct(), "links")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    before = _mark(edges)
    tasks = max(8, min(partitions(links.sparkSession), -(-2 * before[0] // EDGES_PER_TASK)))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "u")

    for _ in range(MAX_ROUNDS):
        both = dealt(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        # Large star: neighbours above a node are tied to the node's smallest neighbour.
        big = dealt(both.join(_least(both, "u", "v"), both.u == F.col("_n")).filter("v > u")
                    .select(F.col("v").alias("u"), F.col("_m").alias("v")).filter("u != v")).distinct()
        # Small star: a node and its neighbours below are tied to the smallest of them.
        low = _least(big, "u", "v")
        joined = big.join(low, big.u == F.col("_n"))
        edges = stage_small(dealt(joined.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("_m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("_m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u != v")).distinct(), "stars")
        mark = _mark(edges)
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return (nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("_to")), "node", "left")
            .select("node", F.coalesce("_to", "node").alias("component")))
