"""Sharding by minimum-cost flow: move the fewest bytes from the old shards to the new capacities.

Documents are hashed into blocks inside their old shard, with as many blocks as the shard has
`block_bytes`, so that a shard with a third of all rows has a third of all blocks. The driver sees
one row per block, at most `shards * blocks_per_shard` plus one per old shard, and solves

* a flow from old shards to new ones, where a byte that keeps its shard number costs nothing and any
  other costs one: its optimum is the fewest bytes that must move;
* the rounding of that flow to whole blocks, largest first, and a last exchange of blocks between
  the fullest and the emptiest shards.

Documents follow their block by a broadcast join with the block table. No text is shuffled.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tokenloom.llm.flow import FlowNetwork
from tokenloom.llm.shared import mixed, own_prefix

BLOCKS_PER_SHARD = 512
ROW_BYTES = 16


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed cost per row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def fewest_moves(old: dict[int, int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to send from each old shard to each new one, moving as few as possible.

    Old numbers need not exist among the new ones. The capacities together must hold everything.
    """
    names, shards = sorted(old), len(capacity)
    net = FlowNetwork(len(names) + shards + 2)
    source, sink = len(names) + shards, len(names) + shards + 1
    for i, name in enumerate(names):
        net.edge(source, i, old[name])
    for j, room in enumerate(capacity):
        net.edge(len(names) + j, sink, room)
    lanes = {(name, j): net.edge(i, len(names) + j, old[name], int(name != j))
             for i, name in enumerate(names) for j in range(shards)}
    if net.solve(source, sink) != sum(old.values()):
        raise ValueError("the new shards cannot hold all bytes")
    return {lane: net.sent(e) for lane, e in lanes.items() if net.sent(e)}


def place_blocks(
    blocks: list[tuple[int, int, int]], sent: dict[tuple[int, int], int], capacity: list[int]
) -> dict[tuple[int, int], int]:
    """New shard of each block (old, block, bytes), close to the flow `sent`.

    Largest blocks first, each along the lane of its old shard with the most bytes left to send.
    """
    lanes: dict[int, list[tuple[int, int]]] = {}
    for (old, new), amount in sent.items():
        lanes.setdefault(old, []).append((-amount, new))
    for lane in lanes.values():
        heapq.heapify(lane)
    held: list[list[tuple[int, int, int]]] = [[] for _ in capacity]
    load = [0] * len(capacity)
    for old, block, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        left, new = lanes[old][0]
        heapq.heapreplace(lanes[old], (left + size, new))
        held[new].append((size, old, block))
        load[new] += size
    for shard in held:
        shard.sort()
    for _ in range(4 * len(blocks)):
        over = max(range(len(load)), key=lambda j: (load[j] - capacity[j], -j))
        under = min(range(len(load)), key=lambda j: (load[j] - capacity[j], j))
        gap = load[over] - capacity[over] - load[under] + capacity[under]
        at = bisect.bisect_left(held[over], (gap,)) - 1
        if at < 0:
            break
        # The block nearest to half the gap narrows it the most; any smaller than the gap narrows it.
        near = bisect.bisect_left(held[over], (gap // 2,))
        at = min((i for i in (near - 1, near, at) if 0 <= i <= at), key=lambda i: abs(2 * held[over][i][0] - gap))
        moved = held[over].pop(at)
        bisect.insort(held[under], moved)
        load[over] -= moved[0]
        load[under] += moved[0]
    return {(old, block): j for j, shard in enumerate(held) for _, old, block in shard}


def reshard(
    rows: DataFrame, old: Column, size: Column, order: list[str], shards: int,
    weights: list[int] | None = None, blocks_per_shard: int = BLOCKS_PER_SHARD,
) -> DataFrame:
    """`rows` with `old_shard`, `shard` (0 to shards - 1), `slot` (gapless from 0) and `moved`.

    `old` gives the present shard (null counts as shard 0), `weights` the relative capacity of the
    new ones (equal if not given), `order` the columns that order rows inside a block and spread
    them over blocks; rows equal in all of them may swap slots. An empty table gives an empty one.
    Columns of the four names are replaced; any other columns stay.
    """
    spark = rows.sparkSession
    p = own_prefix(rows, "_move_")
    rows = rows.drop("old_shard", "shard", "slot", "moved")
    rows = rows.withColumn(f"{p}from_shard", F.coalesce(old, F.lit(0)).cast("int")).withColumn(f"{p}weight", size)
    sizes = {r[f"{p}from_shard"]: r["s"] for r in rows.groupBy(f"{p}from_shard").agg(F.sum(f"{p}weight").alias("s")).collect()}
    total = sum(sizes.values())
    weights = weights or [1] * shards
    edges = [total * sum(weights[:j]) // sum(weights) for j in range(shards + 1)]
    capacity = [b - a for a, b in zip(edges, edges[1:])]
    grain = max(1, total // (shards * blocks_per_shard))
    counts = F.broadcast(spark.createDataFrame(
        [(k, -(-v // grain)) for k, v in sizes.items()], f"{p}from_shard int, {p}blocks long"))
    rows = (rows.join(counts, f"{p}from_shard")
            .withColumn(f"{p}block", F.pmod(mixed(*[F.col(c) for c in order], seed=5), F.col(f"{p}blocks"))))
    blocks = [(r[f"{p}from_shard"], r[f"{p}block"], r["s"], r["n"]) for r in rows.groupBy(f"{p}from_shard", f"{p}block").agg(
        F.sum(f"{p}weight").alias("s"), F.count("*").alias("n")).collect()]
    placed = place_blocks([b[:3] for b in blocks], fewest_moves(sizes, capacity), capacity)
    base, filled = [], [0] * shards
    for old_shard, block, _, n in sorted(blocks):
        new = placed[old_shard, block]
        base.append((old_shard, block, new, filled[new]))
        filled[new] += n
    table = F.broadcast(spark.createDataFrame(base, T.StructType([
        T.StructField(f"{p}from_shard", T.IntegerType()), T.StructField(f"{p}block", T.LongType()),
        T.StructField("shard", T.IntegerType()), T.StructField(f"{p}base", T.LongType())])))
    rank = F.row_number().over(W.partitionBy(f"{p}from_shard", f"{p}block").orderBy(*order))
    return (rows.withColumn(f"{p}rank", rank.cast("long")).join(table, [f"{p}from_shard", f"{p}block"])
            .withColumn("slot", F.col(f"{p}base") + F.col(f"{p}rank") - 1)
            .withColumn("moved", F.col(f"{p}from_shard") != F.col("shard"))
            .withColumnRenamed(f"{p}from_shard", "old_shard")
            .drop(f"{p}weight", f"{p}block", f"{p}blocks", f"{p}rank", f"{p}base"))


def rewrite(resharded: DataFrame, old_folder: str, new_folder: str) -> DataFrame:
    """Write the shards that gain or lose rows, and return where each shard is now: (shard, path).

    `resharded` comes from `reshard` with all columns of the documents. A shard whose rows all stay
    keeps its old files, which are laid out as `old_folder`/shard=K. Rows are dealt by ranges of shard and
    slot, so a large shard is written by many tasks, to files that follow each other in the order of slots.
    """
    spark = resharded.sparkSession
    places = resharded.select("old_shard", "shard", "moved").distinct().collect()  # at most old times new shards
    changed = sorted({s for r in places if r["moved"] for s in (r["old_shard"], r["shard"])})
    every = sorted({r["shard"] for r in places})
    (resharded.filter(F.col("shard").isin(changed)).drop("old_shard", "moved")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(new_folder))
    return spark.createDataFrame(
        [(s, f"{new_folder if s in changed else old_folder}/shard={s}") for s in every], "shard int, path string")
