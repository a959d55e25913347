"""Word translation tables learned from sentence pairs."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import SPECIALS, UNK_ID, list_lengths, list_offsets
from tokenloom.session import MAX_BROADCAST_ROWS, lookup_join, stage


CELLS = 1 << 20  # word pairs that a task works on at a time; a target word with more of them is cut into slices
BLOCK = 16  # times CELLS: word pairs of a block
CUT_EVERY = 8  # steps after which blocks keep their shares instead of taking the steps again
TOTAL = 0xFFFFFFFF  # stands for all target words of a source word
FLUSH = 16 << 20  # bytes of sentences that a task packs together

# What a block has (step 0), what it kept at a step (parts below 0), and the sums it asked for in a step, bucket by bucket.
BLOCKS = "block int, step int, part int, rows binary, sums binary"
MESSAGES = "bucket int, block int, part int, codes binary, sums binary"  # bucket -1: kept by the block
TABLE = "src int, trg int, p double"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _arrow(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _hash_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _places(words: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where `words` are in the sorted `among`, -1 for those that are not."""
    if not len(among):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(among, words), len(among) - 1)
    return np.where(among[at] == words, at, -1)


def _pack(dealt: dict[int, list[tuple]], part: int) -> pa.RecordBatch:
    """One row per block: its sentences in compressed columns, source words as steps from the one before."""
    rows = []
    for block, sentences in sorted(dealt.items()):
        columns = [pa.ListArray.from_arrays(list_offsets(np.array([len(x) for x in c])), pa.array(np.concatenate(c))) for c in zip(*sentences)]
        table, out = pa.RecordBatch.from_arrays(columns, ["src", "n_src", "trg", "n_trg"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(table)
        rows.append((block, 0, part, out.getvalue().to_pybytes(), None))
    return _rows(rows, BLOCKS)


def _deal(batches: Iterator[pa.RecordBatch], n_blocks: int, frequent: np.ndarray, slices: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each sentence pair to the blocks of its target words: the source words with counts, and the target words dealt there."""
    task, dealt, room = TaskContext.get().partitionId(), {}, 0
    for batch in batches:
        for src, trg, weight, spot in zip(*(batch.column(c) for c in ("src_ids", "trg_ids", "weight", "spot"))):
            s, n_s = np.unique(np.array(src.values, np.int32), return_counts=True)
            t, n_t = np.unique(np.array(trg.values, np.int64), return_counts=True)
            place = _places(t, frequent)
            n_slices = np.where(place < 0, 1, np.append(slices, 1)[place])
            block = _hash_of(t << 32 | spot.as_py() % n_slices, n_blocks)
            order = np.argsort(block, kind="stable")
            steps, n_s, n_t = np.diff(s, prepend=np.int32(0)), n_s.astype(np.int32), n_t * weight.as_py()
            for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                dealt.setdefault(int(block[part[0]]), []).append((steps, n_s, t[part].astype(np.int32), n_t[part]))
                room += 8 * len(s) + 12 * len(part)
            if room > FLUSH:
                yield _pack(dealt, task)
                dealt, room = {}, 0
    if dealt:
        yield _pack(dealt, task)


class _Cells(NamedTuple):
    """Word pairs of some target words in all sentences of a block, a sentence's source words side by side."""

    trg: np.ndarray  # target word of each key
    word: np.ndarray  # place of each key's source word
    which: np.ndarray  # key of each cell
    n_src: np.ndarray  # count of each cell's source word in its sentence
    row: np.ndarray  # target word of a sentence that each cell belongs to
    begins: np.ndarray
    n_all: np.ndarray
    n_trg: np.ndarray
    frequent: bool

    def first(self) -> np.ndarray:
        """Shares per key when all source words are equally likely."""
        return np.bincount(self.which, self.n_src * (self.n_trg / self.n_all)[self.row], len(self.trg))

    def next(self, shares: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Each target word's count shared among the source words of its sentence by the table that `shares` make."""
        cells = self.n_src * (shares / totals[self.word])[self.which]
        per_count = self.n_trg / np.maximum(np.add.reduceat(cells, self.begins), 1e-300)
        return np.bincount(self.which, cells * per_count[self.row], len(self.trg))


class _Block:
    """The sentences of a block: source words as places in the list of the block's own, and their target words in order."""

    def __init__(self, rows: list[dict], frequent: np.ndarray, cells: int):
        tables = []
        for r in rows:
            with pa.ipc.open_stream(pa.py_buffer(r["rows"])) as reader:
                tables.append(reader.read_next_batch())

        def column(name: str) -> tuple[np.ndarray, np.ndarray]:
            parts = [x.column(name) for x in tables]
            return np.concatenate([list_lengths(c) for c in parts]), np.concatenate([c.flatten().to_numpy() for c in parts])

        self.sizes, steps = column("src")
        self.begins = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        upto = np.cumsum(steps, dtype=np.int64)
        src = (upto - np.repeat(upto[self.begins] - steps[self.begins], self.sizes)).astype(np.int32)
        self.words, at = np.unique(src, return_inverse=True)
        self.at = at.astype(np.int32)
        self.n_src = column("n_src")[1]
        self.n_all = np.add.reduceat(self.n_src, self.begins, dtype=np.int64)
        (n, trg), n_trg = column("trg"), column("n_trg")[1]
        sentence = np.repeat(np.arange(len(n)), n)
        order = np.argsort(trg, kind="stable")
        self.trg, self.sentence, self.n_trg = trg[order], sentence[order], n_trg[order]
        # Runs of target words with about `cells` word pairs; a frequent one is a run of its own.
        first = np.flatnonzero(np.r_[True, np.diff(self.trg) != 0])
        self.is_frequent = _places(self.trg[first], frequent) >= 0
        filled = np.cumsum(np.add.reduceat(self.sizes[self.sentence], first)) // cells
        new = np.r_[True, (np.diff(filled) > 0) | self.is_frequent[1:] | self.is_frequent[:-1]]
        self.runs = list(zip(first[new].tolist(), [*first[new][1:].tolist(), len(self.trg)], self.is_frequent[new].tolist()))

    def _spread(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cells of target words a to b: target word, where each begins, and place among the block's source words."""
        sizes = self.sizes[self.sentence[a:b]]
        row = np.repeat(np.arange(b - a), sizes)
        begins = np.cumsum(sizes) - sizes
        return row, begins, np.arange(len(row)) + (self.begins[self.sentence[a:b]] - begins)[row]

    def cells(self) -> Iterator[_Cells]:
        for a, b, frequent in self.runs:
            row, begins, at = self._spread(a, b)
            trg, kind = np.unique(self.trg[a:b], return_inverse=True)
            keys, which = np.unique(kind[row] * len(self.words) + self.at[at], return_inverse=True)
            yield _Cells(trg[keys // len(self.words)], keys % len(self.words), which, self.n_src[at], row, begins,
                         self.n_all[self.sentence[a:b]], self.n_trg[a:b], frequent)

    def keys(self) -> np.ndarray:
        """What the block asks for: its source words, and the word pairs of frequent target words."""
        sent = [self.words.astype(np.int64) << 32 | TOTAL]
        for a, b, frequent in self.runs:
            if frequent:
                sent.append(self.words[np.unique(self.at[self._spread(a, b)[2]])].astype(np.int64) << 32 | int(self.trg[a]))
        return np.concatenate(sent)


def _grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that follow each other with one value of `by`."""
    value, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r[by] != value and rows:
                yield value, rows
                rows = []
            value = r[by]
            rows.append(r)
    if rows:
        yield value, rows


def _shares(rows: list[dict], step: int, buckets: int, frequent: np.ndarray, cells: int):
    """A block, its keys in the order of their buckets, the sums it was given by step, and its cells with their shares at `step`."""
    block = _Block([r for r in rows if r["step"] == 0], frequent, cells)
    keys = block.keys()
    bucket = _hash_of(keys >> 32, buckets)
    order = np.argsort(bucket, kind="stable")
    given, kept, since = {}, [], 0
    for r in rows:
        if r["part"] < 0:
            kept.append(r["sums"])
            since = r["step"]
        elif r["step"]:
            given.setdefault(r["step"], []).append(np.frombuffer(r["sums"]))
    for k, parts in given.items():
        sums = np.empty(len(keys))
        sums[order] = np.concatenate(parts)
        given[k] = sums
    n = len(block.words)

    def each() -> Iterator[tuple[_Cells, np.ndarray]]:
        left, at = iter(kept), n
        for c in block.cells():
            if c.frequent:  # other blocks have slices of this word, so what all of them gave is taken
                shares = c.first() if step == 1 else c.next(given[step - 1][at : at + len(c.trg)], given[step - 1][:n])
                at += len(c.trg)
            else:
                shares = np.frombuffer(next(left)) if since else c.first()
                for k in range(max(since, 1), step):
                    shares = c.next(shares, given[k][:n])
            yield c, shares

    return block, keys, bucket, order, given, each()


def _expect(batches: Iterator[pa.RecordBatch], step: int, keep: bool, *how) -> Iterator[pa.RecordBatch]:
    """What each block adds to its keys in a step, dealt to the buckets of the source words."""
    for number, rows in _grouped(batches, "block"):
        block, keys, bucket, order, _, each = _shares(rows, step, *how)
        made, at, out = np.zeros(len(keys)), len(block.words), []
        for i, (c, shares) in enumerate(each):
            made[: len(block.words)] += np.bincount(c.word, shares, len(block.words))
            if c.frequent:
                made[at : at + len(shares)] = shares
                at += len(shares)
            elif keep:
                out.append((-1, number, i - (1 << 30), None, shares.tobytes()))
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            out.append((int(bucket[part[0]]), number, 0, keys[part].tobytes(), made[part].tobytes()))
        yield _rows(out, MESSAGES)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]]:
    """Per bucket: its messages, its distinct keys with their sums, and the key of each entry."""
    for _, rows in _grouped(batches, "bucket"):
        keys, which = np.unique(np.concatenate([np.frombuffer(r["codes"], np.int64) for r in rows]), return_inverse=True)
        yield rows, keys, np.bincount(which, np.concatenate([np.frombuffer(r["sums"]) for r in rows]), len(keys)), which


def _answer(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """What every block asked for, in its own order."""
    for rows, _, sums, which in _added(batches):
        ends = np.cumsum([len(r["codes"]) // 8 for r in rows])
        parts = np.split(sums[which], ends[:-1])
        yield _rows([(r["block"], step, r["bucket"], None, p.tobytes()) for r, p in zip(rows, parts)], BLOCKS)


def _table(src: np.ndarray, trg: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(p), 1 << 17):
        part = slice(a, a + (1 << 17))
        yield pa.RecordBatch.from_arrays([pa.array(src[part], pa.int32()), pa.array(trg[part], pa.int32()), pa.array(p[part])], schema=_arrow(TABLE))


def _listed(batches: Iterator[pa.RecordBatch], step: int, *how) -> Iterator[pa.RecordBatch]:
    """The table of the target words that one block has."""
    for _, rows in _grouped(batches, "block"):
        block, _, _, _, given, each = _shares(rows, step, *how)
        for c, shares in each:
            if not c.frequent:
                yield from _table(block.words[c.word], c.trg, shares / given[step][c.word])


def _listed_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table of the target words that are cut into slices."""
    for _, keys, sums, _ in _added(batches):
        src, trg = keys >> 32, keys & TOTAL
        whole = trg == TOTAL
        p = sums / sums[whole][np.searchsorted(src[whole], src)]
        yield from _table(src[~whole], trg[~whole], p[~whole])


def fit_lexical(pairs: DataFrame, iters: int) -> DataFrame:
    """`t(src, trg, p)`: probability of a target word for a source word, by expectation steps.

    In each step every target word of a pair shares its count among the pair's source words in
    proportion to the current table; the shares summed over all pairs and scaled per source word
    are the next table. Copies of a pair become one row with a weight.

    Target words are dealt to blocks of about BLOCK * CELLS word pairs, and a sentence's source words go to the
    blocks of its target words. So all shares of a target word are added up where they arise, and only the totals
    of source words are exchanged, one number per block and source word. Shares are not written either: a step
    takes them again from the totals of the steps before (beyond CUT_EVERY steps, from shares kept there). A word in
    very many sentences is cut into slices of about CELLS word pairs, and its word pairs are exchanged too.
    """
    spark = pairs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    alike = pairs.filter((F.size("src_ids") > 0) & (F.size("trg_ids") > 0)).groupBy("src_ids", "trg_ids").agg(F.count("*").alias("weight"))
    alike = stage(alike.select(F.col("src_ids").cast("array<int>"), F.col("trg_ids").cast("array<int>"), "weight"), "pairs")
    met = alike.select(F.explode(F.array_distinct("trg_ids")).alias("trg"), F.size(F.array_distinct("src_ids")).alias("n"))
    sized = stage(met.groupBy("trg").agg(F.sum("n").alias("cells")), "cells")
    cells = sized.agg(F.coalesce(F.sum("cells"), F.lit(0))).first()[0]
    # Fewer of them than there are times CELLS word pairs.
    often = sorted((r["trg"], -(-r["cells"] // CELLS)) for r in sized.filter(F.col("cells") > CELLS).collect())
    frequent, slices = (np.array([x[i] for x in often], np.int64) for i in (0, 1))
    n_blocks = max(spark.sparkContext.defaultParallelism, -(-cells // (BLOCK * CELLS)))
    how = (tasks, frequent, CELLS)
    spot = F.pmod(F.xxhash64("src_ids", "trg_ids"), F.lit(1 << 31)).alias("spot")
    # The same rows in one order for the same task, whatever the run.
    dealt = alike.select("*", spot).repartition(tasks, "spot").sortWithinPartitions("spot", "src_ids", "trg_ids")
    blocks = stage(dealt.mapInArrow(lambda b: _deal(b, n_blocks, frequent, slices), BLOCKS), "blocks")

    def by_block(rows: DataFrame) -> DataFrame:
        # Sorted, so that sums are always added in one order. More tasks than blocks, so that few tasks get several.
        return rows.repartition(max(tasks, 2 * n_blocks), "block").sortWithinPartitions("block", "step", "part", "rows")

    def by_bucket(rows: DataFrame) -> DataFrame:
        return rows.filter("bucket >= 0").repartition(tasks, "bucket").sortWithinPartitions("bucket", "block")

    known, last = blocks, max(1, iters)
    for step in range(1, last + 1):
        keep = step % CUT_EVERY == 0 and step < last
        made = by_block(known).mapInArrow(lambda b, step=step, keep=keep: _expect(b, step, keep, *how), MESSAGES)
        messages = stage(made, "messages")
        answers = stage(by_bucket(messages).mapInArrow(lambda b, step=step: _answer(b, step), BLOCKS), "answers")
        if keep:
            none = F.lit(None).cast("binary").alias("rows")
            known = blocks.unionByName(messages.filter("bucket < 0").select("block", F.lit(step).alias("step"), "part", none, "sums"))
        known = known.unionByName(answers)
    alone = by_block(known).mapInArrow(lambda b: _listed(b, last, *how), TABLE)
    return alone.unionByName(by_bucket(messages).mapInArrow(_listed_frequent, TABLE)) if often else alone


def best_targets(table: DataFrame) -> DataFrame:
    """`(src, trg)`: the likeliest target per source word, smaller id first on ties.

    Special tokens are no translation of anything.
    """
    order = F.struct(F.round("p", 9), -F.col("trg"))
    return table.filter(F.col("trg") >= len(SPECIALS)).groupBy("src").agg(F.max_by("trg", order).alias("trg"))


def translate_greedy(pairs: DataFrame, table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Adds `pred_ids`: the likeliest target word for each source word, [UNK] where none is known."""
    words = pairs.select("pair_id", F.posexplode("src_ids").alias("pos", "src"))
    met = lookup_join(words, stage(best_targets(table), "best"), ["src"], "left", ["pair_id", "pos"], max_rows)
    placed = F.struct("pos", F.coalesce("trg", F.lit(UNK_ID)).alias("trg"))
    made = met.groupBy("pair_id").agg(F.array_sort(F.collect_list(placed)).alias("_placed"))
    return pairs.join(made, "pair_id", "left").select(
        *pairs.columns,
        F.coalesce(F.col("_placed.trg"), F.array().cast("array<int>")).alias("pred_ids"),
    )
