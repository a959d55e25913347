"""Byte-pair merges: learned from distinct pieces, applied to whole texts."""

from __future__ import annotations

import copy
import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import list_lengths, list_offsets, piece_tokens
from tokenloom.session import stage

MERGES = "rank int, left string, right string, merged string"
MAX_MERGES = 1_000_000
SAMPLE = 100_000  # pieces that guess the next merges; bears on the number of passes only
PLAN = 128  # merges guessed for one pass
LEADERS = 4096  # pairs that come to the driver in one pass
PIECES_PER_TASK = 100_000
CUT_EVERY = 64  # merges between staged tables
PIECES, PIECES_COLUMNS = "symbols array<int>, freq bigint", ["symbols", "freq"]

Merge = tuple[int, int, int]  # symbol ids: left, right, the merged one

# Fixed order of the 256 single bytes in the published table: printable ones first.
PRINTABLE = [range(33, 127), range(161, 173), range(174, 256)]
BYTE_ORDER = [b for r in PRINTABLE for b in r]
BYTE_ORDER += [b for b in range(256) if b not in BYTE_ORDER]


def piece_counts(corpus: DataFrame, text: str = "text") -> DataFrame:
    """`(piece, freq)` over all texts."""
    pieces = corpus.select(F.explode(piece_tokens(F.col(text))).alias("piece"))
    return pieces.groupBy("piece").agg(F.count("*").alias("freq"))


class PairIndex:
    """Pieces as symbol ids, the weight of every adjacent pair, and the pieces that hold it.

    A merge looks up the holders of its pair and touches no other piece. Pairs are keys left * 2^32 + right.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, freq: np.ndarray):
        flat = flat.astype(np.int64)
        self.flat, self.freq = flat, freq
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.changed: dict[int, list[int]] = {}
        piece = np.repeat(np.arange(len(sizes)), sizes)
        inside = piece[1:] == piece[:-1]
        pairs, holder = (flat[:-1] << 32 | flat[1:])[inside], piece[:-1][inside]
        order = np.argsort(pairs, kind="stable")
        pairs, holder = pairs[order], holder[order]
        first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.empty(0, np.int64)
        kinds = pairs[first].tolist()
        weights = np.add.reduceat(freq[holder], first).tolist() if len(first) else []
        self.weights = dict(zip(kinds, weights))
        self.held = dict(zip(kinds, np.split(holder, first[1:]))) if kinds else {}
        self.since: dict[int, list[int]] = {}

    def copy(self) -> PairIndex:
        other = copy.copy(self)
        other.changed, other.weights, other.held = dict(self.changed), dict(self.weights), dict(self.held)
        other.since = {k: list(v) for k, v in self.since.items()}
        return other

    def symbols(self, i: int) -> list[int]:
        return self.changed.get(i) or self.flat[self.starts[i] : self.ends[i]].tolist()

    def merge(self, left: int, right: int, into: int) -> dict[int, int]:
        """Merges a pair from left to right in all its pieces; by how much each pair's weight changes."""
        pair = left << 32 | right
        delta: dict[int, int] = {}
        for i in {*self.held.pop(pair, np.empty(0, np.int64)).tolist(), *self.since.pop(pair, ())}:
            old = self.symbols(i)
            new = _joined(old, left, right, into)
            if len(new) == len(old):
                continue
            n = int(self.freq[i])
            for x, y in zip(old, old[1:]):
                delta[x << 32 | y] = delta.get(x << 32 | y, 0) - n
            for x, y in zip(new, new[1:]):
                delta[x << 32 | y] = delta.get(x << 32 | y, 0) + n
                if x == into or y == into:
                    self.since.setdefault(x << 32 | y, []).append(i)
            self.changed[i] = new
        delta = {k: n for k, n in delta.items() if n}
        for k, n in delta.items():
            self.weights[k] = self.weights.get(k, 0) + n
        return delta


def _joined(parts: list, left, right, into) -> list:
    out, i, n = [], 0, len(parts)
    while i < n:
        if parts[i] == left and i + 1 < n and parts[i + 1] == right:
            out.append(into)
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


class _Symbols:
    """Byte strings of symbol ids. Equal byte strings are one symbol, however they were merged."""

    def __init__(self):
        self.bytes = [bytes([b]) for b in range(256)]
        self.ids = {b: i for i, b in enumerate(self.bytes)}

    def merged(self, left: int, right: int) -> int:
        text = self.bytes[left] + self.bytes[right]
        if text not in self.ids:
            self.ids[text] = len(self.bytes)
            self.bytes.append(text)
        return self.ids[text]

    def copy(self) -> _Symbols:
        other = _Symbols()
        other.bytes, other.ids = list(self.bytes), dict(self.ids)
        return other

    def order(self, pair: int) -> tuple[bytes, bytes]:
        return self.bytes[pair >> 32], self.bytes[pair & 0xFFFFFFFF]


class Pieces:
    """Many pieces as symbol ids side by side, in which all pairs of one kind are merged at a time."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat = flat.astype(np.int32)
        self.piece = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that begin at places `at`, and the piece of each; none across the end of a piece."""
        at = at[(at >= 0) & (at < len(self.flat) - 1)]
        at = at[self.piece[at] == self.piece[at + 1]]
        return self.flat[at].astype(np.int64) << 32 | self.flat[at + 1], self.piece[at]

    def find(self, left: int, right: int) -> np.ndarray:
        """Where the pair begins, from left to right without overlap."""
        at = np.flatnonzero(self.flat[:-1] == left)
        at = at[(self.flat[at + 1] == right) & (self.piece[at] == self.piece[at + 1])]
        if left == right and len(at):
            begins = np.r_[True, np.diff(at) != 1]
            at = at[(at - at[begins][np.cumsum(begins) - 1]) % 2 == 0]
        return at

    def join(self, at: np.ndarray, into: int) -> np.ndarray:
        """Merges the pairs at `at`; where they are afterwards."""
        if len(at):
            self.flat[at] = into
            kept = np.ones(len(self.flat), bool)
            kept[at + 1] = False
            self.flat, self.piece = self.flat[kept], self.piece[kept]
        return at - np.arange(len(at))

    def change(self, merge: Merge, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges a pair in all pieces; the pairs whose weight changes, and by how much."""
        left, right, into = merge
        at = self.find(left, right)
        lost, losers = self.pairs(np.unique(np.concatenate([at - 1, at, at + 1])))
        at = self.join(at, into)
        won, winners = self.pairs(np.unique(np.concatenate([at - 1, at])))
        return _summed(np.concatenate([lost, won]), np.concatenate([-freq[losers], freq[winners]]))


def _summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(pairs):
        return pairs, n
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(np.r_[True, np.diff(pairs) != 0])
    sums = np.add.reduceat(n, first)
    return pairs[first][sums != 0], sums[sums != 0]


def _read_columns(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """Symbols, sizes and frequencies of pieces."""
    parts = [(pc.list_flatten(b.column("symbols")).to_numpy(zero_copy_only=False), list_lengths(b.column("symbols")),
              b.column("freq").to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*parts))


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> PairIndex:
    return PairIndex(*_read_columns(list(batches)))


def _merged(batches: Iterator[pa.RecordBatch], done: list[Merge]) -> Iterator[tuple[Pieces, np.ndarray]]:
    """Pieces and their frequencies after the merges `done`, at most about PIECES_PER_TASK at a time."""
    held: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if held and (batch is None or sum(b.num_rows for b in held) + batch.num_rows > PIECES_PER_TASK):
            flat, sizes, freq = _read_columns(held)
            pieces, held = Pieces(flat, sizes), []
            for left, right, into in done:
                pieces.join(pieces.find(left, right), into)
            yield pieces, freq
        if batch is not None:
            held.append(batch)


def _changes(pieces: DataFrame, done: list[Merge], plan: list[Merge]) -> DataFrame:
    """`(pair, step, n)`: weights after the merges `done` (step -1), and their change by each merge of `plan`."""

    def run(batches):
        for part, freq in _merged(batches, done):
            pairs, holders = part.pairs(np.arange(len(part.flat)))
            found = [_summed(pairs, freq[holders]), *(part.change(merge, freq) for merge in plan)]
            steps = np.repeat(np.arange(-1, len(plan), dtype=np.int32), [len(p) for p, _ in found])
            pairs, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pairs, steps, n)], ["pair", "step", "n"])

    found = pieces.mapInArrow(run, "pair bigint, step int, n bigint")
    return found.groupBy("pair", "step").agg(F.sum("n").alias("n"))


def _merged_pieces(pieces: DataFrame, done: list[Merge]) -> DataFrame:
    def run(batches):
        for part, freq in _merged(batches, done):
            sizes = np.bincount(part.piece, minlength=len(freq))
            symbols = pa.ListArray.from_arrays(list_offsets(sizes), pa.array(part.flat))
            yield pa.RecordBatch.from_arrays([symbols, pa.array(freq)], PIECES_COLUMNS)

    return stage(pieces.mapInArrow(run, PIECES), "pieces")


def _sample(pieces: DataFrame, rows: int) -> PairIndex:
    """About `rows` pieces: half of them the most frequent, half a share of the others with a weight for all."""
    frequent = pieces.orderBy(F.desc("freq")).select("freq").limit(rows // 2).agg(F.min("freq")).first()[0] or 0
    rest = pieces.filter(F.col("freq") <= frequent).count()
    share = max(1, -(-2 * rest // rows))
    chosen = (F.col("freq") > frequent) | (F.pmod(F.xxhash64("symbols"), F.lit(share)) == 0)
    weight = F.when(F.col("freq") > frequent, 1).otherwise(share)
    table = pieces.filter(chosen).select("symbols", (F.col("freq") * weight).alias("freq")).toArrow()
    return _read_pieces(table.to_batches())


def _plan(sample: PairIndex, symbols: _Symbols, known: dict[int, int], length: int) -> list[Merge]:
    """The merges that the sample, scaled to the true weights `known` so far, would take next."""
    sample, symbols = sample.copy(), symbols.copy()
    scale = {pair: n / sample.weights[pair] for pair, n in known.items() if sample.weights.get(pair, 0) > 0 and n > 0}
    plan: list[Merge] = []

    def entry(pair: int) -> tuple:
        n = sample.weights[pair]
        return -n * scale.get(pair, 1.0), symbols.order(pair), pair, n

    leaders = [entry(pair) for pair, n in sample.weights.items() if n > 0]
    heapq.heapify(leaders)
    while leaders and len(plan) < length:
        _, _, best, n = heapq.heappop(leaders)
        if sample.weights[best] != n:  # an entry from before a change
            continue
        left, right = best >> 32, best & 0xFFFFFFFF
        plan.append((left, right, symbols.merged(left, right)))
        for pair in sample.merge(*plan[-1]):
            if sample.weights[pair] > 0:
                heapq.heappush(leaders, entry(pair))
    return plan


def _certain(changes: DataFrame, plan: list[Merge], symbols: _Symbols, limit: int) -> tuple[list[Merge], dict[int, int]]:
    """The merges that are next for certain, and the weights of the leading pairs after them.

    As long as the most frequent pair of all is the planned one, the changes of the plan hold. The first
    time it is another one, that one is known for certain too, but nothing after it. Only pairs that could
    lead come to the driver: those with the largest weights they could ever have in this pass.
    """
    step, n = F.col("step"), F.col("n")
    pairs = stage(changes.groupBy("pair").agg(
        F.sum(F.when((step < 0) | (n > 0), n).otherwise(0)).alias("most"),
        F.collect_list(F.struct("step", "n")).alias("changes")), "pairs")
    while True:
        rows = pairs.orderBy(F.desc("most"), "pair").limit(limit).collect()
        bound = rows[-1]["most"] if len(rows) == limit else 0
        weights = {r["pair"]: 0 for r in rows}
        by_step: dict[int, list] = {}
        for r in rows:
            for c in r["changes"]:
                by_step.setdefault(c["step"], []).append((r["pair"], c["n"]))
        taken: list[Merge] = []
        names = symbols.copy()
        for k in range(-1, len(plan)):
            for pair, n in by_step.get(k, ()):
                weights[pair] += n
            heaviest = max(weights.values(), default=0)
            if heaviest <= bound or k == len(plan) - 1:
                break
            best = min((p for p, n in weights.items() if n == heaviest), key=names.order)
            merge = (best >> 32, best & 0xFFFFFFFF, names.merged(best >> 32, best & 0xFFFFFFFF))
            taken.append(merge)
            if merge != plan[k + 1]:
                break
        if taken or not bound:
            return taken, weights
        limit *= 4  # only where very many pairs tie


def train_bpe(corpus: DataFrame, n_merges: int, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """`merges(rank, left, right, merged)` in hex, by repeatedly merging the most frequent pair, first bytes on ties.

    The corpus is read once, to count distinct pieces. A bounded sample of them guesses the next merges;
    a pass over all pieces applies that plan, each task to many pieces at a time, and sums how
    every pair's weight changes with every merge. From these sums the merges that are right are taken, up to
    and with the first wrong guess. So a pass gives many merges, and the result does not depend on the sample.
    """
    spark = corpus.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bytes_of = F.transform(F.split(F.regexp_replace(F.hex(F.encode("piece", "UTF-8")), "(..)(?!$)", "$1 "), " "),
                           lambda h: F.conv(h, 16, 10).cast("int"))
    counted = stage(piece_counts(corpus, text).select(bytes_of.alias("symbols"), "freq"), "pieces")
    rows = counted.count()
    pieces = stage(counted.repartition(max(tasks, -(-rows // PIECES_PER_TASK)), "symbols"), "pieces")
    guess = _sample(pieces, sample)
    symbols, merges, done, known = _Symbols(), [], [], {}
    length = PLAN
    while len(merges) < n_merges:
        plan = _plan(guess, symbols, known, min(length, n_merges - len(merges)))
        # The last merge of a plan is not followed up, so one more step shows what comes after it.
        taken, known = _certain(_changes(pieces, done, plan), [*plan, None], symbols, LEADERS)
        if not taken:
            break
        length = min(PLAN, 16 + 2 * len(taken))  # no longer than guesses have lately been right
        for left, right, into in taken[: n_merges - len(merges)]:
            symbols.merged(left, right)
            guess.merge(left, right, into)
            merges.append((len(merges), *(symbols.bytes[x].hex().upper() for x in (left, right, into))))
            done.append((left, right, into))
        if len(done) >= CUT_EVERY:
            pieces, done = _merged_pieces(pieces, done), []
    return spark.createDataFrame(merges, MERGES)


def _merge_rules(merges: DataFrame) -> list[tuple[bytes, bytes]]:
    rows = merges.orderBy("rank").limit(MAX_MERGES + 1).collect()
    if len(rows) > MAX_MERGES:
        raise ValueError(f"more than {MAX_MERGES} merges")
    return [(bytes.fromhex(r["left"]), bytes.fromhex(r["right"])) for r in rows]


def _symbols(rules: list[tuple[bytes, bytes]]) -> list[bytes]:
    """Symbols in id order: single bytes, then one per merge."""
    return [bytes([b]) for b in BYTE_ORDER] + [a + b for a, b in rules]


def _piece_encoder(rules: list[tuple[bytes, bytes]]):
    ranks = {pair: rank for rank, pair in enumerate(rules)}
    ids = {}
    for i, symbol in enumerate(_symbols(rules)):
        ids.setdefault(symbol, i)

    def encode(piece: bytes) -> list[int]:
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: ranks.get(p, math.inf))
            if best not in ranks:
                break
            parts = _joined(parts, *best, best[0] + best[1])
        return [ids[p] for p in parts]

    return encode


def _pieces_encoder(rules: list[tuple[bytes, bytes]]):
    """Codes many pieces at a time: one merge after the other, each in all of them.

    That is the order of the ranks, but for a merge whose bytes an earlier merge goes on from: where such a
    one takes place, an earlier merge could come next, and the piece is coded by itself.
    """
    one = _piece_encoder(rules)
    ranks = {pair: rank for rank, pair in enumerate(rules)}
    ids, used, steps = {}, set(), []
    for i, symbol in enumerate(_symbols(rules)):
        ids.setdefault(symbol, i)
    for left, right in sorted(ranks, key=ranks.get):
        steps.append((ids[left], ids[right], ids[left + right], left + right in used))
        used |= {left, right}
    of_byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        flat = of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        coded, apart = Pieces(flat, sizes), np.zeros(len(pieces), bool)
        for left, right, into, goes_back in steps:
            at = coded.find(left, right)
            if goes_back:
                apart[coded.piece[at]] = True
            coded.join(at, into)
        sizes = np.bincount(coded.piece, minlength=len(pieces))
        if not apart.any():
            return coded.flat, sizes
        parts = np.split(coded.flat, np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(apart).tolist():
            parts[i] = np.array(one(pieces[i]), np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    return encode


def encode_bpe(df: DataFrame, merges: DataFrame, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds byte-pair ids. No row moves; a task encodes each distinct piece of a batch once."""
    return df.withColumn(into, bpe_function(merges)(piece_tokens(F.col(text))))


def bpe_function(merges: DataFrame):
    """Arrow function: array of pieces -> array of ids."""
    rules = _merge_rules(merges)
    made = []

    @F.arrow_udf("array<int>")
    def encode(col: pa.Array) -> pa.Array:
        if not made:
            made.append(_pieces_encoder(rules))
        coded = pc.dictionary_encode(pc.list_flatten(col))
        pieces = pc.cast(coded.dictionary, pa.binary()).to_pylist()
        parts = [made[0](pieces[a : a + PIECES_PER_TASK]) for a in range(0, len(pieces), PIECES_PER_TASK)]
        flat, sizes = (np.concatenate([np.empty(0, kind), *x]) for kind, x in zip((np.int32, np.int64), zip(*parts))) if parts else (
            np.empty(0, np.int32), np.empty(0, np.int64))
        where = coded.indices.to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(list_offsets(sizes), pa.array(flat, pa.int32())).take(coded.indices)
        row = np.repeat(np.arange(len(col)), list_lengths(col))
        per_row = np.bincount(row, weights=sizes[where], minlength=len(col)).astype(np.int64)
        return pa.ListArray.from_arrays(list_offsets(per_row), lists.flatten())

    return encode.asNondeterministic()


def decode_bpe(df: DataFrame, merges: DataFrame, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of byte-pair ids; bytes that are no valid text become replacement marks."""
    symbols = pa.array(_symbols(_merge_rules(merges)), pa.binary())

    @F.arrow_udf("string")
    def decode(col: pa.Array) -> pa.Array:
        parts = symbols.take(pc.list_flatten(col))
        joined = pc.binary_join(pa.ListArray.from_arrays(list_offsets(list_lengths(col)), parts), b"")
        return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())

    return df.withColumn(into, decode.asNondeterministic()(F.col(ids)))
