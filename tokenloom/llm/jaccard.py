"""N-gram Jaccard join: the grouped prefix join over sets of word shingles.

1. `signatures`: every text becomes the set of its distinct shingles (64-bit hashes) and a 64-bit
   signature of the set. Rows with one signature have one set; from here on a set is a node.
2. `shared_tokens`: shingles are dealt by hash range in packed blocks and counted. A shingle of one
   set only can't be part of any overlap, so only its number is kept (it sorts first in the order
   "rarest first"); the others go back to their sets. Inside one map partition a set is sent once,
   however many copies it has there.
3. Sets with identical prefix and identical size form one group. Groups meet in the postings of
   their prefix shingles, pass the size and position filters as groups, and are then expanded.
4. Verification intersects the two sets. Links make components.

A group of near copies has a posting list as long as the group, so pairs are not taken from it at
once. First every list ties its members to its most central ones (those with the fewest shingles of
their own). Then, with the components known so far, every list ties one member of each component to
its most central one. Last come all pairs of groups in different components, each kept once whatever
number of shingles it shares, and verified by sketch before the tokens are fetched. That is the whole join
less the pairs that could not change a component.

The links inside components are counted beside it (`link_counts`). The sets of a component are dealt to
blocks of BLOCK; two blocks that have members in one posting list make a cell, to which just those
members are sent, and all pairs of a cell are verified in its task. Every pair has one cell, and sets
with a link share a prefix shingle, so no link is lost and none is counted twice.

Similarity is exact: 100 * intersection >= percent * union on whole sets. Hash collisions would
have to fall inside one pair of sets (after step 1 shingles are told apart by their range and 40 bits:
chance about 1e-9 per pair).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tokenloom.llm import kernels
from tokenloom.llm.graphs import components
from tokenloom.llm.shared import partitions, record_batch, stage, stage_small
from tokenloom.session import lookup_join

WORDS, PERCENT = 5, 80
TASK_TOKENS = 1_500_000
LIST_SPLIT, HUBS = 4096, 2
BLOCK, COLUMNS = 256, 16_384
TOKEN_BITS = 40
SKETCH_BITS = 512
SETS = "doc_id long, n_shingles long, node long, carried long"
TOKENS = "bucket int, nodes binary, sizes binary, counts binary, tokens binary, class binary"
COUNTS = "node long, links long"
NODES = "node long, n int, tokens array<long>, prefix array<long>, class array<int>, first int, sketch array<long>"


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = kernels.column_bytes(batch.column("text"))
        for a, b in kernels.pieces(offsets):
            part = data[offsets[a] : offsets[b]]
            _, _, hashes, bounds = kernels.words(part, offsets[a : b + 1] - offsets[a], fold=True)
            yield batch.slice(a, b - a), kernels.shingles(hashes, bounds, n)


def _signature(found: np.ndarray) -> int:
    """64 bits of a sorted set; the empty set has 0."""
    if not len(found):
        return 0
    place = np.arange(1, len(found) + 1, dtype=np.uint64) * kernels.BASE
    return int(kernels.mix(kernels.mix(found ^ place).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def signatures(docs: DataFrame, n: int = WORDS, carry: Column | None = None) -> DataFrame:
    """(doc_id, n_shingles, node, carried) of every row; node 0 is the empty set, `carried` a long of the row."""

    def run(batches):
        for rows, sets in _sets(batches, n):
            yield record_batch(SETS, rows.column("doc_id"), [len(s) for s in sets], [_signature(s) for s in sets],
                               rows.column("carried"))

    carried = F.lit(None) if carry is None else carry
    return docs.select(F.col("doc_id").cast("long"), "text", carried.cast("long").alias("carried")).mapInArrow(run, SETS)


def _labels(spark, tasks: int) -> list[int]:
    """For each of `tasks` ranges a number that Spark's hash partitioning sends to a task of its own."""
    rows = (spark.range(64 * tasks).select(F.col("id").cast("int").alias("i"))
            .groupBy(F.pmod(F.hash("i"), F.lit(tasks)).alias("p")).agg(F.min("i").alias("i")).collect())
    given = {r["p"]: r["i"] for r in rows}
    return [given.get(p, 64 * tasks + p) for p in range(tasks)]


def _range_of(token: np.ndarray, tasks: int) -> np.ndarray:
    return ((token >> np.uint64(40)) * np.uint64(tasks) >> np.uint64(24)).astype(np.int64)


def _low_bytes(token: np.ndarray) -> bytes:
    return token.view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8].tobytes()


def _emit(labels: list[int], bucket: np.ndarray, node: np.ndarray, token: np.ndarray, kind: np.ndarray | None) -> pa.RecordBatch:
    """One packed row per bucket; the elements must be sorted by node."""
    order = np.argsort(bucket.astype(np.uint16 if len(labels) <= 1 << 16 else np.int64), kind="stable")
    bucket, node, token = bucket[order], node[order], np.ascontiguousarray(token[order])
    kind = kind[order] if kind is not None else None
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    rows = [[], [], [], [], [], []]
    for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(bucket)].tolist()):
        runs = np.flatnonzero(np.r_[True, node[a + 1 : b] != node[a : b - 1]])
        rows[0].append(labels[int(bucket[a])])
        rows[1].append(node[a:b][runs].tobytes())
        rows[2].append(b"")
        counts = np.diff(np.r_[runs, b - a])
        rows[3].append(counts.astype(_width(int(counts.max()))).tobytes())
        # The answers keep the whole token id; what is dealt by range keeps its low bytes.
        rows[4].append(_low_bytes(token[a:b]) if kind is None else token[a:b].tobytes())
        rows[5].append(kind[a:b].tobytes() if kind is not None else b"")
    return record_batch(TOKENS, *rows)


def _width(most: int):
    return np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int64


def _emit_sizes(labels: list[int], bucket: np.ndarray, node: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """The sizes of sets, sent once per set and not with every run of its shingles."""
    order = np.argsort(bucket, kind="stable")
    bucket, node, size = bucket[order], node[order], size[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    spans = list(zip(cuts.tolist(), np.r_[cuts[1:], len(bucket)].tolist()))
    empty = [b""] * len(spans)
    return record_batch(TOKENS, [labels[int(bucket[a])] for a, _ in spans], [node[a:b].tobytes() for a, b in spans],
                        [size[a:b].astype(np.int32).tobytes() for a, b in spans], empty, empty, empty)


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """node, token, class of all packed rows of a task, and node, size of its sets; token ids are label and low bytes."""
    parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint8)],
                                     [np.empty(0, np.int64)], [np.empty(0, np.int32)]]
    for batch in batches:
        for r in batch.to_pylist():
            nodes = np.frombuffer(r["nodes"], np.int64)
            if r["sizes"]:
                parts[3].append(nodes)
                parts[4].append(np.frombuffer(r["sizes"], np.int32))
                continue
            width = {1: np.uint8, 2: np.uint16, 8: np.int64}[len(r["counts"]) // len(nodes)]
            parts[0].append(np.repeat(nodes, np.frombuffer(r["counts"], width).astype(np.int64)))
            if r["class"]:
                token = np.frombuffer(r["tokens"], np.uint64)
            else:
                raw = np.frombuffer(r["tokens"], np.uint8).reshape(-1, TOKEN_BITS // 8)
                wide = np.zeros((len(raw), 8), np.uint8)
                wide[:, : TOKEN_BITS // 8] = raw
                token = wide.view(np.uint64).ravel() | np.uint64(r["bucket"] << TOKEN_BITS)
            parts[1].append(token)
            parts[2].append(np.frombuffer(r["class"], np.uint8))
    return tuple(np.concatenate(p) for p in parts)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits of a set: two sets differ in at least as many tokens as their sketches differ in bits."""
    bits = np.zeros(SKETCH_BITS, np.uint8)
    bits[(kernels.mix(tokens) % np.uint64(SKETCH_BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def shared_tokens(docs: DataFrame, tasks: int, n: int = WORDS) -> DataFrame:
    """One row (NODES) for each set that may have a partner.

    `tokens` are its shingles that other sets have too, `prefix` those among the first in the order
    (class, hash), where class grows with the number of sets; `first` is the place of prefix[0].
    """
    labels = _labels(docs.sparkSession, tasks)

    def deal(batches):
        seen: set[int] = set()
        held, room = [], 0
        for _, sets in _sets(batches, n):
            for found in sets:
                if len(found):
                    node = _signature(found)
                    if node not in seen:
                        seen.add(node)
                        held.append((node, found))
                        room += len(found)
            if room > TASK_TOKENS:
                yield from flush(held)
                held, room = [], 0
        if held:
            yield from flush(held)

    def flush(held):
        sizes = np.array([len(s) for _, s in held])
        token = np.concatenate([s for _, s in held])
        nodes = np.array([k for k, _ in held], np.int64)
        yield _emit(labels, _range_of(token, tasks), np.repeat(nodes, sizes), token, None)
        yield _emit_sizes(labels, _range_of(nodes.view(np.uint64), tasks), nodes, sizes)

    def count(batches):
        node, token, _, sets, sizes = _read(batches)
        order = np.argsort(token, kind="stable")
        same = token[order]
        twice = np.zeros(len(same), bool)
        twice[1:] = same[1:] == same[:-1]
        twice[:-1] |= twice[1:]
        order = order[twice]
        node, token = node[order], token[order]
        order = np.lexsort((node, token))
        node, token = node[order], token[order]
        # One set may have come from several map partitions.
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        node, token = node[fresh], token[fresh]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.empty(0, np.int64)
        spans = np.diff(np.r_[starts, len(token)])
        often = np.repeat(spans, spans)
        kept = often > 1
        kind = np.ceil(4 * np.log2(np.maximum(often, 1))).astype(np.uint8)[kept]
        node, token = node[kept], token[kept]
        order = np.argsort(node, kind="stable")
        node = node[order]
        yield _emit(labels, _range_of(node.view(np.uint64), tasks), node, token[order], kind[order])
        # Sizes were dealt by their sets' range already; they only pass through.
        sets, first = np.unique(sets, return_index=True)
        yield _emit_sizes(labels, _range_of(sets.view(np.uint64), tasks), sets, sizes[first])

    def gather(batches):
        node, token, kind, sets, sizes = _read(batches)
        sets, which = np.unique(sets, return_index=True)
        order = np.lexsort((token, kind, node))
        node, token, kind = node[order], token[order], kind[order]
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.empty(0, np.int64)
        size = sizes[which[np.searchsorted(sets, node[starts])]]
        rows = [[], [], [], [], [], [], []]
        for a, b, whole in zip(starts.tolist(), np.r_[starts[1:], len(node)].tolist(), size.tolist()):
            need = -(-PERCENT * whole // 100)
            first = whole - (b - a)  # shingles of this set alone come first in the order
            prefix = whole - need + 1
            if b - a < need or prefix <= first:
                continue
            rows[0].append(int(node[a]))
            rows[1].append(whole)
            rows[2].append(np.sort(token[a:b]).view(np.int64))
            rows[3].append(token[a : a + prefix - first].view(np.int64))
            rows[4].append(kind[a : a + prefix - first].astype(np.int32))
            rows[5].append(first)
            rows[6].append(_sketch(token[a:b]))
            if len(rows[0]) == 2000:
                yield record_batch(NODES, *rows)
                rows = [[], [], [], [], [], [], []]
        if rows[0]:
            yield record_batch(NODES, *rows)

    return (docs.select("doc_id", "text").mapInArrow(deal, TOKENS).repartition(tasks, "bucket")
            .mapInArrow(count, TOKENS).repartition(tasks, "bucket").mapInArrow(gather, NODES))


def verify(pairs: DataFrame, nodes: DataFrame, sift: bool = False) -> DataFrame:
    """Those of `pairs` (a, b) whose sets are similar enough.

    With `sift`, for pairs of which few are: the sketches of two sets bound their overlap from above, and
    only pairs within the bound fetch all tokens.
    """
    def side(k: str, *columns: str) -> DataFrame:
        return nodes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), *[F.col(c).alias(f"{c}{k}") for c in columns])

    def alike(both):
        return 100 * both >= PERCENT * (F.col("na") + F.col("nb") - both)

    apart = F.aggregate(F.zip_with("sketcha", "sketchb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    most = (F.col("na") - F.col("firsta") + F.col("nb") - F.col("firstb") - apart) / 2
    pairs = pairs.distinct()
    if sift:
        pairs = (pairs.join(side("a", "first", "sketch"), "a").join(side("b", "first", "sketch"), "b")
                 .filter(alike(most)).select("a", "b"))
    both = F.size(F.array_intersect("tokensa", "tokensb"))
    return pairs.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").filter(alike(both)).select("a", "b")


def _fits(a: str, b: str):
    """Size and position filter on two postings: what is left of either set can still reach the overlap."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    # Shingles of one set alone are in the union and not in the overlap.
    most = F.least(F.col(f"{a}.n") - F.col(f"{a}.first"), F.col(f"{b}.n") - F.col(f"{b}.first"))
    union = F.greatest(F.col(f"{a}.n") + F.col(f"{b}.first"), F.col(f"{b}.n") + F.col(f"{a}.first"))
    return ((100 * most >= PERCENT * union) & ((100 + PERCENT) * left >= PERCENT * sizes))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _to_hubs(lists: DataFrame, keys: list[str], hubs: int) -> DataFrame:
    """Pairs of every `node` with the most central ones of its list (least `own`)."""
    order = W.partitionBy(*keys).orderBy("own", "node")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    central = F.array(*[F.nth_value("node", k).over(upto) for k in range(1, hubs + 1)])
    return (lists.withColumn("hubs", central).select(F.explode("hubs").alias("a"), F.col("node").alias("b")).dropna())


def _common(tokens: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the overlaps of the first `left` sets with all sets, a slice of the shingles at a time."""
    sizes = np.array([len(t) for t in tokens])
    _, column = np.unique(np.concatenate(tokens), return_inverse=True)
    row = np.repeat(np.arange(len(tokens)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((left, len(tokens)), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        has = np.zeros((len(tokens), int(column[hi - 1]) + 1 - a), np.float32)
        has[row[lo:hi], column[lo:hi] - a] = 1
        out += has[:left] @ has.T
    return out


def _cell_counts(cell: list[dict]) -> tuple[list[int], np.ndarray]:
    """Nodes of a cell and the copies that each is linked to there."""
    cell.sort(key=lambda r: r["own"] != r["i"])
    inner = cell[0]["i"] == cell[0]["j"]
    left = len(cell) if inner else sum(r["own"] == r["i"] for r in cell)
    n = np.array([r["n"] for r in cell], np.int64)
    copies = np.array([r["copies"] for r in cell], np.int64)
    both = _common([np.asarray(r["tokens"], np.int64) for r in cell], left).astype(np.int64)
    linked = 100 * both >= PERCENT * (n[:left, None] + n[None, :] - both)
    if inner:
        np.fill_diagonal(linked, False)
        return [r["node"] for r in cell], linked @ copies
    linked[:, :left] = False
    return [r["node"] for r in cell], np.r_[linked @ copies, (copies[:left] @ linked)[left:]]


def link_counts(nodes: DataFrame, found: DataFrame, copies: DataFrame) -> DataFrame:
    """(node, links): for every set with a link the rows of `copies` (node, copies) of all sets linked to it.

    `found` is what `node_links` gives for `nodes`.
    """
    tasks = partitions(nodes.sparkSession)
    large = found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = stage_small(found.join(large, "component").select(
        "node", "component", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("own")), "blocks")
    # A component of one block is one cell; of the others, posting lists tell which blocks meet.
    single = placed.filter("parts = 1").select("node", "component", "own", F.lit(0).alias("i"), F.lit(0).alias("j"))
    several = placed.filter("parts > 1").select("node", "component", "own")
    lists = stage(several.join(nodes.select("node", F.explode("prefix").alias("token")), "node"), "lists")
    held = lists.select("token", "component", "own").distinct()
    meet = held.join(held.withColumnRenamed("own", "other"), ["token", "component"])
    sent = (lists.join(meet, ["token", "component", "own"])
            .select("node", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
            .distinct())
    cells = (single.unionByName(sent).join(nodes.select("node", "n", "tokens"), "node").join(copies, "node")
             .repartition(tasks, "component", "i", "j").sortWithinPartitions("component", "i", "j"))

    def count(batches):
        key, cell, rows = None, [], [[], []]
        for batch in batches:
            for r in batch.to_pylist():
                at = (r["component"], r["i"], r["j"])
                if at != key and cell:
                    for held, x in zip(rows, _cell_counts(cell)):
                        held.extend(x)
                    cell = []
                    if len(rows[0]) > 10_000:
                        yield record_batch(COUNTS, *rows)
                        rows = [[], []]
                key = at
                cell.append(r)
        if cell:
            for held, x in zip(rows, _cell_counts(cell)):
                held.extend(x)
        yield record_batch(COUNTS, *rows)

    return cells.mapInArrow(count, COUNTS).groupBy("node").agg(F.sum("links").alias("links"))


def node_links(nodes: DataFrame) -> DataFrame:
    """(node, component) of every set that has a link."""
    group = F.xxhash64("n", "prefix")
    members = nodes.select("node", group.alias("g"), (F.col("first") / F.col("n")).alias("own"))
    groups = stage(nodes.select(group.alias("g"), "node", "n", "first", "prefix", "class")
                   .groupBy("g", "n", "first", "prefix", "class").agg(F.min("node").alias("node")), "groups")
    postings = (
        groups.select("g", "node", "n", "first", (F.col("first") / F.col("n")).alias("own"),
                      F.posexplode(F.arrays_zip(F.col("prefix").alias("p"), F.col("class").alias("c"))).alias("i", "t"))
        .select("g", "node", "n", "first", "own", (F.col("first") + F.col("i")).alias("at"),
                F.col("t.p").alias("token"), F.col("t.c").alias("class")))
    # A list of one group gives no pair.
    shared = postings.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token")
    postings = stage(postings.join(shared, "token", "left_semi"), "postings")
    # Long lists and groups in several parts, each with hubs of its own.
    parts = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.col("class") / 4) / LIST_SPLIT).cast("int")
    pairs = _to_hubs(postings.select("token", "node", "own", F.pmod("g", parts).alias("part")), ["token", "part"], HUBS)
    inside = _to_hubs(members.withColumn("part", F.pmod(F.hash("node"), F.lit(16))), ["g", "part"], 1)
    links = stage(verify(_ordered(pairs.union(inside)), nodes), "linked")

    def known():
        c = components(links)
        return stage_small(members.join(c, "node", "left")
                     .select("node", "g", "own", F.coalesce("component", "node").alias("c")), "placed")

    def leads(lists: DataFrame, keys: list[str]) -> DataFrame:
        """The most central member of every component in a list."""
        return (lists.groupBy(*keys, "c").agg(F.min(F.struct("own", "node")).alias("m"))
                .select(*keys, F.col("m.own").alias("own"), F.col("m.node").alias("node")))

    placed = known()
    listed = postings.select("token", "g").join(placed, "g")
    pairs = _to_hubs(leads(listed, ["token"]), ["token"], HUBS)
    inside = _to_hubs(leads(placed, ["g"]), ["g"], 1)
    links = stage(links.union(verify(_ordered(pairs.union(inside)), nodes)).distinct(), "linked")
    # All that is left: in every list, members outside its largest component against all others.
    placed = known()
    held = postings.drop("node", "own", "class").join(placed.select("g", "c").distinct(), "g")
    sizes = held.groupBy("token", "c").agg(F.count("*").alias("k"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("k", "c")).alias("m"), F.count("*").alias("cs"))
    largest = largest.filter("cs > 1").select("token", F.col("m.c").alias("main"))
    held = stage(held.join(largest, "token"), "open")
    x, y = held.filter("c != main").alias("x"), held.alias("y")
    once = (F.col("y.c") == F.col("y.main")) | (F.col("x.c") < F.col("y.c"))
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") != F.col("y.c")) & once & _fits("x", "y")
    pairs = x.join(y, meet).select(F.col("x.g").alias("ga"), F.col("x.c").alias("ca"),
                                    F.col("y.g").alias("gb"), F.col("y.c").alias("cb")).distinct()
    side = lambda k: placed.select(F.col("g").alias(f"g{k}"), F.col("c").alias(f"c{k}"), F.col("node").alias(k))
    across = pairs.join(side("a"), ["ga", "ca"]).join(side("b"), ["gb", "cb"]).select("a", "b")
    # Members of one group share their prefix, whatever their components.
    split = placed.groupBy("g").agg(F.min("c").alias("l"), F.max("c").alias("h")).filter("l < h").select("g")
    split = placed.join(split, "g", "left_semi")
    within = (split.select("g", F.col("c").alias("ca"), F.col("node").alias("a"))
              .join(split.select("g", F.col("c").alias("cb"), F.col("node").alias("b")), "g")
              .filter("ca < cb").select("a", "b"))
    links = stage(links.union(verify(_ordered(across.union(within)), nodes, sift=True)), "linked")
    return components(links)


def near_duplicates(docs: DataFrame, n: int = WORDS, with_links: bool = False, carry: Column | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text; more is ignored).

    With `with_links` also n_links, the number of other rows that a row is linked to, its copies included.
    With `carry`, a long made from the columns of `docs`, also `carried`, to tell rows of one doc_id apart.

    Null and empty texts have no shingles and stand alone: component_id is their own doc_id, as for
    any document without a link. Rows with a null doc_id keep it; a component's id is the smallest
    doc_id that is not null. Repeated rows are returned as often as they come.
    """
    spark = docs.sparkSession
    sets = stage(signatures(docs, n, carry), "signatures")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    tasks = max(partitions(spark), -(-total // TASK_TOKENS))
    nodes = stage(shared_tokens(docs, tasks, n), "sets")
    found = stage_small(node_links(nodes), "components")
    # One row per set, then one per component; rows of hot sets and sets of hot components are salted.
    own = sets.filter("node != 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    own = stage_small(own.join(found, "node", "left").filter("copies > 1 or component is not null"), "own")
    least = own.filter("component is not null").groupBy("component").agg(F.min("least").alias("_least"))
    known = lookup_join(own, least, ["component"], "left", ["node"]).select(
        "node", "copies", F.coalesce("_least", "least").alias("component_id"))
    columns = ["doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")]
    columns += [] if carry is None else ["carried"]
    if with_links:
        linked = own.filter("component is not null").select("node", "copies")
        links = stage_small(link_counts(nodes, found, linked), "counts")
        known = known.join(links, "node", "left")
        columns.append((F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    placed = lookup_join(sets, stage_small(known, "known"), ["node"], "left", ["doc_id"])
    return placed.select(*columns)
