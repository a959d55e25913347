"""Benchmark decontamination: a BM25 index of the test items, searched by every passage.

The index holds, for each term of a block of at most ITEMS items, the postings (item, weight) in
item order, cut into runs of BLOCK items with the largest weight of each. A weight is the BM25 part
of the term, divided by what the item would score against itself, so that one threshold serves all
items. A passage is `2 * longest item` words long and begins every half of that, so any copy of an
item lies whole inside a passage.

Every passage of every document is a query, in two steps that give the same result as scoring all
pairs:
* the block bounds of all passages of a batch are summed at once (term by block postings); a passage
  none of whose blocks can reach the threshold is done;
* the others are searched document-at-a-time by block-max WAND, which returns every item at or above
  the threshold.
Retrieved pairs are verified: the share of the question's word trigrams and the share of the answer's
words that the passage has. A table without an `answer` column has the last quarter of the item as
its answer.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch, stage

K1, B = 1.2, 0.75
ITEMS, BLOCK = 20_000, 4
THRESHOLD, QUESTION, ANSWER = 0.6, 0.6, 0.6
END = 1 << 60


class ItemIndex:
    """Inverted index of one block of test items, given as (item, question words, answer words).

    Weights follow from the statistics of all items, of which the block may be a part: `among` is
    their number, their mean length, and for each word of the block how many of them have it.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], among: tuple[int, float, dict[int, int]] | None = None):
        self.ids = [i for i, _, _ in items]
        self.parts = [(q, a) for _, q, a in items]
        words = [np.concatenate([q, a]) for q, a in self.parts]
        lengths = np.array([len(w) for w in words])
        self.half = max(32, int(lengths.max(initial=0)))
        counts = [Counter(w.tolist()) for w in words]
        df = Counter(t for c in counts for t in c)
        number, average = len(words), lengths.mean() if len(lengths) else 1.0
        self.vocab = np.array(sorted(df), np.uint64)
        if among is not None:
            number, average, df = among
        at = {t: i for i, t in enumerate(self.vocab.tolist())}
        postings: list[list[tuple[int, float]]] = [[] for _ in at]
        for n, c in enumerate(counts):
            weight = {t: math.log(1 + (number - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1)
                      / (tf + K1 * (1 - B + B * lengths[n] / average)) for t, tf in c.items()}
            whole = sum(weight.values())
            for t, w in weight.items():
                postings[at[t]].append((n, w / whole))
        self.items = [np.array([n for n, _ in p], np.int64) for p in postings]
        self.weights = [np.array([w for _, w in p]) for p in postings]
        self.most = np.array([w.max() for w in self.weights])
        self.blocks = -(-len(words) // BLOCK)
        # Block postings of all terms in one list: those of term i are at first[i]:first[i + 1].
        each = [np.unique(n // BLOCK, return_index=True) for n in self.items]
        self.bounds = [np.maximum.reduceat(w, at) for w, (_, at) in zip(self.weights, each)]
        self.block_of = np.concatenate([b for b, _ in each]) if each else np.empty(0, np.int64)
        self.bound_of = np.concatenate(self.bounds) if each else np.empty(0)
        self.first = np.r_[0, np.cumsum([len(b) for b in self.bounds])].astype(np.int64)
        # Open table on the top bits of a term for fast lookup.
        self.shift = np.uint64(64 - max(12, (4 * len(self.vocab)).bit_length()))
        self.slots = np.searchsorted(self.vocab, np.arange((1 << int(64 - self.shift)) + 1, dtype=np.uint64) << self.shift) \
            if len(self.vocab) else np.zeros(2, np.int64)
        self.slots[-1] = len(self.vocab)
        self.deepest = int(np.diff(self.slots).max()) if len(self.vocab) else 0

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.vocab):
            return out
        top = (hashes >> self.shift).astype(np.int64)
        low, high = self.slots[top], self.slots[top + 1]
        for step in range(self.deepest):
            at = np.minimum(low + step, len(self.vocab) - 1)
            hit = (low + step < high) & (self.vocab[at] == hashes)
            out[hit] = at[hit]
        return out

    def live(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Of distinct (passage, term) pairs sorted by passage: the passages with a block that may score enough."""
        if not len(passage):
            return passage
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        number = np.cumsum(np.r_[False, passage[1:] != passage[:-1]])
        may = np.add.reduceat(self.most[term], starts) >= THRESHOLD
        kept = may[number]
        number, term = number[kept], term[kept]
        spans = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term], spans) + kernels.ranges(spans)
        key = np.repeat(number, spans) * self.blocks + self.block_of[at]
        total = np.bincount(key, self.bound_of[at], len(starts) * self.blocks).reshape(len(starts), self.blocks)
        return passage[starts[total.max(1) >= THRESHOLD - 1e-9]]

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose score over the distinct `terms` is at least THRESHOLD."""
        lists = [(self.items[t], self.weights[t], self.bounds[t], self.block_of[self.first[t] : self.first[t + 1]], self.most[t])
                 for t in terms]
        at = [0] * len(lists)
        here = [int(x[0][0]) for x in lists]
        found = []
        enough = THRESHOLD - 1e-9

        def skip(k: int, item: int) -> None:
            at[k] += int(np.searchsorted(lists[k][0][at[k] :], item))
            here[k] = int(lists[k][0][at[k]]) if at[k] < len(lists[k][0]) else END

        while True:
            order = sorted(range(len(lists)), key=here.__getitem__)
            total, pivot = 0.0, -1
            for p, k in enumerate(order):
                if here[k] == END:
                    break
                total += lists[k][4]
                if total >= enough:
                    pivot = p
                    break
            if pivot < 0:
                return found
            item = here[order[pivot]]
            while pivot + 1 < len(order) and here[order[pivot + 1]] == item:
                pivot += 1
            block = item // BLOCK
            bound = 0.0
            for k in order[: pivot + 1]:
                b = int(np.searchsorted(lists[k][3], block))
                if b < len(lists[k][3]) and lists[k][3][b] == block:
                    bound += lists[k][2][b]
            if bound < enough:
                # No item of this block can do; go on behind it, or at the next list if that is nearer.
                beyond = (block + 1) * BLOCK
                if pivot + 1 < len(order):
                    beyond = min(beyond, here[order[pivot + 1]])
                for k in order[: pivot + 1]:
                    if here[k] < beyond:
                        skip(k, beyond)
                continue
            if here[order[0]] == item:
                score = 0.0
                for k in order[: pivot + 1]:
                    score += lists[k][1][at[k]]
                    skip(k, item + 1)
                if score >= enough:
                    found.append((item, float(score)))
            else:
                for k in order[: pivot + 1]:
                    if here[k] < item:
                        skip(k, item)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct runs of `n` words."""
    size = max(0, len(words) - n + 1)
    return np.unique(kernels.mix(sum((words[k : k + size] * kernels.PLACES[k] for k in range(n)), np.zeros(size, np.uint64))))


def _question_share(question: np.ndarray, passage: np.ndarray) -> float:
    """Share of the question's word trigrams that the passage has; a shorter question is one run itself."""
    n = min(3, len(question))
    return _share(_grams(question, n), _grams(passage, n)) if n else 1.0


def _share(part: np.ndarray, whole: np.ndarray) -> float:
    return float(np.isin(part, whole).mean()) if len(part) else 1.0


OUT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, start int, end int"


def _match(index: ItemIndex, ids: pa.Array, data: np.ndarray, offsets: np.ndarray):
    """Verified pairs of the texts in one stretch; start and end are the code points of the best passage."""
    starts, ends, hashes, bounds = kernels.words(data, offsets)
    known = index.lookup(hashes)
    place = np.flatnonzero(known >= 0)
    if not len(place):
        return None
    half = index.half
    row = np.searchsorted(bounds, place, "right") - 1
    # A word of half h belongs to the passages h - 1 and h; passages are numbered over all texts.
    halves = -(-np.diff(bounds) // half)
    base = np.r_[0, np.cumsum(np.maximum(halves, 1))]
    inside = (place - bounds[row]) // half
    pair = np.concatenate([base[row] + inside, (base[row] + inside - 1)[inside > 0]])
    pair = pair * len(index.vocab) + np.concatenate([known[place], known[place][inside > 0]])
    pair = np.unique(pair)
    passage, term = pair // len(index.vocab), pair % len(index.vocab)
    best: dict[tuple[int, int], tuple] = {}
    points = None
    for p in index.live(passage, term).tolist():
        a, b = np.searchsorted(passage, [p, p + 1])
        hits = index.search(term[a:b].tolist())
        if not hits:
            continue
        r = int(np.searchsorted(base, p, "right")) - 1
        w0 = int(bounds[r]) + (p - int(base[r])) * half
        w1 = min(w0 + 2 * half, int(bounds[r + 1]))
        got = hashes[w0:w1]
        for n, score in hits:
            question, answer = index.parts[n]
            q, s = _question_share(question, got), _share(np.unique(answer), got)
            if q >= QUESTION and s >= ANSWER and (r, n) not in best or (r, n) in best and (q, s) > best[r, n][1:3]:
                if points is None:
                    points = kernels.code_points(data)
                first = points[offsets[r]]
                best[r, n] = (score, q, s, int(points[starts[w0]] - first), int(points[ends[w1 - 1]] - first))
    if not best:
        return None
    rows = [[ids[r].as_py(), index.ids[n], *found] for (r, n), found in sorted(best.items())]
    return record_batch(OUT, *[list(c) for c in zip(*rows)])


def lowered(column: pa.Array) -> pa.Array:
    """Lower-cased character by character, so that offsets stay."""
    return pc.utf8_lower(column.cast(pa.large_string()))


def item_words(question: str, answer: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a test item's question and answer; without an answer, its last quarter is one."""
    def hashed(text):
        return kernels.words(*kernels.column_bytes(lowered(pa.array([text]))))[2]

    words = hashed(question)
    if answer is not None:
        return words, hashed(answer)
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def _item_terms(batches):
    """The distinct words of each item, and one row with its length."""
    for batch in batches:
        for text, answer in zip(batch.column("text").to_pylist(), batch.column("answer").to_pylist()):
            words = np.concatenate(item_words(text, answer))
            kinds = np.unique(words).view(np.int64)
            yield record_batch("term long, length long", [*kinds.tolist(), None], [0] * len(kinds) + [len(words)])


def contaminated(docs: DataFrame, benchmark: DataFrame, items_per_index: int = ITEMS) -> DataFrame:
    """One row (OUT) per document and test item that it contains.

    `docs` has doc_id and text, `benchmark` item_id, text and perhaps answer. Null or empty texts and
    items without words match nothing; an item of one or two words matches where it stands as a whole.
    Repeated documents give repeated rows and items with one id
    one row each. An index holds at most `items_per_index` items and is broadcast; a larger benchmark is
    searched in several passes, with the term statistics of all items. Documents are never shuffled.
    """
    spark = docs.sparkSession
    columns = ["item_id", "text", F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string").alias("answer")]
    items = benchmark.filter("text is not null").select(*columns)
    passes = max(1, -(-items.count() // items_per_index))
    terms, number, average = None, 0, 1.0
    if passes > 1:
        words = stage(items.mapInArrow(_item_terms, "term long, length long"), "terms")
        terms = stage(words.filter("term is not null").groupBy("term").agg(F.count("*").alias("df")), "terms")
        number, length = words.filter("length > 0").agg(F.count("*"), F.sum("length")).first()
        average = (length or 1) / max(1, number)
    found = None
    for k in range(passes):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        block = [(r["item_id"], *item_words(r["text"], r["answer"])) for r in mine.orderBy("item_id", "text").collect()]
        block = [x for x in block if len(x[1]) + len(x[2])]
        among = None
        if terms is not None:
            own = mine.mapInArrow(_item_terms, "term long, length long").filter("term is not null").select("term").distinct()
            among = (number, average, {r["term"] % (1 << 64): r["df"] for r in terms.join(own, "term").collect()})
        index = spark.sparkContext.broadcast(ItemIndex(block, among))

        def run(batches, index=index):
            for batch in batches:
                data, offsets = kernels.column_bytes(lowered(batch.column("text")))
                for a, b in kernels.pieces(offsets):
                    out = _match(index.value, batch.column("doc_id").slice(a, b - a),
                                 data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    if out is not None:
                        yield out

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)
        found = part if found is None else found.union(part)
    return found
