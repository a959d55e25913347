"""I-Match fingerprints with several randomised lexicons.

Document frequencies of all terms are counted over all documents. Terms inside a band of the inverse
document frequency are the lexicon: common ones say nothing, rare ones are noise. A term in at least
`least` of all documents is one of at most (distinct terms per document) / least, whatever the
corpus, so the lexicon has a proven bound and can be sent to every task.

Each sub-lexicon keeps a random share of the lexicon: EACH of them at every one of RATES. A
fingerprint is, per sub-lexicon, the hash of the sorted distinct terms of the text that are in it (0
where there are none). Small shares suit long texts, large shares short ones. The likeness of two
fingerprints is the share of equal hashes among the sub-lexicons that are not empty in both. Texts
with no term of the lexicon are fingerprinted by all their distinct terms instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch, stage, tasks_for

BAND = (0.0005, 0.05)
RATES, EACH = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512), 8
SUBSETS = len(RATES) * EACH
ID_BITS = 48
COUNTS = "bucket int, terms binary, counts binary"
LEXICON_ROWS = 1 << 22


def _distinct(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) pairs of the distinct terms of each row, sorted."""
    _, _, hashes, bounds = kernels.words(part, offsets, fold=True)
    hashes >>= np.uint64(64 - ID_BITS)
    each = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return np.repeat(np.arange(len(each)), [len(e) for e in each]), np.concatenate([*each, np.empty(0, np.uint64)])


def document_frequencies(docs: DataFrame, least: int, tasks: int) -> DataFrame:
    """(term, df) of the terms that at least `least` documents have.

    Terms are 48-bit hashes of lower-cased words. Each map task sums its own rows and sends packed
    (term, count) blocks by hash range, 5 bytes a term; nothing is dropped before the sum is whole.
    """
    rest_bits = ID_BITS - min(24, max(10, (4 * tasks - 1).bit_length()))

    def pack(held):
        term, count = held
        top = (term >> np.uint64(rest_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
        rows = [[], [], []]
        for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(term)].tolist()):
            rest = term[a:b] & np.uint64((1 << rest_bits) - 1)
            rows[0].append(int(top[a]))
            rows[1].append(rest.view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
            wide = count[a:b].astype(np.uint32)
            rows[2].append((wide.astype(np.uint8) if wide.max() < 256 else wide).tobytes())
        return record_batch(COUNTS, *rows)

    def partial(batches):
        held = None
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            found = [held[0]] if held else []
            counts = [held[1]] if held else []
            for a, b in kernels.pieces(offsets):
                _, terms = _distinct(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                term, count = np.unique(terms, return_counts=True)
                found.append(term)
                counts.append(count)
            if not found:
                continue
            term, at = np.unique(np.concatenate(found), return_inverse=True)
            held = term, np.bincount(at, np.concatenate(counts), len(term)).astype(np.int64)
            if len(term) > 2_000_000:
                yield pack(held)
                held = None
        if held and len(held[0]):
            yield pack(held)

    def total(batches):
        terms, counts = [], []
        for batch in batches:
            for r in batch.to_pylist():
                raw = np.frombuffer(r["terms"], np.uint8).reshape(-1, 5)
                wide = np.zeros((len(raw), 8), np.uint8)
                wide[:, :5] = raw
                terms.append(wide.view(np.uint64).ravel() | np.uint64(r["bucket"] << rest_bits))
                small = len(r["counts"]) == len(raw)
                counts.append(np.frombuffer(r["counts"], np.uint8 if small else np.uint32).astype(np.int64))
        if terms:
            term, at = np.unique(np.concatenate(terms), return_inverse=True)
            df = np.bincount(at, np.concatenate(counts), len(term)).astype(np.int64)
            kept = df >= least
            yield record_batch("term long, df long", term[kept].view(np.int64), df[kept])

    return (docs.select("text").mapInArrow(partial, COUNTS).repartition(tasks, "bucket")
            .mapInArrow(total, "term long, df long"))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted terms whose document frequency is a share of all documents inside `band`."""
    tasks, n = tasks_for(docs)
    least = max(2, int(np.ceil(band[0] * n)))
    found = stage(document_frequencies(docs, least, tasks), "frequencies").filter(F.col("df") <= max(band[1] * n, 2))
    terms = np.array([r[0] for r in found.select("term").limit(LEXICON_ROWS + 1).collect()], np.int64)
    if len(terms) > LEXICON_ROWS:
        raise ValueError("the lexicon is too large; raise the lower end of the band")
    return np.sort(terms.view(np.uint64))


def _members(terms: np.ndarray) -> np.ndarray:
    """For each term and sub-lexicon, whether it belongs."""
    out = np.empty((len(terms), SUBSETS), bool)
    shifts = np.arange(1, SUBSETS + 1, dtype=np.uint64) * kernels.BASE
    for k in range(SUBSETS):
        draw = kernels.mix(terms + shifts[k])
        out[:, k] = draw < np.uint64(int(RATES[k // EACH] * (1 << 64)) - 1)
    return out


class Fingerprints:
    """Fingerprints of many texts against one lexicon."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.member = _members(terms)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of SUBSETS 32-bit hashes per text; 0 for a sub-lexicon without terms."""
        rows, terms = _distinct(data, offsets)
        n = len(offsets) - 1
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        bare = np.bincount(rows[known], minlength=n) == 0
        # Sums of mixed hashes over the sorted distinct terms stand for hashing their list.
        value = kernels.mix(terms * kernels.BASE) | np.uint64(1)
        out = np.zeros((n, SUBSETS), np.uint64)
        inside, where = rows[known], self.member[at[known]]
        if len(inside):
            starts = np.flatnonzero(np.r_[True, inside[1:] != inside[:-1]])
            every = value[known]
            for k in range(SUBSETS):
                out[inside[starts], k] = np.add.reduceat(np.where(where[:, k], every, np.uint64(0)), starts)
        if bare.any():
            loose = np.zeros(n, np.uint64)
            np.add.at(loose, rows, value)
            out[bare] = loose[bare, None]
        mixed = (kernels.mix(out) >> np.uint64(32)).astype(np.uint32)
        return np.where(out == 0, np.uint32(0), np.maximum(mixed, 1))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among the sub-lexicons that either has; two empty ones are alike."""
    either = (a != 0) | (b != 0)
    same = ((a == b) & either).sum(1)
    total = either.sum(1)
    return np.where(total == 0, 1.0, same / np.maximum(total, 1))


def _hexes(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")




def fingerprints(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; null is the empty text."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        prints = Fingerprints(sent.value)
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                chars = np.diff(kernels.code_points(part)[cuts])
                yield record_batch("doc_id long, n_chars long, fingerprint string",
                                   batch.column("doc_id").slice(a, b - a), chars, _hexes(prints.of(part, cuts)))

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_chars long, fingerprint string"))


def edit_study(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Fingerprint of every text, of its edited form and of the next text, with their likeness (OUT).

    The next document is the next in ascending doc_id, after the last the first; equal ids follow
    each other by text and a null id comes first. A single document follows itself.

    Cut points of the ids deal the documents to ranges; the first document of a range is also sent
    to the range before it, so texts move once and each task reads its own in order.
    """
    spark = docs.sparkSession
    tasks, _ = tasks_for(docs)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / (2 * tasks) for i in range(1, 2 * tasks)], max(10_000, 20 * tasks))).first()[0]
    cuts = sorted(set(cuts or []))
    # ids up to cuts[0] have range 0, up to cuts[1] range 1, and so on; null has range 0.
    ranged = docs.withColumn("range", _range_of(F.col("doc_id"), cuts))
    lowest = F.lit(-(1 << 63))
    firsts = (ranged.groupBy("range").agg(F.min(F.coalesce("doc_id", lowest)).alias("first"))
              .orderBy("range").collect())
    present = [r["range"] for r in firsts]
    before = {r: present[i - 1] for i, r in enumerate(present)}
    lead = spark.createDataFrame(
        [(r["range"], r["first"], before[r["range"]]) for r in firsts], "range int, _first long, _before int")
    dealt = ranged.join(F.broadcast(lead), "range", "left")
    is_first = F.coalesce("doc_id", lowest) == F.col("_first")
    dealt = dealt.select("doc_id", "text", F.explode(F.when(is_first, F.array(
        F.struct(F.col("range").alias("r"), F.lit(False).alias("guest")),
        F.struct(F.col("_before").alias("r"), F.lit(True).alias("guest"))))
        .otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("guest"))))).alias("e"))
    dealt = (dealt.select("doc_id", "text", "e.r", "e.guest").repartition(tasks, "r")
             .sortWithinPartitions("r", "guest", F.col("doc_id").asc_nulls_first(), "text"))
    sent = spark.sparkContext.broadcast(terms)

    def run(batches):
        prints = Fingerprints(sent.value)
        held: list[tuple] = []
        for batch in batches:
            room = 0
            for row in zip(batch.column("r").to_pylist(), batch.column("guest").to_pylist(),
                           batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held.append(row)
                room += len(row[3])
                if room > kernels.CHUNK:
                    yield from study(prints, held)
                    held, room = held[-1:], 0
            # Rows stay until their follower has come.
            if len(held) > 1:
                yield from study(prints, held)
                held = held[-1:]

    def study(prints, held):
        pairs = [(x, y) for x, y in zip(held, held[1:]) if not x[1] and x[0] == y[0]]
        if not pairs:
            return
        texts, seen = [], {}
        for x, y in pairs:
            cut = len(x[3]) // 4
            texts += [x[3], x[3][: len(x[3]) - cut] + y[3][:cut]]
            seen[id(y)] = y
        texts += [pairs[-1][1][3]]
        column = pa.array(texts, pa.large_string())
        data, offsets = kernels.column_bytes(column)
        parts = [prints.of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                 for a, b in kernels.pieces(offsets)]
        every = np.concatenate(parts)
        own, edited = every[:-1:2], every[1::2]
        after = np.concatenate([own[1:], every[-1:]])
        for i, (x, y) in enumerate(pairs):  # pairs need not touch: a new range may begin between them
            if i + 1 < len(pairs) and pairs[i + 1][0] is not y:
                after[i] = prints.of(*kernels.column_bytes(pa.array([y[3]], pa.large_string())))[0]
        yield record_batch(OUT, [x[2] for x, _ in pairs], [len(x[3]) for x, _ in pairs],
                           [hashlib.sha256(t.encode()).hexdigest() for t in texts[1::2]],
                           _hexes(own), _hexes(edited), likeness(own, edited), likeness(own, after))

    return dealt.mapInArrow(run, OUT)


def _range_of(doc_id, cuts: list[int]):
    """Number of cut points below `doc_id` (null: none), by halving steps."""
    if not cuts:
        return F.lit(0)
    edges = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    below = lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(edges, at + step - 1) < doc_id), at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), below)
