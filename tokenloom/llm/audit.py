"""How filters interact: what every order of five filters removes, from one word per document.

A document fails some of the filters; it survives a set of filters if it fails none of them. With five
filters there are 32 sets, so a document is a 32-bit word whose bit s says whether it survives set s. All
that any order of the filters does follows from how many documents of a part (and of a label) survive each
set: a filter after the set s removes survivors(s) - survivors(s with it). These 32 counts come from
positional popcounts: carry-save adders turn three words into a sum word and a carry word, so a block of
words shrinks to a few words per weight, whose bits are then counted.

Per text one small row (id, part, failures of A-D, 128-bit digest) is written. Filter E (a copy of a smaller
doc_id's text) takes the smallest id of each digest, aggregated before the shuffle, and gives it back by
(digest, doc_id), of which there is one row: no group of copies is ever gathered. Equal digests stand for
equal texts.

Null texts are empty texts; a null lang is the part ''. A null doc_id is no smaller id, is a copy of nothing,
and has no labels. Of rows that share the smallest id and the text, none is a copy. A document labelled
more than once has a label if one of its rows says so. No documents, no parts, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch, stage

# ---- fixed values: the filters and their thresholds ------------------------------------------------
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
ODD_CHARACTERS = "#$%&*|"
# --------------------------------------------------------------------------------------------------

SETS = 1 << len(FILTERS)
# Bit s of SURVIVORS[f]: failing the filters f, a document survives the set s.
SURVIVORS = np.array([sum(1 << s for s in range(SETS) if not s & f) for f in range(SETS)], np.uint32)
ALL, GOOD, TOXIC = "all", "good", "toxic"
HELD_WORDS = 1 << 18  # words of one class counted at a time

FLAGS = "doc_id long, part string, fails int, digest binary"
COUNTS = "part string, label string, subset int, n long"
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")

ODD = np.zeros(256, bool)
ODD[[ord(c) for c in ODD_CHARACTERS]] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which of the filters A to D each text fails, as bits in that order."""
    _, _, hashes, bounds = kernels.words(data, offsets)
    words = np.diff(bounds)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.int64)
    capitals = _per_text((data >= 65) & (data <= 90), offsets)
    points = _per_text((data & 0xC0) != 0x80, offsets)
    fails = (words < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * words,
             100 * capitals > CAPITAL_PERCENT * points, _per_text(ODD[data], offsets) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def flagged(docs: DataFrame, part: Column) -> DataFrame:
    """(doc_id, part, fails, digest) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                own = offsets[a : b + 1] - offsets[a]
                block = data[offsets[a] : offsets[b]]
                raw = block.tobytes()
                digests = [hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(own[:-1], own[1:])]
                yield record_batch(FLAGS, batch.column("doc_id").slice(a, b - a), batch.column("part").slice(a, b - a),
                                   failures(block, own), digests)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(run, FLAGS)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words (uint32) have each bit set, by carry-save adders."""
    counts = np.zeros(32, np.int64)
    weight, level = 0, words
    while len(level):
        carries = []
        while len(level) > 2:
            k = len(level) // 3
            a, b, c = level[:k], level[k : 2 * k], level[2 * k : 3 * k]
            half = a ^ b
            carries.append((a & b) | (c & half))
            level = np.concatenate([half ^ c, level[3 * k :]])
        for word in level:
            counts += (word >> np.arange(32, dtype=np.uint32) & 1).astype(np.int64) << weight
        level = np.concatenate(carries) if carries else words[:0]
        weight += 1
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """(part, label, subset, n) from rows (part, fails, good, toxic): how many survive each set of filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}  # waiting words, and counts so far

        def count(key):
            waiting, sums = held[key]
            if waiting:
                sums += positional_popcount(np.concatenate(waiting))
                waiting.clear()

        def counted():
            for key in held:
                count(key)
            keys = list(held)
            out = record_batch(COUNTS, [k[0] for k in keys for _ in range(SETS)], [k[1] for k in keys for _ in range(SETS)],
                               np.tile(np.arange(SETS), len(keys)), np.concatenate([held[k][1] for k in keys]))
            held.clear()
            return out

        for batch in batches:
            coded = batch.column("part").dictionary_encode()
            which = coded.indices.to_numpy(zero_copy_only=False)
            words = SURVIVORS[batch.column("fails").to_numpy(zero_copy_only=False)]
            marks = {ALL: None} | {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (GOOD, TOXIC)}
            for i, part in enumerate(coded.dictionary.to_pylist()):
                mine = which == i
                for label, marked in marks.items():
                    key = (part, label)
                    waiting = held.setdefault(key, ([], np.zeros(SETS, np.int64)))[0]
                    waiting.append(words[mine if marked is None else mine & marked])
                    if sum(map(len, waiting)) > HELD_WORDS:
                        count(key)
            if len(held) > 3000:
                yield counted()
        if held:
            yield counted()

    counts = rows.select("part", "fails", GOOD, TOXIC).mapInArrow(run, COUNTS)
    return counts.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def _orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders; per order and step the set before it and the filter of the step."""
    places = list(permutations(range(len(FILTERS))))
    steps = np.array(places)
    before = np.cumsum(1 << steps, axis=1) - (1 << steps)
    return ["".join(FILTERS[k] for k in p) for p in places], before, steps


def effects(counts: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Columns kept to shapley of RESULT, order by order and step by step, from one part's survivors."""
    _, before, step = _orders()
    bit = 1 << step
    every = counts[ALL]
    after = before | bit
    removed = every[before] - every[after]
    failing = every[0] - every[bit]
    only = every[(SETS - 1) & ~bit] - every[SETS - 1]
    shapley = np.zeros(len(FILTERS), np.int64)
    for k in range(len(FILTERS)):
        for s in range(SETS):
            if not s >> k & 1:
                size = s.bit_count()
                orders = factorial(size) * factorial(len(FILTERS) - 1 - size)
                shapley[k] += orders * (every[s] - every[s | 1 << k])
    lost = [counts[k][before] - counts[k][after] for k in (GOOD, TOXIC)]
    return [x.ravel() for x in (every[after], removed, failing - removed, only, *lost, shapley[step])]


def audit(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """One row (RESULT) per part, order of the filters and step, zeros included."""
    flags = stage(flagged(docs, part), "flags")
    first = (flags.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("_first", F.lit(True)))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias(GOOD), F.max(F.col("toxic") == 1).alias(TOXIC)))
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    rows = (flags.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("fails") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("fails"),
                    *[F.coalesce(k, F.lit(False)).alias(k) for k in (GOOD, TOXIC)]))
    names, _, step = _orders()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = {k: np.zeros(SETS, np.int64) for k in (ALL, GOOD, TOXIC)}
                for c in r["counts"]:
                    counts[c["label"]][c["subset"]] = c["n"]
                yield record_batch(RESULT, [r["part"]] * step.size, np.repeat(names, len(FILTERS)).tolist(),
                                   np.tile(np.arange(1, len(FILTERS) + 1), len(names)), *effects(counts))

    # 3 * 32 counts per part.
    whole = survivors(rows).groupBy("part").agg(F.collect_list(F.struct("label", "subset", "n")).alias("counts"))
    return whole.mapInArrow(expand, RESULT)


def audit_sql() -> str:
    """The same in SQL, from how many documents fail each set of filters."""
    bits = " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, c in enumerate((
        f"words < {LEAST_WORDS}", f"100 * kinds < {DISTINCT_PERCENT} * words", f"100 * capitals > {CAPITAL_PERCENT} * points",
        "odd", "copy")))
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
    bit_of = "CAST(1 << (ascii(substring(filter_order, {}, 1)) - 65) AS INTEGER)"
    return f"""WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
parsed AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
  min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
measured AS (SELECT doc_id, part, len(w) AS words, len(list_distinct(w)) AS kinds,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(text) AS points,
  regexp_matches(text, '[{ODD_CHARACTERS}]') AS odd, coalesce(least < doc_id, false) AS copy FROM parsed),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (SELECT part, {bits} AS f, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM measured LEFT JOIN marks USING (doc_id) GROUP BY ALL),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, {bit_of.format("step")} AS bit,
  CAST(list_sum(list_transform(range(1, step), lambda k: {bit_of.format("k")})) AS INTEGER) AS before
  FROM (VALUES {orders}) o(filter_order), range(1, 6) r(step)),
found AS (SELECT part, filter_order, step, bit,
  sum(n) FILTER (f & (coalesce(before, 0) | bit) = 0) AS kept,
  sum(n) FILTER (f & coalesce(before, 0) = 0 AND f & bit > 0) AS removed,
  sum(n) FILTER (f & coalesce(before, 0) > 0 AND f & bit > 0) AS redundant,
  sum(n) FILTER (f = bit) AS unique_fails,
  sum(n_good) FILTER (f & coalesce(before, 0) = 0 AND f & bit > 0) AS good_lost,
  sum(n_toxic) FILTER (f & coalesce(before, 0) = 0 AND f & bit > 0) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM found"""
