"""Language identification by words first, and by ever shorter character n-grams for words never seen.

A word is a run of letters, lower-cased. A word of the fitted table scores, for each language, the logarithm
of its smoothed relative frequency there. Any other word is written between two marks; every place of
it takes the longest fitted n-gram that ends there (five characters, then four, down to one), and the mean
over its places is the word's score. A document's scores are the sums over its words and the log share of
each language among training documents; their softmax gives the prediction and its probability.

The model is fitted on about PER_LANGUAGE documents of each language, chosen by a hash of doc_id, and keeps
the WORDS most frequent words and the GRAMS most frequent n-grams of each length per language; all three are
parameters, so the model's size does not follow the corpus. Everything is counted in Spark; tasks get the
tables and score whole texts in stretches of about a megabyte.

Null texts and texts without a letter are `und` with score 0; so is every text where nothing was learned. Rows
with a null lang or doc_id are not learned from. Equal scores go to the language first in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tokenloom.llm import kernels
from tokenloom.llm.shared import mixed, record_batch, stage_small

PER_LANGUAGE, WORDS, GRAMS, LONGEST = 2000, 60_000, 20_000, 5
LEAST_COUNT = 2  # a word seen once is left to its n-grams
SMOOTHING = 0.5
UNKNOWN = "und"
MARK = 0x20

COUNTS = "lang string, kind int, key long, n long"
RESULT = "doc_id long, lang_pred string, score double"

_TABLES: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: its lower case, whether it is a letter, and a random key. Built once per worker."""
    if not _TABLES:
        points = [chr(c) for c in range(0x110000)]
        lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in points], np.uint32)
        keys = kernels.mix(np.arange(1, 0x110001, dtype=np.uint64) * kernels.BASE) | np.uint64(1)
        _TABLES.extend([lower, np.array([c.isalpha() for c in points]), keys])
    return tuple(_TABLES)


def _spans(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Hash of the `sizes` keys from each start on."""
    up, down = kernels.powers(len(keys) + 1)
    sums = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(keys * up[:-1], out=sums[1:])
    return kernels.mix((sums[starts + sizes] - sums[starts]) * down[starts] + np.uint64(sizes if np.isscalar(sizes) else 0))


def _words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(code points, starts, sizes, rows, hashes) of the words, a stretch of text at a time."""
    lower, letter, keys = _letters()
    for a, b in kernels._stretches(data):
        part = data[a:b]
        points = lower[np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32)]
        if not len(points):
            continue
        inside = letter[points]
        at = kernels.code_points(part)[np.clip(offsets - a, 0, len(part))]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = at[(at > 0) & (at < len(points))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        starts = np.flatnonzero(first)
        sizes = np.flatnonzero(last) + 1 - starts
        rows = np.searchsorted(at, starts, "right") - 1
        yield points, starts, sizes, rows, _spans(keys[points], starts, sizes)


def _grams(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words written between marks: keys one after another, and per place its word and its place there."""
    _, _, keys = _letters()
    room = sizes + 2
    word, place = np.repeat(np.arange(len(starts)), room), kernels.ranges(room)
    edge = (place == 0) | (place == room[word] - 1)
    from_text = np.where(edge, 0, starts[word] + place - 1)
    return np.where(edge, keys[MARK], keys[points[from_text]]), word, place


def _gram_hashes(keys: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that have `n` characters up to and with them in their word, and the hashes of these."""
    ends = np.flatnonzero(place >= n - 1)
    return ends, _spans(keys, ends - n + 1, n)


class WordFirstModel:
    """Fitted tables: sorted keys with a row of log frequencies, one number per language."""

    def __init__(self, languages: list[str], shares: list[float], tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.languages, self.prior = languages, np.log(np.array(shares, np.float64))
        self.tables = tables  # 0: words; n: n-grams of n characters

    def _find(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in a table, or -1."""
        keys = self.tables[kind][0]
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        return np.where(keys[at] == hashes, at, -1) if len(keys) else np.full(len(hashes), -1)

    def _spelled(self, points, starts, sizes) -> np.ndarray:
        """Scores of unseen words by the longest known n-gram at each place."""
        keys, word, place = _grams(points, starts, sizes)
        score = np.zeros((len(keys), len(self.languages)))
        todo = np.ones(len(keys), bool)
        for n in range(LONGEST, 0, -1):
            ends, hashes = _gram_hashes(keys, place, n)
            ends, hashes = ends[todo[ends]], hashes[todo[ends]]
            row = self._find(n, hashes)
            score[ends[row >= 0]] = self.tables[n][1][row[row >= 0]]
            todo[ends[row >= 0]] = False
        sums = np.stack([np.bincount(word, s, len(starts)) for s in score.T], 1)
        return sums / (sizes + 2)[:, None]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log scores by text and language, number of words by text)."""
        n = len(offsets) - 1
        total, count = np.tile(self.prior, (n, 1)), np.zeros(n, np.int64)
        for points, starts, sizes, rows, hashes in _words(data, offsets):
            kinds, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            found = self._find(0, kinds)
            score = np.zeros((len(kinds), len(self.languages)))
            known = found >= 0
            score[known] = self.tables[0][1][found[known]]
            rest = first[~known]
            if len(rest):
                score[~known] = self._spelled(points, starts[rest], sizes[rest])
            count += np.bincount(rows, minlength=n)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(rows, score[which, k], n)
        return total, count

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * (len(offsets) - 1), np.zeros(len(offsets) - 1)
        total, count = self.scores(data, offsets)
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names = [self.languages[b] if c else UNKNOWN for b, c in zip(best.tolist(), count.tolist())]
        return names, np.where(count > 0, score, 0.0)


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, kind, key, n): words (kind 0) and n-grams (kind n) of rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            coded = batch.column("lang").dictionary_encode()
            names, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            for a, b in kernels.pieces(offsets):
                for points, starts, sizes, rows, hashes in _words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                    lang = which[a + rows]
                    for k in np.unique(lang).tolist():
                        mine = lang == k
                        yield from _rows(names[k], points, starts[mine], sizes[mine], hashes[mine])

    def _rows(name, points, starts, sizes, hashes):
        keys, _, place = _grams(points, starts, sizes)
        for kind in range(LONGEST + 1):
            found, n = np.unique(hashes if kind == 0 else _gram_hashes(keys, place, kind)[1], return_counts=True)
            yield record_batch(COUNTS, [name] * len(found), np.full(len(found), kind), found.view(np.int64), n)

    return docs.mapInArrow(run, COUNTS).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS) -> WordFirstModel:
    """Fit on the rows of `docs` (doc_id, text, lang) where `train` holds, see the head of this module."""
    known = docs.filter(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return WordFirstModel([], [], {})
    # A hash below the language's share: no sort, no window, the same rows every time.
    spark = docs.sparkSession
    shares = spark.createDataFrame([(k, per_language / n) for k, n in sizes.items()], "lang string, _share double")
    spot = F.pmod(mixed(F.col("doc_id"), seed=23), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(shares), "lang").filter(spot < F.col("_share")).select("lang", "text")
    counts = stage_small(_counted(sample), "counts")
    order = W.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    most = F.when(F.col("kind") == 0, words).otherwise(grams)
    least = F.when(F.col("kind") == 0, LEAST_COUNT).otherwise(1)
    kept = counts.filter(F.col("n") >= least).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most)
    listed = kept.select("kind", "key").distinct()
    number = F.array_position(F.array(*[F.lit(k) for k in languages]), F.col("lang")).cast("int") - 1
    table = counts.join(listed, ["kind", "key"], "left_semi").select(number.alias("lang"), "kind", "key", "n").toArrow()
    lang, kinds, keys, n = (table.column(c).to_numpy() for c in ("lang", "kind", "key", "n"))
    totals = {(r["lang"], r["kind"]): r["n"] for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    tables = {}
    for kind in range(LONGEST + 1):
        mine = kinds == kind
        known, which = np.unique(keys[mine].view(np.uint64), return_inverse=True)
        often = np.zeros((len(known), len(languages)))
        often[which, lang[mine]] = n[mine]
        whole = np.array([totals.get((k, kind), 0) for k in languages], np.float64)
        tables[kind] = (known, np.log((often + SMOOTHING) / (whole + SMOOTHING * max(1, len(known)))))
    total = sum(sizes.values())
    return WordFirstModel(languages, [sizes[k] / total for k in languages], tables)


def predict(docs: DataFrame, model: WordFirstModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text; other columns are ignored)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                names, score = sent.value.predict(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield record_batch(RESULT, batch.column("doc_id").slice(a, b - a), names, score)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
