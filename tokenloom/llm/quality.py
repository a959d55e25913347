"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

The terms of a document are its pairs of neighbouring characters, with characters put into 64 classes
(letters by case, digits, kinds of space and punctuation, non-ASCII), and how often a word is the one
before it or two before it, so every text has a vector of at most 4,098 counts. Latent vectors are the projection of log counts times inverse document
frequency on the leading singular vectors of a bounded sample of labelled documents.

The labelled latent vectors are broadcast: at most 2 * per_class rows of DIMENSIONS floats, whatever
the corpus. Every document is compared with all of them, exactly, in blocks of rows by one matrix
product; the NEIGHBOURS nearest vote with the weight of their similarity and of their class, so that
a sample with as many of either class still gives a probability at the labels' own rate.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import mixed, record_batch

PER_CLASS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 2048, 48, 25, 8
SIDE = 64
# Besides the pairs, the shares of words equal to the word 1 or 2 places before, with this weight.
REPEATS, REPEAT_WEIGHT = (1, 2), 8.0
TERMS = SIDE * SIDE + len(REPEATS)
ROWS_AT_ONCE = 512


def _classes() -> np.ndarray:
    out = np.full(256, 63, np.int32)
    out[97:123] = np.arange(26)
    out[65:91] = np.arange(26, 52)
    out[48:58], out[32], out[10] = 52, 53, 54
    out[[9, 11, 12, 13]] = 53
    out[0xC0:], out[0x80:0xC0] = 55, 56
    for k, marks in enumerate((b".,", b"!?", b"|", b"*#", b"$%&")):
        out[list(marks)] = 57 + k
    out[list(b"'\"()-:;")] = 62
    return out


CLASS = _classes()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, how often each pair of classes stands next to each other, and repeated words per 100."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, TERMS), np.float32)
    if not len(data):
        return out
    kind = CLASS[data]
    row = np.repeat(np.arange(n), lengths)
    code = row[:-1] * (SIDE * SIDE) + kind[:-1] * SIDE + kind[1:]
    code = code[row[:-1] == row[1:]]
    out[:, : SIDE * SIDE] = np.bincount(code, minlength=n * SIDE * SIDE).reshape(n, SIDE * SIDE)
    _, _, hashes, bounds = kernels.words(data, offsets)
    words = np.diff(bounds)
    owner = np.repeat(np.arange(n), words)
    for k, back in enumerate(REPEATS):
        same = (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
        out[:, SIDE * SIDE + k] = 100 * np.bincount(owner[back:][same], minlength=n) / np.maximum(words, 1)
    return out


def fit_space(counts: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(inverse document frequencies, projection) from the counts of the sample.

    The singular vectors come from subspace iteration with a fixed start, so reruns agree.
    """
    n = max(1, len(counts))
    idf = np.log((1 + n) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    idf[SIDE * SIDE :] = REPEAT_WEIGHT
    weighted = _weighted(counts, idf)
    basis = np.random.Generator(np.random.PCG64(8)).standard_normal((counts.shape[1], dimensions + 8)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    return idf, (basis @ right.T)[:, :dimensions].astype(np.float32)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


class NeighbourVotes:
    """A fitted space with its labelled vectors. Without labelled rows every score is `rate`."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, rate: float):
        self.labels, self.weights, self.rate = labels, weights.astype(np.float32), rate
        if len(labels):
            self.idf, self.projection = fit_space(counts)
            self.vectors = _unit(_weighted(counts, self.idf) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.rate)
        likeness = _unit(_weighted(counts, self.idf) @ self.projection) @ self.vectors.T
        k = min(NEIGHBOURS, likeness.shape[1])
        near = np.argpartition(likeness, -k, axis=1)[:, -k:]
        vote = np.maximum(np.take_along_axis(likeness, near, 1), 0) ** SHARPNESS * self.weights[near]
        total = vote.sum(1)
        good = (vote * self.labels[near]).sum(1)
        # A text unlike all of the sample (an empty one) has no votes; it gets the labels' own rate.
        return np.where(total > 1e-6, np.clip(good / np.maximum(total, 1e-6), 0, 1), self.rate).astype(np.float64)


SAMPLE = "doc_id long, codes binary, counts binary"


def labelled_sample(labels: DataFrame, label: str, train, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of up to `per_class` documents of each class, chosen by hash, and the class sizes.

    A document labelled more than once has the larger label; null labels and ids are left out.
    """
    known = (labels.filter(train & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label")))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = mixed(F.col("doc_id"), seed=11)
    parts = [known.filter(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].union(parts[1]), sizes


def fit(docs: DataFrame, labels: DataFrame, label: str, train, per_class: int = PER_CLASS) -> NeighbourVotes:
    """Fit on at most `per_class` labelled documents of each class (the bound on what is gathered)."""
    sample, sizes = labelled_sample(labels, label, train, per_class)
    chosen = {r["doc_id"]: r["label"] for r in sample.collect()}
    mine = docs.join(F.broadcast(sample.select("doc_id")), "doc_id").select(F.col("doc_id").cast("long"), "text")

    def run(batches):
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                counts = term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                codes = [np.flatnonzero(r) for r in counts]
                yield record_batch(SAMPLE, batch.column("doc_id").slice(a, b - a),
                                   [c.astype(np.uint16).tobytes() for c in codes],
                                   [r[c].astype(np.float32).tobytes() for r, c in zip(counts, codes)])

    # One row for a document that comes several times.
    rows = (mine.mapInArrow(run, SAMPLE).groupBy("doc_id")
            .agg(F.min(F.struct("codes", "counts")).alias("r")).orderBy("doc_id").collect())
    counts = np.zeros((len(rows), TERMS), np.float32)
    for out, r in zip(counts, rows):
        out[np.frombuffer(r["r"]["codes"], np.uint16)] = np.frombuffer(r["r"]["counts"], np.float32)
    known = np.array([chosen[r["doc_id"]] for r in rows], np.int64)
    weights = np.array([sizes[k] / max(1, (known == k).sum()) for k in known.tolist()], np.float64)
    total = sum(sizes.values())
    rate = sizes.get(1, 0) / total if total else 0.5
    return NeighbourVotes(counts, known, weights / max(weights.max(initial=1), 1e-9), rate)


def score_documents(docs: DataFrame, votes: NeighbourVotes) -> DataFrame:
    """`docs` (all its columns) with `score`, the probability of label 1; null texts count as empty.

    A column named `score` is replaced.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(votes)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd
        import pyarrow as pa

        data, offsets = kernels.column_bytes(pa.Array.from_pandas(texts, type=pa.large_string()))
        out = []
        for a, b in kernels.pieces(offsets):
            for c in range(a, b, ROWS_AT_ONCE):
                d = min(b, c + ROWS_AT_ONCE)
                out.append(sent.value.score(term_counts(data[offsets[c] : offsets[d]], offsets[c : d + 1] - offsets[c])))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn("score", score("text"))
