"""Toxic spans by a linear-chain conditional random field, summed to document scores.

Tokens are runs of letters, digits and non-ASCII characters. Their features are the lower-cased token
and its first 7 and 8 bytes. Documents only carry one label, so tokens are labelled from it: features
that toxic documents of a bounded sample have far more often than the others (`lexicon`) mark a token
of a toxic document as toxic; every other token is not.

The field has two states. Its weights (per feature, bias, transitions) are fitted by gradient ascent
on the likelihood of windows of labelled tokens. Scoring is exact forward-backward over whole texts:
tokens without a feature of the lexicon all have the same factor, so a run of k of them is the k-th
power of one 2 x 2 matrix, and only the other tokens are visited, for all texts of a batch at once.

A document's score comes from the marginals of its tokens (their expected number and the largest) by
a logistic curve fitted on labelled documents that the field was not fitted on. Tokens with a
marginal of MARGINAL or more are the offending offsets, neighbours as one span.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.quality import labelled_sample
from tokenloom.llm.shared import record_batch

PER_CLASS, FEATURES, WINDOW = 4096, 6000, 16
PREFIXES = (7, 8)
LIKELIER, LEAST, SURE = 6.0, 3, 3.5
MARGINAL = 0.5
STEPS = 80


def token_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, features, bounds): a row of feature hashes for each token."""
    starts, ends, whole, bounds = kernels.words(data, offsets, fold=True, gaps=kernels.NOT_LETTERS)
    columns = [whole]
    for k, size in enumerate(PREFIXES):
        part = kernels.words(data, offsets, fold=True, gaps=kernels.NOT_LETTERS, prefix=size)[2]
        # A token no longer than the prefix has it as its whole; 0 is no feature.
        columns.append(np.where(ends - starts > size, kernels.mix(part + kernels.PLACES[k]), np.uint64(0)))
    return starts, ends, np.stack(columns, 1), bounds


def _emissions(model: ToxicField, features: np.ndarray) -> np.ndarray:
    """Weight of the toxic state for each token; 0 for a token without a feature of the lexicon."""
    if not len(model.names):
        return np.zeros(len(features))
    at = np.minimum(np.searchsorted(model.names, features), len(model.names) - 1)
    return np.where(model.names[at] == features, model.weights[at], 0.0).sum(1)


@dataclass
class ToxicField:
    """Weights of the field; `transitions[a, b]` is the log factor from state a to state b."""

    names: np.ndarray
    weights: np.ndarray
    bias: float
    transitions: np.ndarray
    curve: np.ndarray

    def marginals(self, scores: np.ndarray, positions: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """P(toxic) of the given tokens of many texts.

        `scores` are their emissions, `positions` their numbers within their text and `rows` the text,
        ascending. Texts begin and end in the field's long-run state.
        """
        step = np.exp(self.transitions) * np.array([1.0, np.exp(self.bias)])[None, :]
        values, right = np.linalg.eig(step)
        order = np.argsort(-values.real)
        values, right = values.real[order], right.real[:, order]
        left = np.linalg.inv(right)
        ratio = values[1] / values[0]

        def far(vector, gap, forward):
            """`vector` after `gap` plain tokens, up to a factor."""
            decay = ratio ** gap
            a, b = (right, left) if forward else (left.T, right.T)
            x = vector @ a
            return np.stack([x[:, 0], x[:, 1] * decay], 1) @ b

        n = len(scores)
        if not n:
            return np.empty(0)
        first = np.r_[True, rows[1:] != rows[:-1]]
        starts = np.flatnonzero(first)
        lengths = np.diff(np.r_[starts, n])
        gaps = np.zeros(n, np.int64)
        gaps[1:] = positions[1:] - positions[:-1] - 1
        factor = np.stack([np.ones(n), np.exp(np.clip(self.bias + scores, -60, 60))], 1)
        alpha, beta = np.empty((n, 2)), np.empty((n, 2))
        trans = np.exp(self.transitions)
        begin, end = np.abs(left[0]), np.abs(right[:, 0])
        longest = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[longest], lengths[longest]
        steps = int(lengths[0])
        alive = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts with more than t tokens
        for t in range(steps):
            i = starts[: alive[t]] + t
            before = np.broadcast_to(begin, (len(i), 2)) if t == 0 else far(alpha[i - 1], gaps[i], True)
            a = np.maximum(before @ trans * factor[i], 1e-300)
            alpha[i] = a / a.sum(1, keepdims=True)
        for t in range(steps - 1, -1, -1):
            i = starts[: alive[t]] + t
            b = np.broadcast_to(end, (len(i), 2)).copy()
            more = lengths[: alive[t]] > t + 1
            j = i[more] + 1
            b[more] = far((beta[j] * factor[j]) @ trans.T, gaps[j], False)
            b = np.maximum(b, 1e-300)
            beta[i] = b / b.sum(1, keepdims=True)
        both = alpha * beta
        return both[:, 1] / both.sum(1)

    def tag(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, marginals, rows) of the tokens with a feature, and the tokens per text."""
        starts, ends, features, bounds = token_features(data, offsets)
        scores = _emissions(self, features)
        at = np.flatnonzero(scores)
        rows = np.searchsorted(bounds, at, "right") - 1
        chance = self.marginals(scores[at], at - bounds[rows], rows)
        return starts[at], ends[at], chance, rows, np.diff(bounds), at

    def summary(self, chance: np.ndarray, rows: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Per text: 1, log of the expected number of toxic tokens, the largest marginal, log of the length.

        The length counts only together with toxic tokens: long texts have some by chance.
        """
        total, most = np.zeros(len(tokens)), np.zeros(len(tokens))
        np.add.at(total, rows, chance)
        np.maximum.at(most, rows, chance)
        return np.stack([np.ones(len(tokens)), np.log1p(total), most, most * np.log1p(tokens) / 10], 1)

    def document_scores(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.curve, -30, 30)))


def _fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1]) * max(1.0, w.sum() / 100) * np.array([0.01, 1, 1, 1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        beta = beta + np.linalg.solve(hessian, x.T @ (w * (y - p)) - ridge @ beta)
    return beta


def fit_chain(features: np.ndarray, states: np.ndarray, weights: np.ndarray, size: int, steps: int = STEPS):
    """Gradient ascent on the likelihood of windows.

    `features` (windows, tokens, features) are numbers below `size`, or `size` for none; `states`
    are 0 or 1; windows carry `weights`. Returns (feature weights, bias, transitions).
    """
    theta, bias, trans = np.zeros(size + 1), -3.0, np.zeros((2, 2))
    scale = weights.sum()
    moments = [np.zeros(size + 1), 0.0, np.zeros((2, 2))]
    squares = [np.zeros(size + 1), 0.0, np.zeros((2, 2))]
    windows, length = states.shape
    used = features.reshape(-1)
    seen_by = np.bincount(used, np.repeat(np.repeat(weights, length), features.shape[2]), size + 1)
    for step in range(1, steps + 1):
        theta[size] = 0
        emission = theta[features].sum(2) + bias
        factor = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -40, 40))], 2)
        t = np.exp(trans)
        alpha, beta = np.empty((length, windows, 2)), np.empty((length, windows, 2))
        for k in range(length):
            a = factor[:, k] if k == 0 else (alpha[k - 1] @ t) * factor[:, k]
            alpha[k] = a / a.sum(1, keepdims=True)
        beta[length - 1] = 0.5
        for k in range(length - 2, -1, -1):
            b = (beta[k + 1] * factor[:, k + 1]) @ t.T
            beta[k] = b / b.sum(1, keepdims=True)
        both = alpha * beta
        chance = (both[:, :, 1] / both.sum(2)).T
        off = (states - chance) * weights[:, None]
        pairs = np.zeros((2, 2))
        for k in range(length - 1):
            joint = alpha[k][:, :, None] * t[None] * (beta[k + 1] * factor[:, k + 1])[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs -= (joint * weights[:, None, None]).sum(0)
            for a in (0, 1):
                for b in (0, 1):
                    pairs[a, b] += weights[(states[:, k] == a) & (states[:, k + 1] == b)].sum()
        slopes = [np.bincount(used, np.repeat(off.reshape(-1), features.shape[2]), size + 1) / np.maximum(seen_by, 1e-9)
                  - 0.01 * theta, off.sum() / scale, pairs / scale]
        for i, (slope, rate) in enumerate(zip(slopes, (0.3, 0.1, 0.1))):
            moments[i] = 0.9 * moments[i] + 0.1 * slope
            squares[i] = 0.99 * squares[i] + 0.01 * slope * slope
            move = rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-6)
            if i == 0:
                theta += move
            elif i == 1:
                bias += float(move)
            else:
                trans = trans + move
        trans[0, 0] = 0.0
    return theta[:size], bias, trans


def _lexicon(mine: DataFrame, limit: int, sizes: dict[int, int]) -> np.ndarray:
    """Features that toxic documents have LIKELIER times as often, by at least SURE deviations.

    `mine` has text and label (0 or 1); counts are documents of either class with the feature.
    """
    def count(batches):
        for batch in batches:
            label = np.asarray(batch.column("label"))
            data, offsets = kernels.column_bytes(batch.column("text"))
            found, toxic = [], []
            for a, b in kernels.pieces(offsets):
                _, _, features, bounds = token_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for k in range(b - a):
                    own = np.unique(features[bounds[k] : bounds[k + 1]])
                    found.append(own[own != 0])
                    toxic.append(np.full(len(found[-1]), label[a + k]))
            if found:
                name, at = np.unique(np.concatenate(found), return_inverse=True)
                bad = np.bincount(at, np.concatenate(toxic), len(name)).astype(np.int64)
                yield record_batch("name long, toxic long, clean long", name.view(np.int64), bad,
                                   np.bincount(at, minlength=len(name)) - bad)

    counts = (mine.select("text", "label").mapInArrow(count, "name long, toxic long, clean long")
              .groupBy("name").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    toxic, clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    rate = (F.col("c") + 0.5) / clean
    wanted = rate * toxic
    z = (F.col("t") - wanted) / F.sqrt(wanted + 0.25)
    rows = (counts.filter((F.col("t") >= LEAST) & (F.col("t") >= LIKELIER * wanted) & (z >= SURE))
            .orderBy(z.desc(), "name").limit(limit).select("name").collect())
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, label: str, train, per_class: int = PER_CLASS) -> ToxicField:
    """Fit on at most `per_class` labelled documents of each class; a quarter of them, chosen by hash,
    serves the curve only. What reaches the driver is bounded by the sample."""
    sample, sizes = labelled_sample(labels, label, train, per_class)
    mine = docs.join(F.broadcast(sample), "doc_id").select(F.col("doc_id").cast("long"), "text", "label")
    curve = F.crc32(F.concat(F.lit("curve"), F.col("doc_id").cast("string"))) % 4 == 0
    held = {r["label"]: r["count"] for r in sample.filter(~curve).groupBy("label").count().collect()}
    names = _lexicon(mine.filter(~curve), FEATURES, held)
    model = ToxicField(names, np.zeros(len(names)), -3.0, np.zeros((2, 2)), np.zeros(4))
    width = 1 + len(PREFIXES)

    def windows(batches):
        for batch in batches:
            label = np.asarray(batch.column("label"))
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                _, _, features, bounds = token_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = np.minimum(np.searchsorted(names, features), max(0, len(names) - 1))
                number = np.where(names[at] == features, at, len(names)) if len(names) else np.full(features.shape, 0)
                rows = [[], [], []]
                for k in range(b - a):
                    own = number[bounds[k] : bounds[k + 1]]
                    blocks = -(-len(own) // WINDOW)
                    full = np.full((blocks * WINDOW, width), len(names))
                    full[: len(own)] = own
                    for j, block in enumerate(full.reshape(blocks, WINDOW, width)):
                        active = (block < len(names)).any()
                        if active or j % 16 == 0:  # of the windows without a feature one in 16 stands for all
                            rows[0].append(int(label[a + k]))
                            rows[1].append(1.0 if active else 16.0)
                            rows[2].append(block.astype(np.int16).tobytes())
                yield record_batch("label int, weight double, window binary", *rows)

    gathered = (mine.filter(~curve).mapInArrow(windows, "label int, weight double, window binary")
                .groupBy("label", "window").agg(F.sum("weight").alias("weight")).collect())
    share = {k: sizes[k] / max(1, held.get(k, 0)) for k in sizes}
    if gathered and len(names):
        features = np.stack([np.frombuffer(r["window"], np.int16).reshape(WINDOW, width) for r in gathered]).astype(np.int64)
        toxic = np.array([r["label"] for r in gathered])
        states = (features < len(names)).any(2) & (toxic == 1)[:, None]
        weights = np.array([r["weight"] * share[r["label"]] for r in gathered])
        model.weights, model.bias, model.transitions = fit_chain(features, states.astype(float), weights, len(names))
    sent = mine.sparkSession.sparkContext.broadcast(model)

    def summaries(batches):
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                _, _, chance, rows, tokens, _ = sent.value.tag(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                x = sent.value.summary(chance, rows, tokens)
                yield record_batch(SEEN, batch.column("label").slice(a, b - a).cast(pa.int32()), *x[:, 1:].T)

    seen = mine.filter(curve).mapInArrow(summaries, SEEN).collect()
    x = np.array([[1.0, r["total"], r["most"], r["long"]] for r in seen]).reshape(-1, 4)
    y = np.array([float(r["label"]) for r in seen])
    held = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weights = np.array([sizes[int(k)] / held[int(k)] for k in y])
    model.curve = _fit_curve(x, y, weights) if len(seen) else np.array([-2.0, 1.0, 2.0, 0.0])
    return model


SEEN = "label int, total double, most double, long double"
OUT = "doc_id long, score double, spans string"


def score_documents(docs: DataFrame, model: ToxicField) -> DataFrame:
    """(doc_id, score, spans) of every row; spans are start:end:marginal in code points.

    Null and empty texts have no spans and the score of a text without toxic tokens. Repeated rows give
    repeated results; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, ends, chance, rows, tokens, at = sent.value.tag(part, cuts)
                scores = sent.value.document_scores(sent.value.summary(chance, rows, tokens))
                high = np.flatnonzero(chance >= MARGINAL)
                spans = [""] * (b - a)
                if len(high):
                    points = kernels.code_points(part)
                    joined: dict[int, list] = {}
                    for i in high.tolist():
                        r = int(rows[i])
                        first = points[cuts[r]]
                        own = joined.setdefault(r, [])
                        if own and own[-1][3] + 1 == at[i]:
                            own[-1] = [own[-1][0], int(points[ends[i]] - first), max(own[-1][2], chance[i]), at[i]]
                        else:
                            own.append([int(points[starts[i]] - first), int(points[ends[i]] - first), chance[i], at[i]])
                    for r, own in joined.items():
                        spans[r] = ",".join(f"{s}:{e}:{c:.3f}" for s, e, c, _ in own)
                yield record_batch(OUT, batch.column("doc_id").slice(a, b - a), scores, spans)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)
