"""Expressions over arrays of numbers, and NumPy kernels that pool bounded sequences."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.text import in_slices, list_lengths, list_offsets


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also when used inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def standardized(
    v: Column,
    variant: Literal["sample_inside", "sample_outside", "population"],
    eps: float = 1e-5,
    gamma: float = 1.0,
    beta: float = 0.0,
) -> Column:
    """A vector with mean 0 and deviation 1, in the three common ways.

    sample_inside: sample variance, eps under the root. sample_outside: eps added to the sample
    deviation. population: population variance, eps under the root.
    """
    n = F.size(v)

    def scale(squares: Column) -> Column:
        if variant == "population":
            return F.sqrt(squares / n + eps)
        deviation = squares / (n - 1)
        return F.sqrt(deviation + eps) if variant == "sample_inside" else F.sqrt(deviation) + eps

    def centered(c: Column) -> Column:
        width = scale(total(F.transform(c, lambda x: x * x)))
        return bind(width, lambda s: F.transform(c, lambda x: x / s * gamma + beta))

    return bind(bind(total(v) / n, lambda m: F.transform(v, lambda x: x - m)), centered)


def masked_softmax(scores: Column, visible: Column) -> Column:
    """Weights over the first `visible` scores; the rest get 0."""
    seen = F.slice(scores, F.lit(1), visible)
    powers = bind(F.array_max(seen), lambda top: F.transform(seen, lambda s: F.exp(s - top)))
    weights = bind(powers, lambda p: bind(total(p), lambda z: F.transform(p, lambda x: x / z)))
    return F.concat(weights, F.array_repeat(F.lit(0.0), F.size(scores) - visible))


def position_vector(pos: Column, d: int) -> Column:
    """The usual sines (even places) and cosines (odd places) of a position."""
    rates = [math.exp(-(i - i % 2) * math.log(10_000.0) / d) for i in range(d)]
    return F.array(*[(F.cos if i % 2 else F.sin)(pos * F.lit(r)) for i, r in enumerate(rates)])


def _matrices(col: pa.Array) -> list[np.ndarray]:
    """One matrix per row of an array of equally long vectors."""
    out = []
    for row in col:
        vectors = row.values
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        out.append(flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0)))
    return out


def _project(m: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    return m if w is None else m @ w


ROWS_AT_ONCE = 16_384

PART = "array<struct<t:bigint,m:double,s:double,acc:array<double>,e:array<double>>>"


def _rows(matrices: list[np.ndarray]) -> pa.Array:
    """All rows of the matrices as one array of arrays."""
    flat = np.concatenate([m.ravel() for m in matrices]) if matrices else np.zeros(0)
    widths = np.concatenate([np.full(len(m), m.shape[1]) for m in matrices]) if matrices else np.zeros(0)
    return pa.ListArray.from_arrays(list_offsets(widths.astype(np.int64)), pa.array(flat, pa.float64()))


def block_pool(scale: float | None, w_q, w_k, w_v, causal: bool, weights: bool):
    """Arrow function: a block of queries and a block of keys, with their places -> a part per query.

    A part is (place, largest score, sum of weights, weighted sum of values, weights), relative to the
    largest score; without `weights` the last is empty. Keys with flag 0, and for `causal` later ones,
    have no weight; a query that sees no key has -inf as its largest score.
    """

    @F.arrow_udf(PART)
    def pool(at: pa.Array, queries: pa.Array, key_at: pa.Array, keys: pa.Array, flags: pa.Array) -> pa.Array:
        tops, sums, means, kept = [], [], [], []
        for t, q, u, m, seen in zip(at, _matrices(queries), key_at, _matrices(keys), flags):
            q, k, v = _project(q, w_q), _project(m, w_k), _project(m, w_v)
            factor = 1 / math.sqrt(max(1, q.shape[1])) if scale is None else scale
            hidden = np.broadcast_to(np.asarray(seen.values) == 0, (len(q), len(k)))
            if causal:
                hidden = hidden | (np.asarray(u.values)[None, :] > np.asarray(t.values)[:, None])
            scores = np.where(hidden, -np.inf, q @ k.T * factor)
            top = scores.max(axis=1, initial=-np.inf)
            e = np.where(hidden, 0.0, np.exp(scores - np.where(np.isfinite(top), top, 0.0)[:, None]))
            tops.append(top)
            sums.append(e.sum(axis=1))
            means.append(e @ v)
            kept.append(e if weights else e[:, :0])
        whole = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
        fields = [pc.list_flatten(at).cast(pa.int64()), whole(tops), whole(sums), _rows(means), _rows(kept)]
        rows = pa.StructArray.from_arrays(fields, ["t", "m", "s", "acc", "e"])
        return pa.ListArray.from_arrays(list_offsets(list_lengths(at)), rows)

    return pool.asNondeterministic()


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = pc.list_flatten(batch.column("v")).to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _codes(batch: pa.RecordBatch, keys: list[str]) -> list[np.ndarray]:
    """Per key column a number for each row, equal where the values are."""
    return [pc.fill_null(batch.column(k).dictionary_encode(null_encoding="encode").indices, -1).to_numpy(zero_copy_only=False) for k in keys]


def _runs(codes: list[np.ndarray]) -> np.ndarray:
    """Rows at which the codes change."""
    fresh = np.ones(len(codes[0]), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
    return np.flatnonzero(fresh)


def _sums(batch: pa.RecordBatch, keys: list[str], rows: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(rows)) for k in keys), _rows([matrix])], [*keys, "v"])


def fold_vectors(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each group, one batch at a time."""
    for batch in batches:
        if batch.num_rows:
            codes = _codes(batch, keys)
            order = np.lexsort(codes)
            starts = _runs([c[order] for c in codes])
            yield _sums(batch, keys, order[starts], np.add.reduceat(_matrix(batch)[order], starts, axis=0))


def fold_sorted_vectors(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each group over all batches of a task, whose rows are sorted by group."""
    held, key = None, None  # the last group so far, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _runs(_codes(batch, keys))
        sums = np.add.reduceat(_matrix(batch), starts, axis=0)
        values = lambda row: tuple(batch.column(k)[row].as_py() for k in keys)
        if held is not None:
            if values(0) == key:
                sums[0] += _matrix(held)[0]
            else:
                yield held
        done = _sums(batch, keys, starts, sums)
        held, key = done.slice(len(starts) - 1), values(int(starts[-1]))
        if len(starts) > 1:
            yield done.slice(0, len(starts) - 1)
    if held is not None:
        yield held


def running_sorted_vectors(batches: Iterator[pa.RecordBatch], keys: list[str], out: list[str]) -> Iterator[pa.RecordBatch]:
    """Running sums within each group, from the `carry` of its first row (none: zeros); rows are sorted."""
    key, total = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        matrix = _matrix(batch).astype(np.float64)
        starts = _runs(_codes(batch, keys)).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            here = tuple(batch.column(k)[a].as_py() for k in keys)
            if here != key:
                carry = batch.column("carry")[a].as_py()
                key, total = here, np.array(carry) if carry else np.zeros(matrix.shape[1])
            matrix[a:b] = np.cumsum(matrix[a:b], axis=0) + total
            total = matrix[b - 1].copy()
        yield _sums(batch, out, np.arange(batch.num_rows), matrix)


def pooled_vectors(table: pa.Table, d: int, must_exist: bool):
    """Arrow function: array of ids -> mean of their rows of `table` (id, v); zeros for no ids."""
    known = table.column("id").to_numpy().astype(np.int64)
    order = np.argsort(known)
    known = known[order]
    flat = pc.list_flatten(table.column("v").combine_chunks()).to_numpy(zero_copy_only=False)
    vectors = np.vstack([np.zeros(d), flat.reshape(-1, d)[order]]) if len(known) else np.zeros((1, d))

    def pool_rows(ids: pa.Array) -> pa.Array:
        sizes, wanted = list_lengths(ids), pc.list_flatten(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, which = np.unique(wanted, return_inverse=True)
        at = np.searchsorted(known, kinds)
        hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == kinds) if len(known) else np.zeros(len(kinds), bool)
        if must_exist and not hit.all():
            raise ValueError(f"no vector for id {kinds[~hit][0]}")
        # Distinct ids of a row with how often they come, so that a long row costs no more than its kinds.
        row = np.repeat(np.arange(len(ids)), sizes)
        pairs, n = np.unique(row * max(1, len(kinds)) + which, return_counts=True)
        row, kind = pairs // max(1, len(kinds)), pairs % max(1, len(kinds))
        out = np.zeros((len(ids), d))
        for a in range(0, len(row), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            np.add.at(out, row[part], vectors[np.where(hit, at + 1, 0)[kind[part]]] * n[part, None])
        return _rows([out / np.maximum(sizes, 1)[:, None]])

    @F.arrow_udf("array<double>")
    def pool(ids: pa.Array) -> pa.Array:
        return in_slices(ids, pa.list_(pa.float64()), pool_rows)

    return pool.asNondeterministic()
