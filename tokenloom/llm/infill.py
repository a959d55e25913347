"""Fill-in-middle: texts cut into prefix, middle and suffix at hashed token places, and put together anew.

A token is a run of A-Z and a-z or any other single code point. Documents share long passages, so their
tokens are not counted text by text: a rolling hash over WIDTH bytes cuts every text into chunks whose
bounds depend on the content around them alone, and a chunk met before has its summary (code points,
tokens, whether it begins and ends with a letter) in a cache. The cache is keyed by the chunk's bytes, so a
hit is a verified copy. Summaries combine from left to right: two chunks that meet between letters share
one token. Their running sums give a document's token count, and a cut is found by looking for the chunk
that holds it; only that chunk is scanned again.

Rows are independent of each other, so no row moves and a lost task is simply run again. Null and empty
texts are empty plain rows. A null doc_id hashes as an empty one. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch

# ---- fixed values: the markers of the parts, and how many of a hundred rows are cut, and in which order.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
# --------------------------------------------------------------------------------------------------

WIDTH = 32  # bytes under the rolling hash
MASK = np.uint64((1 << 10) - 1)  # a chunk ends about every kilobyte
LEAST_GAP, MOST_GAP = 64, 8192  # bounds of a chunk in bytes
CACHE_BYTES = 32 << 20  # text held by each of the cache's two generations

ROWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def _token_starts(data: np.ndarray) -> np.ndarray:
    """For each byte whether a token starts there; the first byte always does."""
    letter = LETTER[data]
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


class ChunkCache:
    """Summaries of chunks by their bytes, in two generations of CACHE_BYTES of text each."""

    def __init__(self):
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.held = self.hits = self.misses = 0

    def summaries(self, chunks: list[bytes]) -> np.ndarray:
        """(tokens, code points, begins with a letter, ends with a letter) per chunk."""
        found, fresh = [], {}
        for chunk in chunks:
            known = self.young.get(chunk)
            if known is None:
                known = self.old.get(chunk)
                if known is not None:
                    self._keep(chunk, known)
                else:
                    fresh[chunk] = None
            found.append(known)
        self.hits += len(chunks) - len(fresh)
        self.misses += len(fresh)
        if fresh:
            for chunk, known in zip(fresh, self._count(list(fresh))):
                fresh[chunk] = known
                self._keep(chunk, known)
            found = [fresh[c] if k is None else k for c, k in zip(chunks, found)]
        return np.array(found, np.int64).reshape(-1, 4)

    def _keep(self, chunk: bytes, known: tuple) -> None:
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = known
        self.held += len(chunk)

    @staticmethod
    def _count(chunks: list[bytes]) -> list[tuple]:
        data = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        begins = np.r_[0, ends[:-1]]
        starts = _token_starts(data)
        starts[begins] = True
        points = (data & 0xC0) != 0x80
        return list(zip(np.add.reduceat(starts, begins, dtype=np.int64).tolist(),
                        np.add.reduceat(points, begins, dtype=np.int64).tolist(),
                        LETTER[data[begins]].tolist(), LETTER[data[ends - 1]].tolist()))


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin in the texts of `data`, sorted; every text that is not empty begins one.

    A bound is a place whose last WIDTH bytes, all of the same text, hash to 0 under MASK. Of bounds that
    follow each other closely the first counts; long stretches are cut every MOST_GAP bytes.
    """
    begins = np.unique(offsets[:-1][np.diff(offsets) > 0])
    if not len(begins):
        return begins
    places = np.flatnonzero((kernels.windows(data, WIDTH) & MASK) == 0) + WIDTH
    places = places[places < len(data)]
    text = begins[np.searchsorted(begins, places, "right") - 1]
    places = places[(places - text >= WIDTH) & ((data[places] & 0xC0) != 0x80)]
    places = places[np.diff(places, prepend=-LEAST_GAP) >= LEAST_GAP]
    bounds = np.union1d(begins, places)
    sizes = np.diff(np.r_[bounds, len(data)])
    extra = np.maximum(sizes - 1, 0) // MOST_GAP
    if extra.any():
        more = np.repeat(bounds, extra) + (kernels.ranges(extra) + 1) * MOST_GAP
        # Back to where a code point begins: at most three bytes.
        for _ in range(3):
            more = more - ((data[more] & 0xC0) == 0x80)
        bounds = np.union1d(bounds, more)
    return bounds


class Cutter:
    """Token counts and cut places of the texts of one batch piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cache: ChunkCache):
        self.data, self.offsets = data, offsets
        self.bounds = chunk_bounds(data, offsets)
        self.ends = np.r_[self.bounds[1:], len(data)].astype(np.int64)
        raw = data.tobytes()
        found = cache.summaries([raw[a:b] for a, b in zip(self.bounds.tolist(), self.ends.tolist())])
        # A chunk that goes on with its neighbour's last word begins no token.
        self.joined = np.zeros(len(found), bool)
        inside = ~np.isin(self.bounds[1:], offsets)
        self.joined[1:] = (found[1:, 2] == 1) & (found[:-1, 3] == 1) & inside
        self.tokens = np.r_[0, np.cumsum(found[:, 0] - self.joined)]
        self.points = np.r_[0, np.cumsum(found[:, 1])]
        self.first = np.searchsorted(self.bounds, offsets)  # chunks of row r: first[r]:first[r + 1]

    def count(self, row: int) -> int:
        return int(self.tokens[self.first[row + 1]] - self.tokens[self.first[row]])

    def place(self, row: int, token: int) -> tuple[int, int]:
        """(byte, code point) inside the row's text where its `token`-th token starts; the end for the last."""
        a, b = int(self.first[row]), int(self.first[row + 1])
        if token == self.tokens[b] - self.tokens[a]:
            return int(self.offsets[row + 1] - self.offsets[row]), int(self.points[b] - self.points[a])
        want = token + int(self.tokens[a])
        chunk = a + int(np.searchsorted(self.tokens[a + 1 : b + 1], want, "right"))
        part = self.data[self.bounds[chunk] : self.ends[chunk]]
        starts = _token_starts(part)
        starts[0] = not self.joined[chunk]
        at = int(np.flatnonzero(starts)[want - int(self.tokens[chunk])])
        before = int(np.count_nonzero((part[:at] & 0xC0) != 0x80))
        return (int(self.bounds[chunk] - self.offsets[row]) + at,
                int(self.points[chunk] - self.points[a]) + before)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four whole numbers below 2^32 from a document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def _transform(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, cache: ChunkCache, seed: int) -> pa.RecordBatch:
    cutter = Cutter(data, offsets, cache)
    raw = data.tobytes()
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    marked = any(x in raw for x in (p, s, m))
    rows: list[list] = [[], [], [], [], []]
    for r, doc_id in enumerate(ids.to_pylist()):
        text = raw[offsets[r] : offsets[r + 1]]
        n = cutter.count(r)
        h = draws(doc_id, seed)
        plain = not text or h[2] % 100 >= CUT_PERCENT or (marked and any(x in text for x in (p, s, m)))
        if plain:
            new = (n, "plain", None, None, text)
        else:
            (a, chars_a), (b, chars_b) = (cutter.place(r, k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
            if h[3] % 100 < SUFFIX_FIRST_PERCENT:
                new = (n, "spm", chars_a, chars_b - chars_a, b"".join((s, text[b:], p, text[:a], m, text[a:b])))
            else:
                new = (n, "psm", chars_a, chars_b - chars_a, b"".join((p, text[:a], s, text[b:], m, text[a:b])))
        for held, x in zip(rows, new):
            held.append(x)
    output = pa.array(rows.pop(), pa.binary()).cast(pa.string())
    return record_batch(ROWS, ids, *rows, output)


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of `docs` (doc_id, text).

    `n` counts tokens; `form` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); the
    two lengths are code points, null for plain rows, whose output is the text itself. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                yield _transform(batch.column("doc_id").slice(a, b - a), data[offsets[a] : offsets[b]],
                                 offsets[a : b + 1] - offsets[a], cache, seed)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ROWS)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. The text holds no marker, so each marker is found where it was put."""
    size = len(PREFIX)
    rest = F.length(output)

    def between(begin: Column, end: Column) -> Column:
        return F.substring(output, begin + size, end - begin - size)

    def after(begin: Column) -> Column:
        return F.substring(output, begin + size, rest)

    p, s, m = (F.instr(output, F.lit(x)) for x in (PREFIX, SUFFIX, MIDDLE))
    psm = F.concat(between(p, s), after(m), between(s, m))
    spm = F.concat(between(p, m), after(m), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
