"""NumPy kernels that work on an Arrow text column without making Python strings.

All of them run inside tasks, on one record batch at a time and on about CHUNK bytes of it at once.
A word is a maximal run of bytes other than space and \\x09-\\x0D; a word never spans two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240601))
BYTE_KEYS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_KEYS = BYTE_KEYS.copy()
FOLDED_KEYS[65:91] = BYTE_KEYS[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Separators for tokens that are runs of letters, digits and non-ASCII characters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_POWERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of BASE and of its inverse, kept between calls up to one chunk."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, CHUNK + 1)
    up, down = np.full(size, BASE), np.full(size, INVERSE)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    if size == CHUNK + 1:
        _POWERS[:] = [up, down]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    if raw is None or not len(offsets):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes each; a longer row has a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = max(min(end, rows), row + 1)
        yield row, end
        row = end


def _stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most CHUNK bytes that end at a space where there is one."""
    at = 0
    while len(data) - at > CHUNK:
        spaces = np.flatnonzero(SPACE[data[at : at + CHUNK]])
        end = at + int(spaces[-1]) + 1 if len(spaces) else None
        if end is None:
            later = np.flatnonzero(SPACE[data[at:]])
            end = at + int(later[0]) + 1 if len(later) else len(data)
        yield at, end
        at = end
    yield at, len(data)


def _words_of(data, breaks, keys, gaps, prefix) -> tuple[np.ndarray, ...]:
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = ~gaps[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(keys[data] * up, out=sums[1:])
    upto = ends if prefix is None else np.minimum(starts + prefix, ends)
    return starts, ends, mix((sums[upto] - sums[starts]) * down[starts])


def words(
    data: np.ndarray, offsets: np.ndarray, fold: bool = False, gaps: np.ndarray = SPACE, prefix: int | None = None
) -> tuple[np.ndarray, ...]:
    """(starts, ends, hashes, bounds) of the words of the texts in `data`.

    Row r has the words bounds[r]:bounds[r + 1]. `fold` lower-cases A-Z. Equal words have equal
    64-bit hashes; different ones differ but for a chance of about 2^-60. `gaps` says which bytes
    separate words (spaces must be among them); with `prefix` only so many first bytes are hashed.
    """
    keys = FOLDED_KEYS if fold else BYTE_KEYS
    if len(data) <= CHUNK:
        starts, ends, hashes = _words_of(data, offsets, keys, gaps, prefix)
    else:
        found = []
        for a, b in _stretches(data):
            s, e, h = _words_of(data[a:b], offsets - a, keys, gaps, prefix)
            found.append((s + a, e + a, h))
        starts, ends, hashes = (np.concatenate(x) for x in zip(*found))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the `n`-word shingles of each row.

    A row with fewer words has its whole sequence as one; a row without words has none.
    """
    every = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        every += hashes[j : j + len(every)] * PLACES[j]
    every = mix(every)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(every[a : b - n + 1]))
        elif b > a:
            short = (hashes[a:b] * PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def windows(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` bytes from each position on, for all positions that have as many."""
    if len(data) < width:
        return np.empty(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_KEYS[data] * up[:-1], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: len(data) - width + 1])


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte position, 0 to len(data), how many code points begin before it."""
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=counts[1:])
    return counts


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 … counts[0]-1, 0 … counts[1]-1, and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
