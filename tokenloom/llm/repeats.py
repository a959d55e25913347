"""Removal of repeated passages: suffix buckets refined by the buckets of later offsets.

Every byte is removed that lies in a 200-byte string which also starts anywhere else. A full suffix
array is not needed for that: only suffixes that agree on 200 bytes matter, so the sort stops there.

1. Initial buckets: the 100-grams. Not all suffixes are entered: each 200-byte window is
   represented by the 100-gram in it with the smallest hash (leftmost of equals), about one in 51
   positions, and equal windows choose alike. Consecutive windows with one representative are a run.
   A run's bucket is refined by the bucket identifiers at later offsets (of the grams at its start,
   100 further on, and at its end), which together name its whole string of 200 to 300 bytes. Runs
   with an equal string are repeated in full. Runs alone in their initial bucket are done: none of
   their windows is repeated. Both results hold for all windows of the run without looking at them.
2. For the runs in between (the edges of repeated passages) the bucket of each window is the pair of
   the identifiers of its two 100-gram halves, reusing those of step 1. Windows that share a bucket
   are repeated.

Identifiers are 64-bit hashes of the strings, compounded from 100-gram to 200-gram; a wrong match has
a chance of about n^2 / 2^65 for n windows that get as far as step 2.

Texts travel as compressed blocks of about a megabyte of neighbouring rows. Inside a block equal
strings are sent once, so a passage that a third of all rows has arrives at its bucket once per
block. Blocks, keys and answers all move by hash; no task holds more than its share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch, stage, tasks_for

WIDTH, GRAM = 200, 100
SPAN = WIDTH - GRAM + 1
PLACE_BITS = 21
BLOCKS = "block long, ids array<long>, offsets binary, data binary"
KEYS = "bucket int, block long, keys binary, strings binary, places binary, many binary"
ANSWERS = "block long, places binary, found binary"
ALONE, EDGE, WHOLE, MODEL = 0, 1, 2, 3


def _blocks(docs: DataFrame) -> DataFrame:
    """The rows in compressed blocks, the same ones at every evaluation."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            for a, b in kernels.pieces(offsets):
                raw = data[offsets[a] : offsets[b]].tobytes()
                ids = batch.column("doc_id").slice(a, b - a)
                cuts = (offsets[a : b + 1] - offsets[a]).tobytes()
                name = hashlib.md5(raw + cuts + repr(ids.to_pylist()).encode()).digest()[:8]
                yield record_batch(BLOCKS, [int.from_bytes(name, "big", signed=True)], [ids.to_pylist()], [cuts],
                                   [press.compress(raw)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, BLOCKS)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(row["data"])
    return np.frombuffer(raw, np.uint8), np.frombuffer(row["offsets"], np.int64)


def _smallest(grams: np.ndarray) -> np.ndarray:
    """Position of the smallest of each SPAN neighbouring values, leftmost of equals."""
    n = len(grams) - SPAN + 1
    places = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    size = -(-len(grams) // SPAN) * SPAN
    marked = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    marked[: len(grams)] = (grams & ~low) | places
    rows = marked.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[SPAN - 1 : SPAN - 1 + n]) & low).astype(np.int64)


def _stretches(data: np.ndarray, offsets: np.ndarray):
    """(first position, grams, usable window starts) of successive parts; long texts come in several."""
    inside = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= WIDTH)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - WIDTH + 1, -1)
    usable = np.cumsum(inside)[:-1] > 0
    for a in range(0, max(0, len(data) - WIDTH + 1), kernels.CHUNK):
        part = data[a : a + kernels.CHUNK + WIDTH - 1]
        ok = usable[a : a + len(part) - WIDTH + 1]
        if ok.any():
            yield a, kernels.windows(part, GRAM), ok


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, gram, string): runs of window starts, with the identifiers of gram and string."""
    out = [[], [], [], []]
    for a, grams, ok in _stretches(data, offsets):
        chosen = _smallest(grams)
        fresh = ok.copy()
        fresh[1:] &= ~ok[:-1] | (chosen[1:] != chosen[:-1])
        first = np.flatnonzero(fresh)
        stop = ok.copy()
        stop[:-1] &= ~ok[1:] | (chosen[1:] != chosen[:-1])
        last = np.flatnonzero(stop)
        gram = grams[chosen[first]]
        string = kernels.mix(gram + kernels.mix(grams[first] * kernels.PLACES[0] + grams[first + GRAM] * kernels.PLACES[1]
                                                + grams[last + GRAM] * kernels.PLACES[2] + (last - first).astype(np.uint64)))
        for held, x in zip(out, (first + a, last + a, gram, string)):
            held.append(x)
    kinds = (np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(x) if x else np.empty(0, k) for x, k in zip(out, kinds))


def window_ids(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, identifier) of the windows flagged in `wanted`: the pair of their halves' identifiers."""
    places, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for a, grams, ok in _stretches(data, offsets):
        at = np.flatnonzero(ok & wanted[a : a + len(ok)])
        places.append(at + a)
        ids.append(kernels.mix(grams[at] * kernels.PLACES[3] + kernels.mix(grams[at + GRAM] * kernels.PLACES[4])))
    return np.concatenate(places), np.concatenate(ids)


def _flag(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether each of n positions lies in one of the ranges, ends included."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change)[:-1] > 0


def _send(bits: int, block: int, keys: np.ndarray, strings: np.ndarray | None, places: np.ndarray, many: np.ndarray):
    bucket = (keys >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    rows = [[], [], [], [], [], []]
    for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(bucket)].tolist()):
        own = order[a:b]
        for held, x in zip(rows, (int(bucket[a]), block, keys[own].tobytes(),
                                  b"" if strings is None else strings[own].tobytes(),
                                  places[own].astype(np.uint32).tobytes(), np.packbits(many[own]).tobytes())):
            held.append(x)
    return record_batch(KEYS, *rows)


def _receive(batches):
    parts = [[], [], [], [], []]
    for batch in batches:
        for r in batch.to_pylist():
            keys = np.frombuffer(r["keys"], np.uint64)
            parts[0].append(keys)
            parts[1].append(np.frombuffer(r["strings"], np.uint64))
            parts[2].append(np.full(len(keys), r["block"]))
            parts[3].append(np.frombuffer(r["places"], np.uint32))
            parts[4].append(np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(keys)))
    kinds = (np.uint64, np.uint64, np.int64, np.uint32, np.uint8)
    return tuple(np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds))


def _reply(block: np.ndarray, place: np.ndarray, found: np.ndarray):
    order = np.argsort(block, kind="stable")
    block, place, found = block[order], place[order], found[order]
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.empty(0, np.int64)
    rows = [[], [], []]
    for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(block)].tolist()):
        for held, x in zip(rows, (int(block[a]), place[a:b].tobytes(), found[a:b].astype(np.uint8).tobytes())):
            held.append(x)
    return record_batch(ANSWERS, *rows)


def _group_sums(sorted_by: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group number, total of its counts) for each element of a sorted array."""
    fresh = np.r_[True, sorted_by[1:] != sorted_by[:-1]] if len(sorted_by) else np.empty(0, bool)
    number = np.cumsum(fresh) - 1
    return number, np.bincount(number, counts)[number] if len(sorted_by) else counts


def _judge_runs(batches):
    """Which runs are repeated in full, which may be in part, and which others they must be held against."""
    gram, string, block, place, many = _receive(batches)
    order = np.lexsort((string, gram))
    gram, string, block, place = gram[order], string[order], block[order], place[order]
    counts = 1.0 + many[order]
    group, in_bucket = _group_sums(gram, counts)
    same = np.cumsum(np.r_[True, (gram[1:] != gram[:-1]) | (string[1:] != string[:-1])]) - 1 if len(gram) else group
    _, in_string = _group_sums(same, counts)
    found = np.where(in_string >= 2, WHOLE, np.where(in_bucket >= 2, EDGE, ALONE))
    # In a bucket with edges, one run of each repeated string is compared as well.
    edges = np.bincount(group, found == EDGE)[group] > 0 if len(group) else np.empty(0, bool)
    leads = np.r_[True, same[1:] != same[:-1]] if len(same) else np.empty(0, bool)
    found = np.where(leads & edges & (found == WHOLE), MODEL, found)
    kept = found != ALONE
    yield _reply(block[kept], place[kept], found[kept])


def _judge_windows(batches):
    key, _, block, place, many = _receive(batches)
    order = np.argsort(key, kind="stable")
    _, total = _group_sums(key[order], 1.0 + many[order])
    kept = order[total >= 2]
    yield _reply(block[kept], place[kept], np.full(len(kept), WHOLE))


def _answers(row: dict, name: str) -> tuple[np.ndarray, np.ndarray]:
    parts = row[name] or []
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    return (np.concatenate([np.frombuffer(p["places"], np.uint32) for p in parts]).astype(np.int64),
            np.concatenate([np.frombuffer(p["found"], np.uint8) for p in parts]))


def _judged(found: tuple[np.ndarray, ...], answers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What was found for each run of a block; runs of one string have the answer of the first.

    Blocks of equal rows share a name and so their answers: of several for one place the highest counts.
    """
    first, _, _, string = found
    out = np.zeros(len(first), np.uint8)
    places, said = answers
    np.maximum.at(out, np.searchsorted(first, places), said)
    _, lead, inverse = np.unique(string, return_index=True, return_inverse=True)
    return out[lead][inverse]


def repeated_spans(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of `docs` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256, removed.

    `removed` lists start and end of each removed run, in bytes. With `with_text` also `kept_text`, the
    bytes that are left, as text (a cut inside a character leaves U+FFFD). Null texts count as empty;
    texts under 200 bytes keep everything. Of equal texts of 200 bytes or more nothing is kept, nor of
    repeated rows: strings are judged on the input.
    """
    tasks, _ = tasks_for(docs)
    bits = min(30, max(4, (4 * tasks - 1).bit_length()))
    blocks = _blocks(docs)

    def send_runs(batches):
        for batch in batches:
            for row in batch.to_pylist():
                first, _, gram, string = runs(*_open(row))
                string, lead, count = np.unique(string, return_index=True, return_counts=True)
                yield _send(bits, row["block"], gram[lead], string, first[lead], count > 1)

    def gathered(answers: DataFrame, name: str) -> DataFrame:
        # At most one answer for each position of a block.
        return answers.groupBy("block").agg(F.collect_list(F.struct("places", "found")).alias(name))

    judged = stage(blocks.mapInArrow(send_runs, KEYS).repartition(tasks, "bucket").mapInArrow(_judge_runs, ANSWERS), "runs")
    judged = gathered(judged, "runs")

    def send_windows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = _open(row)
                found = runs(data, offsets)
                said = _judged(found, _answers(row, "runs"))
                # A string is sent once from a block; `many` says that the block has it again.
                open_ = (said == EDGE) | (said == MODEL)
                places, ids = window_ids(data, offsets, _flag(len(data), found[0][open_], found[1][open_]))
                ids, lead, count = np.unique(ids, return_index=True, return_counts=True)
                yield _send(bits, row["block"], ids, None, places[lead], count > 1)

    windows = (blocks.join(judged.hint("shuffle_hash"), "block").mapInArrow(send_windows, KEYS)
               .repartition(tasks, "bucket").mapInArrow(_judge_windows, ANSWERS))
    windows = gathered(stage(windows, "windows"), "windows")
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<int>"
              + (", kept_text string" if with_text else ""))

    def remove(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = _open(row)
                found = runs(data, offsets)
                said = _judged(found, _answers(row, "runs"))
                whole = said >= WHOLE
                starts = _flag(len(data), found[0][whole], found[1][whole])
                open_ = (said == EDGE) | (said == MODEL)
                places, ids = window_ids(data, offsets, _flag(len(data), found[0][open_], found[1][open_]))
                told, _ = _answers(row, "windows")
                if len(told):
                    # Equal windows of the block share the answer given for the first of them.
                    named = ids[np.searchsorted(places, told)]
                    starts[places[np.isin(ids, named)]] = True
                at = np.flatnonzero(starts)
                gone = _flag(len(data), at, at + WIDTH - 1) if len(at) else np.zeros(len(data), bool)
                out = [[] for _ in range(6 if with_text else 5)]
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = gone[a:b]
                    change = np.flatnonzero(np.diff(np.r_[False, own, False]))
                    left = data[a:b][~own].tobytes() if len(change) else data[a:b].tobytes()
                    made = [b - a, int(own.sum()), len(change) // 2, hashlib.sha256(left).hexdigest(), change.tolist()]
                    for held, x in zip(out, made + ([left.decode(errors="replace")] if with_text else [])):
                        held.append(x)
                yield record_batch(schema, row["ids"], *out)

    return (blocks.join(judged.hint("shuffle_hash"), "block", "left").join(windows.hint("shuffle_hash"), "block", "left")
            .mapInArrow(remove, schema))
