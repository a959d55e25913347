"""Column expressions for splitting text, and Arrow functions that map tokens to ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------------------------
# Special tokens in id order.
UNK, PAD, SOS, EOS = "[UNK]", "[PAD]", "[SOS]", "[EOS]"
SPECIALS = [UNK, PAD, SOS, EOS]
UNK_ID, PAD_ID, SOS_ID, EOS_ID = 0, 1, 2, 3
# A word character by the Unicode definition: letters, marks, digits, connectors, joiners.
WORD_CHARS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"
SPACE_CHARS = r"\s\x{0B}\x{85}\p{Z}"
WORD_PATTERN = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{SPACE_CHARS}]+"
# The published pre-split of byte-pair encoders.
PIECE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# -------------------------------------------------------------------------------------------

MARKER = r"\[(?:UNK|PAD|SOS|EOS)\]"
MARKED_WORD_PATTERN = (
    rf"{MARKER}|(?:(?!{MARKER})[{WORD_CHARS}])+|(?:(?!{MARKER})[^{WORD_CHARS}{SPACE_CHARS}])+"
)

MAX_CODE_POINT = 0x110000
SLICE = 1 << 20  # elements of a batch that a function works on at a time

# The Arrow functions below are declared nondeterministic so that a plan evaluates each of them
# once, instead of again for every filter on its result that is pushed below it.


def char_tokens(text: Column) -> Column:
    """Characters (code points) of `text`."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.split(text, "")
    )


def word_tokens(text: Column) -> Column:
    """Runs of word characters and runs of other visible characters."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def marked_word_tokens(text: Column) -> Column:
    """As `word_tokens`, but a special marker written in the text stays one token."""
    plain, marked = word_tokens(text), F.regexp_extract_all(text, F.lit(MARKED_WORD_PATTERN), F.lit(0))
    return F.when(text.rlike(MARKER), marked).otherwise(plain)


def piece_tokens(text: Column) -> Column:
    """Pieces that byte-pair merges never cross; joined again they give `text`."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def distinct_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct characters of one task's texts."""
    seen: set[str] = set()
    for batch in batches:
        texts = batch.column(0)
        for a, b in row_slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
            for text in texts.slice(a, b - a).to_pylist():
                seen.update(text or "")
    yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["token"])


def list_offsets(lengths: np.ndarray) -> pa.Array:
    ends = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=ends[1:])
    return pa.array(ends.astype(np.int32))


def list_lengths(col: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)


def row_slices(sizes: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `most` (SLICE) elements together, or of a single larger row."""
    ends, at, most = np.cumsum(sizes, dtype=np.int64), 0, most or SLICE
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, stop
        at = stop


def in_slices(col: pa.Array, kind: pa.DataType, work: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """`work` done on runs of list rows, so that what it holds beside its result is bounded."""
    parts = [work(col.slice(a, b - a)) for a, b in row_slices(list_lengths(col))]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@F.arrow_udf(T.StringType())
def ids_text(col: pa.Array) -> pa.Array:
    """An id array as text."""
    def spell(rows: pa.Array) -> pa.Array:
        words = pc.cast(pc.list_flatten(rows), pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(list_offsets(list_lengths(rows)), words), " ")

    return in_slices(col, pa.string(), spell)


ids_text = ids_text.asNondeterministic()


def token_to_id(tokens: list[str], ids: list[int], default: int):
    """Arrow function: array of tokens -> array of ids; `default` for tokens outside the table."""
    keys = pa.array(tokens, pa.string())
    values = pa.array(ids, pa.int32())

    @F.arrow_udf("array<int>")
    def encode(col: pa.Array) -> pa.Array:
        def look_up(rows: pa.Array) -> pa.Array:
            found = pc.index_in(pc.cast(pc.list_flatten(rows), pa.string()), value_set=keys)
            return pa.ListArray.from_arrays(list_offsets(list_lengths(rows)), pc.fill_null(values.take(found), default))

        return in_slices(col, pa.list_(pa.int32()), look_up)

    return encode.asNondeterministic()


def id_to_text(tokens: list[str], ids: list[int], hidden: list[int], sep: str):
    """Arrow function: array of ids -> tokens joined by `sep`, leaving out `hidden` ids."""
    keys = pa.array(ids, pa.int32())
    values = pa.array(tokens, pa.string())
    skip = pa.array(hidden, pa.int32())

    @F.arrow_udf("string")
    def decode(col: pa.Array) -> pa.Array:
        def spell(rows: pa.Array) -> pa.Array:
            flat = pc.cast(pc.list_flatten(rows), pa.int32())
            row = np.repeat(np.arange(len(rows)), list_lengths(rows))
            keep = pc.invert(pc.is_in(flat, value_set=skip)).to_numpy(zero_copy_only=False)
            kept = values.take(pc.index_in(flat.filter(pa.array(keep)), value_set=keys))
            if kept.null_count:
                raise ValueError("an id is not in the vocabulary")
            counts = np.bincount(row[keep], minlength=len(rows))
            return pc.binary_join(pa.ListArray.from_arrays(list_offsets(counts), kept), sep)

        return in_slices(col, pa.string(), spell)

    return decode.asNondeterministic()


def without(hidden: list[int]) -> Callable[[pa.Array], pa.Array]:
    """Arrow function: arrays of ids -> the same without `hidden` ids (and nulls, if any id is hidden)."""
    skip = pa.array(hidden, pa.int32())

    def leave(col: pa.Array) -> pa.Array:
        if not hidden:
            return col
        lengths, flat = list_lengths(col), pc.list_flatten(col)
        keep = pc.and_(pc.is_valid(flat), pc.invert(pc.is_in(flat, value_set=skip))).to_numpy(zero_copy_only=False)
        counts = np.bincount(np.repeat(np.arange(len(col)), lengths)[keep], minlength=len(col))
        return pa.ListArray.from_arrays(list_offsets(counts), flat.filter(pa.array(keep)))

    return leave


def char_to_id(chars: list[str], ids: list[int], unk_policy: int | Literal["error", "drop"]):
    """Arrow function: text -> array of character ids, by a table indexed with the code point."""
    points = np.array([ord(c) for c in chars], dtype=np.int64)
    table_ids = np.array(ids, dtype=np.int32)

    @F.arrow_udf("array<int>")
    def encode(col: pa.Array) -> pa.Array:
        table = np.full(MAX_CODE_POINT, -1, dtype=np.int32)
        table[points] = table_ids
        lengths = pc.fill_null(pc.utf8_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        made, at = np.empty(int(lengths.sum()), np.int32), 0
        for a, b in list(row_slices(lengths)):
            text = "".join(t for t in col.slice(a, b - a).to_pylist() if t)
            out = table[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
            unseen = out < 0
            if unseen.any():
                if unk_policy == "error":
                    raise ValueError("a character is not in the vocabulary")
                if unk_policy == "drop":
                    row = np.repeat(np.arange(b - a), lengths[a:b])
                    lengths[a:b] = np.bincount(row[~unseen], minlength=b - a)
                    out = out[~unseen]
                else:
                    out = np.where(unseen, np.int32(unk_policy), out)
            made[at : at + len(out)] = out
            at += len(out)
        return pa.ListArray.from_arrays(list_offsets(lengths), pa.array(made[:at], pa.int32()))

    return encode.asNondeterministic()


def id_to_chars(chars: list[str], ids: list[int]):
    """Arrow function: array of character ids -> text."""
    points = np.array([ord(c) for c in chars], dtype=np.uint32)
    table_ids = np.array(ids, dtype=np.int64)

    @F.arrow_udf("string")
    def decode(col: pa.Array) -> pa.Array:
        table = np.zeros(int(table_ids.max(initial=0)) + 1, dtype=np.uint32)
        table[table_ids] = points
        def spell(rows: pa.Array) -> pa.Array:
            flat = pc.list_flatten(rows).to_numpy(zero_copy_only=False)
            text = table[flat].tobytes().decode("utf-32-le")
            ends = np.cumsum(list_lengths(rows))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            return pa.array([text[a:b] for a, b in zip(starts, ends)], pa.string())

        return in_slices(col, pa.string(), spell)

    return decode.asNondeterministic()
