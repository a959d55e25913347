"""Cutting texts into words inside tasks: the words of `word_tokens`, many texts at a time."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import (
    MARKER,
    MAX_CODE_POINT,
    SPACE_CHARS,
    WORD_CHARS,
    list_lengths,
    list_offsets,
    row_slices,
)

SPACE, WORD, OTHER = 0, 1, 2
COUNTED = 1 << 23  # bytes of text whose words are counted together

Cutter = Callable[[pa.Array], pa.ListArray]

_KINDS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def char_kinds(spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """Code points at which runs of one kind begin, and their kinds, by the patterns and the JVM's Unicode table."""
    app = spark.sparkContext.applicationId
    if app not in _KINDS:
        points = spark.range(MAX_CODE_POINT).filter("id < 55296 or id > 57343")  # without surrogates
        # After a letter, so that no code point is taken for a byte order mark.
        text = F.decode(F.unhex(F.concat(F.lit("00000061"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32")
        kind = F.when(text.rlike(f"a[{WORD_CHARS}]"), WORD).when(text.rlike(f"a[{SPACE_CHARS}]"), SPACE).otherwise(OTHER)
        made = points.select("id", kind.cast("tinyint").alias("kind")).toArrow()
        kinds = np.full(MAX_CODE_POINT, OTHER, np.int8)
        kinds[made.column("id").to_numpy()] = made.column("kind").to_numpy()
        begins = np.flatnonzero(np.diff(kinds, prepend=-1))
        _KINDS[app] = begins, kinds[begins]
    return _KINDS[app]


def _words_of(col: pa.Array, table: np.ndarray, marked: bool) -> pa.ListArray:
    texts = [t.decode("utf-8", "replace") if t else "" for t in pc.cast(col, pa.binary()).to_pylist()]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    starts = np.concatenate([[0], ends[:-1]])
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kinds = table[points]
    begins = np.empty(len(points), bool)
    begins[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins[starts[starts < ends]] = True
    for found in re.finditer(MARKER, whole) if marked else ():
        a, b = found.span()
        if b <= ends[np.searchsorted(ends, a, "right")]:  # not over the end of a text
            begins[a + 1 : b] = False
            begins[a : b + 1 : b - a] = True
    shown = kinds != SPACE
    first = np.flatnonzero(begins & shown)
    shown_points = points[shown]
    data = shown_points.tobytes().decode("utf-32-le").encode()
    widths = 1 + (shown_points >= 0x80).astype(np.int8) + (shown_points >= 0x800) + (shown_points >= 0x10000)
    upto = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    places = np.cumsum(shown)[first] - 1  # of the words' first characters among those shown
    offsets = np.append(upto[places], len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
    return pa.ListArray.from_arrays(list_offsets(np.diff(np.searchsorted(first, np.append(starts[:1], ends)))), words)


def value_sizes(col: pa.Array) -> np.ndarray:
    """Bytes of texts, or of numbers in arrays."""
    if pa.types.is_list(col.type) or pa.types.is_large_list(col.type):
        return 4 * list_lengths(col)
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)


def word_cutter(spark: SparkSession, marked: bool = False) -> Cutter:
    """Arrow function: texts -> words as `word_tokens` gives them, or `marked_word_tokens`; none of a null."""
    begins, kinds = char_kinds(spark)

    def cut(col: pa.Array) -> pa.ListArray:
        table = np.repeat(kinds, np.diff(begins, append=MAX_CODE_POINT))
        parts = [_words_of(col.slice(a, b - a), table, marked) for a, b in row_slices(value_sizes(col))]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return cut


def counted_words(batches: Iterator[pa.RecordBatch], by: Sequence[str], text: str, cut: Cutter) -> Iterator[pa.RecordBatch]:
    """`(…by, token, n)`: the words of some texts at a time, each with how often it occurs."""
    for batch in batches:
        for a, b in row_slices(value_sizes(batch.column(text)), COUNTED):
            words = cut(batch.column(text).slice(a, b - a))
            found = pa.table({"token": pc.list_flatten(words)})
            if by:
                row = pa.array(np.repeat(np.arange(a, b), list_lengths(words)))
                for c in by:
                    found = found.append_column(c, batch.column(c).take(row))
            counts = found.group_by([*by, "token"], use_threads=False).aggregate([([], "count_all")])
            yield from counts.rename_columns([*by, "token", "n"]).to_batches()
