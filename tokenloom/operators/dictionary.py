"""Looking up the elements of array columns in a table too large for the tasks.

Rows are packed to blocks, each with the arrays as places in a list: the known rows of the table, which are
looked up inside the tasks, and then the other distinct elements of the block. Only these are joined with
the table, once per block; the results go back to their block, where the arrays are written out again. No
row is made for an element of an array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenloom.functions.text import list_lengths, list_offsets, row_slices
from tokenloom.functions.words import Cutter, value_sizes
from tokenloom.session import lookup_join, stage

# A row group of staged blocks, which a reader decodes as a whole, has a hundred of them at least.
BLOCK_ROWS, BLOCK_ELEMENTS = 2000, 1 << 16
BATCH_BYTES = 1 << 22  # bytes of texts or numbers that are coded at a time
ROW_GROUP = 16 << 20  # bytes of staged blocks that a task holds at a time
TASK_BITS = 33  # low bits of a block's number, which count blocks of one task


def _cuts(sizes: np.ndarray) -> list[int]:
    """Rows at which blocks begin, and the end: at most BLOCK_ROWS rows and about BLOCK_ELEMENTS elements each."""
    cuts, room = [0], 0
    for row, n in enumerate(sizes.tolist()):
        if row > cuts[-1] and (row - cuts[-1] == BLOCK_ROWS or room + n > BLOCK_ELEMENTS):
            cuts.append(row)
            room = 0
        room += n
    return [*cuts, len(sizes)]


def _packed(batches: Iterator[pa.RecordBatch], column: str, cut: Cutter | None, known: pa.Array) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << TASK_BITS
    for batch in batches:
        for a, b in row_slices(value_sizes(batch.column(column)), BATCH_BYTES):
            rows = batch.slice(a, b - a)
            lists = cut(rows.column(column)) if cut else rows.column(column)
            sizes = list_lengths(lists)
            coded = pc.list_flatten(lists).dictionary_encode()
            # Places of known elements; others are below 0 until they are numbered in their block.
            found = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy()
            codes = coded.indices.to_numpy()
            rest = [n for n in rows.schema.names if n != column]
            cuts, ends = _cuts(sizes) if len(sizes) else [], np.append(0, np.cumsum(sizes))
            for i, j in zip(cuts, cuts[1:]):
                own = codes[ends[i] : ends[j]]
                places = found[own]
                asked, order = np.unique(own[places < 0], return_inverse=True)
                places[places < 0] = len(known) + order
                arrays = pa.ListArray.from_arrays(list_offsets(sizes[i:j]), pa.array(places, pa.int32()))
                part = pa.RecordBatch.from_arrays([*(rows.column(n).slice(i, j - i) for n in rest), arrays], [*rest, column])
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema) as writer:
                    writer.write_batch(part)
                kinds = pa.ListArray.from_arrays(list_offsets(np.array([len(asked)])), coded.dictionary.take(pa.array(asked)))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([out.getvalue().to_pybytes()]), kinds], ["block", "rows", "kinds"])
                block += 1


def map_elements(
    df: DataFrame, column: str, table: DataFrame, element: str, value: str, finish: Callable[[pa.ListArray], pa.Array],
    into: str, kind: T.DataType, max_rows: int, missing: Column | None = None, known: tuple[list, list] = ([], []),
    cut: Cutter | None = None,
) -> DataFrame:
    """`df` without `column`, but with `into`: `finish` of the arrays whose elements are replaced by their `value`.

    `cut` makes the arrays of `column`, if it does not hold them. `table(element, value)` is unique on `element`;
    `known` holds other elements with their values, at best the most frequent ones. Elements outside both get `missing`.
    """
    inner, answered = table.schema[element].dataType, to_arrow_type(table.schema[value].dataType)
    keys, found = pa.array(known[0], to_arrow_type(inner)), pa.array(known[1], answered)
    blocks = stage(df.mapInArrow(lambda b: _packed(b, column, cut, keys), T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.BinaryType()), T.StructField("kinds", T.ArrayType(inner))])), "blocks", ROW_GROUP)
    # An element comes once per block, so none has many rows.
    asked = blocks.select("block", F.posexplode("kinds").alias("pos", element))
    met = lookup_join(asked, table.select(element, value), [element], "left", max_rows=max_rows)
    answer = F.col(value) if missing is None else F.coalesce(F.col(value), missing)
    # A block's answers: as many as it has distinct elements that are not known.
    answers = met.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", answer.alias("v")))).alias("_a"))
    joined = blocks.join(answers.select("block", F.col("_a.v").alias("values")), "block", "left").select("rows", "values")
    rest = [f for f in df.schema if f.name not in (column, into)]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in zip(batch.column("rows"), batch.column("values")):
                with pa.ipc.open_stream(pa.py_buffer(rows.as_py())) as reader:
                    part = reader.read_next_batch()
                codes = part.column(column)
                every = pa.concat_arrays([found, pc.cast(values.values, answered)]) if values.is_valid else found
                arrays = pa.ListArray.from_arrays(list_offsets(list_lengths(codes)), every.take(pc.list_flatten(codes)))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), finish(arrays)], [*(f.name for f in rest), into])

    return joined.mapInArrow(unpack, T.StructType([*rest, T.StructField(into, kind)])).select(
        *[c for c in df.columns if c not in (column, into)], into)
