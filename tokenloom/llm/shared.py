"""Helpers that several operators share: reading tables, staged results, sizes, hashed orders."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import fits, stage  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(docs: DataFrame, per_task: int = 16 << 20) -> tuple[int, int]:
    """(tasks, rows): enough tasks for `per_task` bytes of text each, at least the session's number."""
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return max(partitions(docs.sparkSession), -(-size // per_task)), rows


def stage_small(df: DataFrame, label: str) -> DataFrame:
    """`stage` for a table of links or nodes, far smaller than the texts: an eighth of the usual files."""
    return stage(df.coalesce(max(8, partitions(df.sparkSession) // 8)), label)


def without(rows: DataFrame, gone: DataFrame, on: dict[str, Column]) -> DataFrame:
    """`rows` that `gone` does not list; `on` maps its columns to expressions over `rows`, null equal to null.

    A list within the broadcast bound goes to the rows, which then stay where they are; beyond it both are shuffled.
    """
    listed = stage_small(gone.select(*[F.col(c).alias(f"_gone_{c}") for c in on]).distinct(), "gone")
    listed = F.broadcast(listed) if fits(listed) else listed
    met = reduce(and_, [value.eqNullSafe(F.col(f"_gone_{c}")) for c, value in on.items()])
    return rows.join(listed, met, "left_anti")


def own_prefix(rows: DataFrame, prefix: str) -> str:
    """A beginning for names of helper columns that no column of `rows` has."""
    while any(c.lower().startswith(prefix) for c in rows.columns):
        prefix = f"_{prefix}"
    return prefix


def mixed(*columns: Column, seed: int) -> Column:
    """A reproducible 64-bit hash."""
    return F.xxhash64(F.lit(seed), *columns)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod `modulus` is `remainder`; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "short": pa.int16()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ", 1) for x in ddl.split(", "))])


def record_batch(ddl: str, *columns) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
