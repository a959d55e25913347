"""Session helpers: a tuned session, and tables staged in shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table that may be broadcast or turned into a lookup inside tasks.
MAX_BROADCAST_ROWS = 200_000
# In a shuffled join, keys with more than one HOT_SHARE-th of the rows go to SALTS tasks each.
HOT_SHARE, SALTS = 1000, 16

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tokenloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs here expect; `conf` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    The session names it; only a local session without one gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="tokenloom-")
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set(CHECKPOINT_CONF, own)
    return own


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", row_group: int | None = None) -> DataFrame:
    """Write `df` once and read it back.

    Cuts lineage without tying the data to any executor, and gives later plans true sizes. Tables with
    long arrays are written in row groups of `row_group` bytes, as a reader decodes a whole one.
    """
    path = staging_path(df.sparkSession, label)
    made = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
    made.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MADE: dict[tuple, DataFrame] = {}


def files_state(df: DataFrame) -> tuple:
    """Tells whether the files that `df` is read from are still the same ones."""
    facts = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return tuple(df.select(facts.alias("f")).distinct().agg(F.count("*"), F.bit_xor("f")).first())


def once(source: DataFrame, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A staged table that several jobs of a session share: made at the first call for these files of `source`."""
    key = (source.sparkSession.sparkContext.applicationId, label, files_state(source))
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores when it lies in fewer files than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def fits(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows, without counting past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Keys that hold more than one HOT_SHARE-th of the rows: fewer than HOT_SHARE of them."""
    n = df.count()
    return df.groupBy(*on).count().filter(F.col("count") * HOT_SHARE > n).select(*on)


def salted(
    big: DataFrame, small: DataFrame, on: list[str], hot: DataFrame, salt_by: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a `_salt` column that spreads the hot keys, and only them, over tasks.

    `hot` must be a bounded table of keys.
    """
    marked = F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))
    spot = F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int")
    spots = F.sequence(F.lit(0), F.lit(SALTS - 1))
    left = big.join(marked, on, "left").withColumn("_salt", F.when(F.col("_hot"), spot).otherwise(0))
    copies = F.explode(F.when(F.col("_hot"), spots).otherwise(F.array(F.lit(0))))
    right = small.join(marked, on, "left").withColumn("_salt", copies)
    return left.drop("_hot"), right.drop("_hot")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    salt_by: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join `big` with a table that is unique on `on`, safe for hot keys in `big`.

    A table within `max_rows` is broadcast. A larger one is shuffled, and rows of `big` that share
    a hot key are spread over `SALTS` tasks by a hash of `salt_by`.
    """
    if fits(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    if not salt_by:
        return big.join(small, on, how)
    left, right = salted(big, small, on, stage(hot_keys(big, on), "hot"), salt_by)
    return left.join(right, on + ["_salt"], how).drop("_salt")


def hash_below(modulus: Column | int, *parts: Column) -> Column:
    """A reproducible whole number in [0, modulus) from an md5 of `parts`."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    modulus = F.lit(modulus) if isinstance(modulus, int) else modulus
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % modulus
