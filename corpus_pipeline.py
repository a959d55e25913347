"""A corpus made ready for training: five stages over `documents`, each applying one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the documents are
written as Parquet in the shared folder and read again. All stages but the last return the columns of
`documents`; the last adds where each row is stored.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import decontaminate, jaccard, mixing, quality, sharding
from tokenloom.llm.queries import REJECT_BELOW, SHARDS, old_layout
from tokenloom.llm.shared import stage, table, without
from tokenloom.session import staging_path


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _guarded(apply):
    """The stage with other columns of its input under names that nothing inside it uses."""
    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe = {c: c if c in DOCUMENT else f"extra{i}" for i, c in enumerate(docs.columns)}
        out = apply(spark, docs.toDF(*safe.values()), sf_dir)
        # A column that the stage itself makes replaces the one of its name.
        out = out.drop(*[new for c, new in safe.items() if c != new and c in out.columns])
        back = {new: c for c, new in safe.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run


@_guarded
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents with a score under the threshold go.

    Fitted on all labelled documents of this stage's input (up to the sample's bound). A null or empty
    text has the labels' own rate as its score.
    """
    votes = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), "quality", F.lit(True))
    columns = docs.columns
    return quality.score_documents(docs, votes).filter(F.col("score") >= REJECT_BELOW).select(*columns)


def _text_key():
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


@_guarded
def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near duplicates the smallest doc_id stays.

    Rows are decided one by one, so different texts that share a doc_id do not hide each other. Of rows with
    one doc_id and text, the least in order of all columns stays. Documents without words are duplicates of nothing.
    A row without a doc_id goes if its group has a doc_id; else its text stays once.
    """
    found = stage(jaccard.near_duplicates(docs.select("doc_id", "text"), carry=_text_key()), "classes")
    dropped = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "carried")
    kept = without(docs, dropped, {"doc_id": F.col("doc_id"), "carried": _text_key()})
    if not found.groupBy("doc_id", "carried").count().filter("count > 1").limit(1).count():
        return kept
    least = kept.groupBy("doc_id", _text_key().alias("_key")).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return least.select("row.*")


@_guarded
def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows whose text contains a test item go.

    A text key stands for the row, so a row without a doc_id or with a repeated one is judged by its own text.
    """
    keyed = docs.select(_text_key().alias("doc_id"), "text")
    hit = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"))
    return without(docs, hit, {"doc_id": _text_key()})


@_guarded
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a document comes as often as the mix takes it (0 to 2 times)."""
    columns = docs.columns
    rows = docs.withColumn("_words", mixing.word_count(F.col("text"))).withColumn("_tag", mixing.tagged(F.col("source")))
    mixed = mixing.mix_sources(rows, "_words", F.array("_tag"), ["doc_id", "_tag"]).rows
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*columns)


@_guarded
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: the shards that gain or lose rows are written anew; rows come back with their shard and slot in it."""
    rows = (docs.withColumn("_size", sharding.document_size(F.col("text")))
            .withColumn("_crc", F.crc32(F.coalesce(F.col("text"), F.lit("")))))
    out = sharding.reshard(rows, old_layout(F.col("source")), F.col("_size"), ["doc_id", "_crc", "_size"], SHARDS)
    out = out.select(*docs.columns, "old_shard", "shard", "slot", "moved")
    folder = staging_path(spark, "shards")
    places = {r["shard"]: r["path"] for r in sharding.rewrite(out, "", folder).collect()}  # one row per shard
    same = [s for s, path in places.items() if not path.startswith(folder)]
    kept = out.filter(F.col("shard").isin(same)).select(*docs.columns, "shard", "slot")
    written = spark.read.schema(kept.schema).parquet(folder).select(*docs.columns, "shard", "slot")
    return written.unionByName(kept) if same else written


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_a_kind),
    ("decontamination", drop_test_items),
    ("mixing", mix),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
