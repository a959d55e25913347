"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.audit import audit_sql
from tokenloom.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def same_as(sql: str):
    """Registers a query together with the SQL that gives its rows."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        SQL[run.__name__] = sql
        return query(run)

    return register


# The layout before resharding: every source was written to one shard of 32, so shards are uneven.
OLD_SHARDS, SHARDS = 32, 40


def old_layout(source):
    return F.pmod(F.xxhash64(F.coalesce(source, F.lit(""))), F.lit(OLD_SHARDS)).cast("int")


@query
def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.sharding import document_size, reshard

    rows = table(spark, sf_dir, "documents").select(
        "doc_id", document_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), old_layout(F.col("source")).alias("_from"))
    out = reshard(rows, F.col("_from"), F.col("size"), ["doc_id", "text_crc32", "size"], SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.mixing import mix_sources, tagged, word_count

    rows = table(spark, sf_dir, "documents").select(
        "doc_id", tagged(F.col("source")).alias("tag"), word_count(F.col("text")).alias("size"))
    mixture = mix_sources(rows, "size", F.array("tag"), ["doc_id", "tag"])
    return (mixture.rows.join(F.broadcast(mixture.sources), "tag")
            .select("doc_id", "size", "source_size", "target", "taken"))


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), with_links=True)


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op9_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.imatch import edit_study, lexicon

    docs = table(spark, sf_dir, "documents")
    return edit_study(docs, lexicon(docs))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REJECT_BELOW, TOXIC_FROM = 0.3, 0.7


@query
def op8_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.quality import fit, score_documents
    from tokenloom.llm.shared import held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 5, 0)
    votes = fit(docs, table(spark, sf_dir, "labels"), "quality", ~held)
    return score_documents(docs, votes).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))


@query
def op10_toxicity_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.shared import held_out
    from tokenloom.llm.toxicity import fit, score_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 3, 1)
    model = fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held)
    return score_documents(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "spans")


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.repeats import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents")).drop("removed")


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.pii import find_personal_data, fit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, fit(docs)).drop("text")


@query
def op11_language_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.langid import fit, predict
    from tokenloom.llm.shared import held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_out(F.col("doc_id"), 5, 0)
    return predict(docs, fit(docs, ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@same_as(audit_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.audit import audit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit(docs, table(spark, sf_dir, "labels"), F.col("lang"))


# The hashed numbers, the cut texts and their digests; a text rebuilt from its parts is the text itself.
INFILL_SQL = """WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
  ('0x' || substring(h, 1, 8))::BIGINT AS h1, ('0x' || substring(h, 9, 8))::BIGINT AS h2,
  ('0x' || substring(h, 17, 8))::BIGINT AS h3, ('0x' || substring(h, 25, 8))::BIGINT AS h4 FROM hashed),
cut AS (SELECT doc_id, text, len(t) AS n, array_to_string(t[1:least(h1 % (len(t) + 1), h2 % (len(t) + 1))], '') AS p,
  array_to_string(t[1:greatest(h1 % (len(t) + 1), h2 % (len(t) + 1))], '') AS pm,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, text, n, form, p, substring(pm, length(p) + 1) AS m, substring(text, length(pm) + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts"""


@same_as(INFILL_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenloom.llm.infill import fill_in_middle, restore

    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
