"""Sequences of vectors: normalising, averaging, pooling and looking up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.vectors import masked_softmax
from tokenloom.operators import scoring, vectors, vocab
from tokenloom.operators.encode import encode_chars
from tokenloom.plans.corpus import corpus
from tokenloom.plans.registry import CHARS_SQL, query, six, whole
from tokenloom.sources.corpus import table

LENGTH = 8  # positions per test sequence
VECTORS_SQL = f"""
vectors AS (SELECT vec_id, vec_id // {LENGTH} AS seq_id, vec_id % {LENGTH} AS t, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings),
places AS (SELECT vec_id, seq_id, t, unnest(range(len(v))) AS dim, unnest(v) AS x FROM vectors)"""


def sequences(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.floor(F.col("vec_id") / LENGTH).alias("seq_id"),
        (F.col("vec_id") % LENGTH).alias("t"),
        F.col("embedding").cast("array<double>").alias("v"),
    )


def _long(df: DataFrame, keys: list[str], **arrays: Column | str) -> DataFrame:
    """Arrays of equal length as one row per place, rounded."""
    named = [(F.col(a) if isinstance(a, str) else a).alias(n) for n, a in arrays.items()]
    rows = df.select(*keys, *named).select(*keys, F.posexplode(F.arrays_zip(*arrays)).alias("dim", "row"))
    return rows.select(*keys, *whole("dim"), *[six(F.col(f"row.{n}")).alias(n) for n in arrays])


@query(
    "row_standardize",
    f"""WITH {VECTORS_SQL},
    rows AS (SELECT vec_id, avg(x) AS m, var_samp(x) AS vs, var_pop(x) AS vp FROM places GROUP BY vec_id)
    SELECT vec_id, dim, round((x - m) / sqrt(vs + 1e-5), 6) + 0.0 AS sample_inside,
    round((x - m) / (sqrt(vs) + 1e-6), 6) + 0.0 AS sample_outside,
    round((x - m) / sqrt(vp + 1e-5), 6) + 0.0 AS population FROM places JOIN rows USING (vec_id)""",
)
def row_standardize(spark, folder):
    df = sequences(spark, folder)
    variants = {"sample_inside": 1e-5, "sample_outside": 1e-6, "population": 1e-5}
    for name, eps in variants.items():
        df = vectors.row_standardize(df, name, into=name, eps=eps)
    return _long(df, ["vec_id"], **{n: n for n in variants})


@query(
    "column_moments",
    f"""WITH {VECTORS_SQL} SELECT dim, round(avg(x), 6) + 0.0 AS mean, round(stddev_samp(x), 6) + 0.0 AS std
    FROM places GROUP BY dim""",
)
def column_moments(spark, folder):
    moments = vectors.column_moments(sequences(spark, folder))
    return moments.select(*whole("dim"), six(F.col("mean")).alias("mean"), six(F.col("std")).alias("std"))


@query(
    "causal_mean",
    f"""WITH {VECTORS_SQL} SELECT seq_id, t, dim,
    round(avg(x) OVER (PARTITION BY seq_id, dim ORDER BY t), 6) + 0.0 AS mean FROM places""",
)
def causal_mean(spark, folder):
    return _long(vectors.causal_mean(sequences(spark, folder)), ["seq_id", "t"], mean="mean")


@query(
    "masked_softmax",
    f"""WITH {VECTORS_SQL}, seen AS (SELECT vec_id, max(x) FILTER (dim <= vec_id % 64) AS top FROM places GROUP BY vec_id),
    powers AS (SELECT vec_id, dim, CASE WHEN dim <= vec_id % 64 THEN exp(x - top) ELSE 0 END AS e
      FROM places JOIN seen USING (vec_id))
    SELECT vec_id, dim, round(e / sum(e) OVER (PARTITION BY vec_id), 6) + 0.0 AS weight FROM powers""",
)
def masked_softmax_query(spark, folder):
    visible = (F.col("vec_id") % 64 + 1).cast("int")
    return _long(sequences(spark, folder), ["vec_id"], weight=masked_softmax(F.col("v"), visible))


@query(
    "causal_pooling",
    f"""WITH {VECTORS_SQL},
    scores AS (SELECT q.vec_id, q.seq_id, q.t, k.vec_id AS key_id, list_dot_product(q.v, k.v) / 8 AS s
      FROM vectors q JOIN vectors k ON k.seq_id = q.seq_id AND k.t <= q.t),
    powers AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS e FROM scores),
    weights AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS w FROM powers)
    SELECT w.seq_id, w.t, p.dim, round(sum(w * p.x), 6) + 0.0 AS pooled
    FROM weights w JOIN places p ON p.vec_id = w.key_id GROUP BY w.seq_id, w.t, p.dim""",
)
def causal_pooling(spark, folder):
    return _long(vectors.causal_pooling(sequences(spark, folder)), ["seq_id", "t"], pooled="pooled")


CROSS_SQL = f"""{VECTORS_SQL},
scores AS (SELECT q.vec_id, q.seq_id, q.t, k.vec_id AS key_id, k.t AS key_t, list_dot_product(q.v, k.v) / 8 AS s
  FROM vectors q JOIN vectors k ON k.seq_id - 1 = q.seq_id AND k.t <= k.seq_id % 5),
powers AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS e FROM scores),
weights AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS w FROM powers)"""


def _crossed(spark, folder) -> DataFrame:
    """Each sequence asks the next one, of which only the first few positions are not padding."""
    asked = sequences(spark, folder)
    given = asked.withColumn("visible", F.col("t") <= F.col("seq_id") % 5)
    given = given.withColumn("seq_id", F.col("seq_id") - 1)
    return vectors.cross_pooling(asked, given)


@query(
    "cross_pooling",
    f"""WITH {CROSS_SQL} SELECT w.seq_id, w.t, p.dim, round(sum(w * p.x), 6) + 0.0 AS pooled
    FROM weights w JOIN places p ON p.vec_id = w.key_id GROUP BY w.seq_id, w.t, p.dim""",
)
def cross_pooling(spark, folder):
    return _long(_crossed(spark, folder), ["seq_id", "t"], pooled="pooled")


@query(
    "cross_weights",
    f"""WITH {CROSS_SQL} SELECT q.seq_id, q.t, k.t AS dim, coalesce(round(w.w, 6), 0) + 0.0 AS weight
    FROM vectors q JOIN vectors k ON k.seq_id - 1 = q.seq_id
    LEFT JOIN weights w ON w.vec_id = q.vec_id AND w.key_id = k.vec_id""",
)
def cross_weights(spark, folder):
    return _long(_crossed(spark, folder), ["seq_id", "t"], weight="weights")


@query(
    "embedding_lookup",
    f"""WITH {CHARS_SQL}, {VECTORS_SQL},
    counts AS (SELECT doc_id, id, count(*) AS n FROM stream GROUP BY ALL),
    dims AS (SELECT doc_id, unnest(range(64)) AS dim FROM documents),
    pooled AS (SELECT doc_id, d.dim, coalesce(sum(n * coalesce(x, 0) * 8) / sum(n), 0) AS pooled
      FROM dims d LEFT JOIN counts USING (doc_id) LEFT JOIN places p ON p.vec_id = counts.id AND p.dim = d.dim GROUP BY doc_id, d.dim),
    ends AS (SELECT doc_id, arg_max(id, i) AS id, max(i) - 1 AS pos FROM stream GROUP BY doc_id),
    angles AS (SELECT doc_id, d.dim, coalesce(x, 0) * 8 AS x, pos * exp(-(d.dim - d.dim % 2) * ln(10000.0::DOUBLE) / 64) AS a
      FROM dims d LEFT JOIN ends USING (doc_id) LEFT JOIN places p ON p.vec_id = ends.id AND p.dim = d.dim)
    SELECT doc_id, dim, round(pooled, 6) + 0.0 AS pooled,
    round(x + coalesce(CASE WHEN dim % 2 = 0 THEN sin(a) ELSE cos(a) END, 0), 6) + 0.0 AS last_vector
    FROM pooled JOIN angles USING (doc_id, dim)""",
)
def embedding_lookup(spark, folder):
    docs = corpus(spark, folder)
    encoded = encode_chars(docs, vocab.char_vocab(docs))
    emb = sequences(spark, folder).select(F.col("vec_id").alias("id"), "v")
    pooled = vectors.mean_pool(encoded, emb, "doc_id", scaled=True, missing="zero")
    # A document without characters has no last one: zeros, without a position.
    ends = encoded.select("doc_id", F.try_element_at("ids", F.lit(-1)).alias("id"), (F.size("ids") - 1).alias("pos"))
    last = vectors.embed_tokens(ends, emb, scaled=True, positions=True, salt_by=["doc_id"], missing="zero")
    zeros = F.transform("v", lambda x: F.lit(0.0))
    last = last.withColumn("last_vector", F.when(F.col("pos") < 0, zeros).otherwise(F.col("v")))
    return _long(pooled.join(last.select("doc_id", "last_vector"), "doc_id"), ["doc_id"], pooled="v", last_vector="last_vector")


WEIGHTS = [((i * 7) % 11 - 5) / 10 for i in range(64)]


@query(
    "batch_score",
    f"""WITH {VECTORS_SQL} SELECT vec_id, round(sum(x * (((dim * 7) % 11) - 5) / 10) + 0.25, 6) + 0.0 AS score
    FROM places GROUP BY vec_id""",
)
def batch_score(spark, folder):
    df = sequences(spark, folder).select("vec_id", "v")
    scored = scoring.score_with(df, scoring.linear_model(WEIGHTS, 0.25), ["v"], width=64)
    return scored.select("vec_id", six(F.col("score")).alias("score"))
