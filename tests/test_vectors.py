import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.vectors import masked_softmax, position_vector
from tokenloom.operators import vectors


@pytest.fixture(scope="module")
def table():
    rng = random.Random(3)
    return {(s, t): [rng.gauss(0, 1) for _ in range(4)] for s, n in ((0, 20), (1, 1), (2, 7)) for t in range(n)}


@pytest.fixture(scope="module")
def df(spark, table):
    return spark.createDataFrame([(s, t, v) for (s, t), v in table.items()], "seq_id bigint, t bigint, v array<double>")


def means(table):
    return {(s, t): np.mean([table[s, u] for u in range(t + 1)], axis=0) for s, t in table}


def assert_close(rows, column, expected):
    assert {(r["seq_id"], r["t"]) for r in rows} == set(expected)
    for r in rows:
        np.testing.assert_allclose(r[column], expected[r["seq_id"], r["t"]], atol=1e-12)


def test_causal_mean_is_pooling_without_similarity(df, table):
    assert_close(vectors.causal_mean(df, block=3).collect(), "mean", means(table))
    assert_close(vectors.causal_mean(df).collect(), "mean", means(table))
    assert_close(vectors.causal_pooling(df, scale=0.0).collect(), "pooled", means(table))


def attended(q, k, v, hidden):
    s = np.where(hidden, -np.inf, q @ k.T / math.sqrt(q.shape[1]))
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True) @ v


def test_causal_pooling_is_exact_for_any_block(df, table):
    w = np.random.default_rng(1).normal(size=(3, 4, 2))
    expected = {}
    for s, n in ((0, 20), (1, 1), (2, 7)):
        m = np.array([table[s, t] for t in range(n)])
        out = attended(m @ w[0], m @ w[1], m @ w[2], np.triu(np.ones((n, n)), 1) > 0)
        expected.update({(s, t): row for t, row in enumerate(out)})
    for block in (1024, 6, 1):
        made = vectors.causal_pooling(df, block=block, w_q=w[0], w_k=w[1], w_v=w[2]).collect()
        assert_close(made, "pooled", expected)


def test_causal_pooling_beyond_one_block(spark):
    n = vectors.BLOCK + 3
    m = np.random.default_rng(2).normal(size=(n, 2))
    rows = spark.createDataFrame([(0, t, v.tolist()) for t, v in enumerate(m)], "seq_id bigint, t bigint, v array<double>")
    made = {r["t"]: r["pooled"] for r in vectors.causal_pooling(rows).filter(F.col("t") >= n - 4).collect()}
    out = attended(m, m, m, np.triu(np.ones((n, n)), 1) > 0)
    for t in range(n - 4, n):
        np.testing.assert_allclose(made[t], out[t], atol=1e-9)


def test_cross_pooling_hides_padding_in_any_block(df, table):
    keys = df.filter("seq_id <> 1").withColumn("visible", F.col("t") < 5)
    made = vectors.cross_pooling(df.filter("seq_id <> 1"), keys).collect()
    expected = {}
    for s, n in ((0, 20), (2, 7)):
        m = np.array([table[s, t] for t in range(n)])
        out = attended(m, m, m, np.broadcast_to(np.arange(n) >= 5, (n, n)))
        expected.update({(s, t): out[t] for t in range(n)})
    assert_close(made, "pooled", expected)
    assert all(math.isclose(sum(r["weights"]), 1) and not any(r["weights"][5:]) for r in made)
    hidden = vectors.cross_pooling(df, df.withColumn("visible", F.lit(0))).first()
    assert not any(hidden["weights"]) and not any(hidden["pooled"])
    cut = vectors.cross_pooling(df.filter("seq_id <> 1"), keys, block=3).collect()
    assert_close(cut, "pooled", expected)
    assert all(math.isclose(sum(r["weights"]), 1) and not any(r["weights"][5:]) for r in cut)


def test_standardized_rows(df):
    for variant in ("sample_inside", "sample_outside", "population"):
        made = vectors.row_standardize(df, variant, eps=1e-12).collect()
        ddof = 0 if variant == "population" else 1
        assert all(abs(np.mean(r["z"])) < 1e-9 and abs(np.std(r["z"], ddof=ddof) - 1) < 1e-4 for r in made)
    shifted = vectors.row_standardize(df, "population", gamma=2.0, beta=5.0).first()["z"]
    assert abs(np.mean(shifted) - 5) < 1e-9


def test_softmax_and_positions(spark):
    row = spark.sql("SELECT array(1.0D, 2.0D, 1000.0D) AS s").select(
        masked_softmax(F.col("s"), F.lit(2)).alias("w"), position_vector(F.lit(3), 4).alias("p")
    ).first()
    np.testing.assert_allclose(row["w"], [1 / (1 + math.e), math.e / (1 + math.e), 0])
    np.testing.assert_allclose(row["p"], [math.sin(3), math.cos(3), math.sin(0.03), math.cos(0.03)])


def test_embedding_join_paths_agree_and_no_id_vanishes(spark):
    emb = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "id int, v array<double>")
    tokens = spark.createDataFrame([(1, p, i) for p, i in enumerate([0, 3, 3, 4, 9])], "doc_id int, pos int, id int")
    one = vectors.embed_tokens(tokens, emb, True, True, ["doc_id"], missing="zero").collect()
    two = vectors.embed_tokens(tokens, emb, True, True, ["doc_id", "pos"], max_rows=0, missing="zero").collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 5
    for rows in (vectors.MAX_BROADCAST_ROWS, 0):
        with pytest.raises(Exception, match="no vector for id 9"):
            vectors.embed_tokens(tokens, emb, salt_by=["pos"], max_rows=rows).collect()


def test_mean_pool_paths_agree_and_keep_empty_rows(spark):
    rng = np.random.default_rng(5)
    known = {i: rng.normal(size=6) for i in range(0, 40, 2)}
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in known.items()], "id int, v array<double>")
    rows = [(d, rng.integers(0, 40, rng.integers(0, 30)).tolist()) for d in range(50)] + [(50, []), (51, [2] * 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, ids array<int>").repartition(3)
    for max_rows in (1000, 0):
        got = {r["doc_id"]: r["v"] for r in vectors.mean_pool(docs, emb, "doc_id", missing="zero", scaled=True, max_rows=max_rows).collect()}
        assert len(got) == len(rows)
        for d, ids in rows:
            expected = np.mean([known.get(i, np.zeros(6)) for i in ids], axis=0) * 6**0.5 if ids else np.zeros(6)
            np.testing.assert_allclose(got[d], expected, atol=1e-12)
        with pytest.raises(Exception, match="no vector for id"):
            vectors.mean_pool(docs, emb, "doc_id", max_rows=max_rows).collect()


def test_wide_vectors_in_a_narrow_plan(spark):
    """Long vectors, sequences over several blocks, groups over several batches."""
    rng = np.random.default_rng(6)
    table = {(s, t): rng.normal(size=1600) for s, n in (("a", 45), ("b", 7), (None, 3)) for t in range(n)}
    df = spark.createDataFrame([(s, t, v.tolist()) for (s, t), v in table.items()], "seq_id string, t bigint, v array<double>").repartition(4)
    made = vectors.causal_mean(df.filter("seq_id is not null"), block=10)
    assert len(made._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert_close(made.collect(), "mean", {k: m for k, m in means({k: v for k, v in table.items() if k[0]}).items()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        got = {r["seq_id"]: r["v"] for r in vectors.summed(df, ["seq_id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {"a", "b", None}
    for s, v in got.items():
        np.testing.assert_allclose(v, sum(x for (k, _), x in table.items() if k == s), atol=1e-9)


def test_pooling_holds_little_beside_its_result(spark):
    """4 million ids of 2,000 rows: places and counts of a bounded part of them at a time."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tokenloom.functions.text import list_offsets
    from tokenloom.functions.vectors import pooled_vectors

    table = pa.table({"id": pa.array(range(50)), "v": pa.array([[float(i), 1.0] for i in range(50)])})
    ids = np.random.default_rng(1).integers(0, 50, 4_000_000).astype(np.int32)
    rows = pa.ListArray.from_arrays(list_offsets(np.full(2000, 2000)), pa.array(ids))
    pool = pooled_vectors(table, 2, True).func
    tracemalloc.start()
    made = pool(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
    expected = ids.reshape(2000, 2000).mean(axis=1)
    assert np.allclose(np.array(made.to_pylist()), np.stack([expected, np.ones(2000)], axis=1))
    assert pool(pa.array([[1, 3], [], None], pa.list_(pa.int32()))).to_pylist() == [[2.0, 1.0], [0.0, 0.0], [0.0, 0.0]]
