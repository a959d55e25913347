import random
from pathlib import Path

import brute
import pytest
from conftest import SCHEMA, prose

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [], spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES:
        place = str(tmp_path_factory.mktemp(name) / "docs")
        apply(spark, docs, FOLDER).write.parquet(place)
        docs = spark.read.parquet(place)
        out.append((name, docs.toPandas()))
    return out


def test_every_stage_keeps_the_columns(spark, stages):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(list(df.columns) == columns for _, df in stages[:-1])
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_stage_equals_brute_force(stages):
    before, after = dict(stages)["quality"], dict(stages)["near_duplicates"]
    classes = brute.jaccard_components(dict(zip(before.doc_id, before.text)))
    assert set(after.doc_id) == {d for d, (_, c) in classes.items() if c == d}


def test_mix_repeats_within_bounds_and_shards_keep_all(stages):
    before, after, last = (dict(stages)[n] for n in ("decontamination", "mixing", "sharding"))
    assert set(after.doc_id) <= set(before.doc_id) and after.groupby("doc_id").size().max() <= 2
    assert sorted(last.doc_id) == sorted(after.doc_id)
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in last.groupby("shard"))


def test_run_gives_the_rows_of_the_stages(spark, stages):
    got = entry.queries()["pipeline"](spark, FOLDER).toPandas()
    assert sorted(got.doc_id) == sorted(stages[-1][1].doc_id)


def test_stages_take_nulls_repeats_and_nothing(spark, edge, nothing, tmp_path):
    for frame in (edge, nothing):
        for k, (_, apply) in enumerate(corpus_pipeline.STAGES):
            assert apply(spark, frame.select(*[f.name for f in SCHEMA]), FOLDER).count() >= 0


def test_rows_are_decided_one_by_one(spark, monkeypatch):
    """Rows that share a doc_id, or have none, are judged by their own text."""
    rng = random.Random(3)
    one, two, item = prose(rng, 80), prose(rng, 80), prose(rng, 40)
    rows = [(1, one, "en", "a", 1), (2, one, "en", "a", 2), (2, two, "en", "b", 3), (2, two, "en", "a", 3), (None, two, "fr", "a", 3),
            (None, one + " " + item, "en", "a", 0), (3, item, "en", "a", 0), (3, prose(rng, 50), "en", "a", 5), (None, None, "en", "a", 0),
            (None, None, "en", "a", 0), (4, "", "en", "a", 0), (5, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    kept = [tuple(r) for r in stages["near_duplicates"](spark, docs, FOLDER).collect()]
    expected = [rows[0], rows[3], *rows[5:9], *rows[10:]]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([(1, item)], "item_id long, text string"))
    clean = [tuple(r) for r in stages["decontamination"](spark, docs, FOLDER).collect()]
    assert sorted(clean, key=str) == sorted(rows[:5] + rows[7:], key=str)


def test_one_query_for_each_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


def test_nothing_else_imports_the_subpackage():
    top = Path(entry.__file__).parent
    for path in (top / "tokenloom").rglob("*.py"):
        if "llm" not in path.relative_to(top).parts:
            assert "tokenloom.llm" not in path.read_text(), path
