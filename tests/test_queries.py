"""Every registered query against its SQL; those without one must at least give rows."""

import os

import pytest
from compare import assert_same, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "val"}
    assert all(0 < r["nll"] < r["uniform_nll"] for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert_same(df, con, ORACLES[name])
    else:
        assert df.count() > 0
