"""Run a registered query and its SQL, and compare the rows whatever their order."""

from __future__ import annotations

import decimal
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    types = {f.name: f.dataType.simpleString().replace("timestamp_ntz", "timestamp") for f in df.schema}
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        sum(expected.values()), sum(actual.values()), str(list(missing)[:2])[:600], str(list(extra)[:2])[:600]
    )
    assert expected, "no rows"
    assert types == kinds, (types, kinds)
