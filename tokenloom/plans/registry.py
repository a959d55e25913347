"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import WORD_PATTERN, ids_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def six(value: Column) -> Column:
    """Rounded for comparison, without a negative zero."""
    return F.round(value, 6) + F.lit(0.0)


def as_text(ids: str | Column) -> Column:
    return ids_text(F.col(ids) if isinstance(ids, str) else ids)


def whole(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# Shared beginnings of the comparison SQL.
CHARS_SQL = """
split_text AS (SELECT doc_id, string_split(text, '') AS parts FROM documents WHERE text <> ''),
tok AS (SELECT doc_id, unnest(parts) AS ch, generate_subscripts(parts, 1) AS i FROM split_text),
vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT ch FROM tok)),
stream AS (
  SELECT doc_id, i, id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos
  FROM tok JOIN vocab USING (ch)),
size AS (SELECT count(*) AS n, (SELECT count(*) FROM vocab) AS v FROM stream)
"""


def words_sql(source: str, key: str, text: str, name: str) -> str:
    """CTE `name(key, i, token)` of word tokens."""
    found = f"regexp_extract_all({text}, '{WORD_PATTERN}')"
    return (
        f"{name} AS (SELECT {key}, unnest({found}) AS token, "
        f"generate_subscripts({found}, 1) AS i FROM {source})"
    )


def vocab_sql(words: str, name: str) -> str:
    """CTE `name(token, id, freq)` of the word vocabulary without special tokens."""
    return (
        f"{name} AS (SELECT token, freq, 3 + row_number() OVER (ORDER BY freq DESC, token) AS id "
        f"FROM (SELECT token, count(*) AS freq FROM {words} GROUP BY token HAVING count(*) >= 2))"
    )
