"""Source, expected and predicted texts side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predictions(df: DataFrame, key: str, source: str, expected: str, predicted: str) -> DataFrame:
    return df.select(
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        F.col(expected).alias("expected"),
        F.col(predicted).alias("predicted"),
    )


def preview(table: DataFrame, n: int = 2) -> DataFrame:
    """The first `n` rows by id."""
    return table.orderBy("id").limit(n)


def save_predictions(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)
