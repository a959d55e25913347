"""Scoring tables with a model that every worker loads once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_with(
    df: DataFrame,
    load: Callable[[], Callable],
    cols: list[str],
    batch_size: int = 256,
    width: int | list[int] | None = None,
    into: str = "score",
    returns: T.DataType | None = None,
) -> DataFrame:
    """Adds the model's output. `load` runs once per worker and returns the batch function.

    `width` is the length of array inputs: one for all columns, or one per column (0 for a number).
    """
    widths = width if isinstance(width, list) else [width] * len(cols)
    shapes = [[w] if w else [] for w in widths] if any(widths) else None
    score = predict_batch_udf(
        load, return_type=returns or T.DoubleType(), batch_size=batch_size, input_tensor_shapes=shapes
    )
    return df.withColumn(into, score(*[F.col(c) for c in cols]))


def linear_model(weights: list[float], bias: float = 0.0) -> Callable[[], Callable]:
    """A loader for a plain linear scorer."""

    def load():
        w = np.array(weights, dtype=np.float64)
        return lambda batch: batch @ w + bias

    return load
