"""Logistic regression: full-batch gradient rounds on labels -1 and 1, and the Spark ML estimator."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.learn.batches import as_matrix, partial_sums, vector_sums


def gradient_rounds(
    points: DataFrame,
    label: str,
    vector: str,
    weights: Sequence[float],
    rounds: int,
    step: float = 1.0,
) -> list[float]:
    """Weights after a fixed number of rounds ``w -= step * sum((1/(1+exp(-y w.x)) - 1) y x)``."""
    current = np.array([float(w) for w in weights])
    data = points.select(F.col(label).cast("double"), vector)
    for _ in range(rounds):

        def summarize(batch, w=current):
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = as_matrix(batch.column(1))
            factor = (1.0 / (1.0 + np.exp(-y * (x @ w))) - 1.0) * y
            return np.array([0]), np.array([len(y)]), (factor @ x)[np.newaxis, :]

        total = vector_sums(partial_sums(data, summarize), ["key"], "sums").first()
        if total is None:
            break
        current = current - step * np.array(total["sums"])
    return current.tolist()


def ml_logistic_regression(points: DataFrame, label: str, vector: str, max_rounds: int = 50):
    """Spark ML model on the same points; labels -1 and 1 become 0 and 1."""
    data = points.select(
        (F.col(label) > 0).cast("double").alias("label"),
        array_to_vector(F.col(vector)).alias("features"),
    )
    return LogisticRegression(maxIter=max_rounds).fit(data)
