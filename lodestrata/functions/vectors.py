"""Vectors as arrays on their rows: norms, distances to a small set of centroids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def l2_normalised(x: Column) -> Column:
    """Each vector over its length, in doubles; a zero vector stays zero, a null is null.

    A lambda over the components would take the norm anew for each of them.
    """

    @F.pandas_udf("array<double>")
    def run(vectors: pd.Series) -> pd.Series:
        rows = [None if v is None else np.asarray(v, np.float64) for v in vectors]
        return pd.Series([v if v is None or not (norm := np.sqrt(v @ v)) > 0 else v / norm for v in rows], dtype=object)

    return run(x)


def distances_to(x: Column, centroids: np.ndarray) -> Column:
    """Euclidean distances of each vector to K centroids (which go along with the plan: K rows)."""
    points = np.asarray(centroids, np.float64)

    @F.pandas_udf("array<double>")
    def run(vectors: pd.Series) -> pd.Series:
        rows = np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.empty((0, points.shape[1]))
        squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (rows @ points.T)
        return pd.Series(list(np.sqrt(np.maximum(squares, 0))))

    return run(x)


def dots_with(x: Column, vectors: np.ndarray) -> Column:
    """Inner products of each vector with K vectors."""
    points = np.asarray(vectors, np.float64)

    @F.pandas_udf("array<double>")
    def run(rows: pd.Series) -> pd.Series:
        data = np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.empty((0, points.shape[1]))
        return pd.Series(list(data @ points.T))

    return run(x)
