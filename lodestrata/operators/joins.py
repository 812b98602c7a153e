"""Lookups by path and stem as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_by_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value for each key: that of the last row."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def attach(left: DataFrame, right: DataFrame, key: str, value: str, order: str, default: Column | None = None) -> DataFrame:
    """Left join of the last value of each key; without a match null, or ``default``."""
    joined = left.join(last_by_key(right, key, value, order), key, "left")
    return joined if default is None else joined.withColumn(value, F.coalesce(value, default))


def present(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_semi")


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def missing_summary(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """How many rows have no match, and the first of them."""
    return missing(left, right, key).agg(F.count("*").alias("n_missing"), F.min_by(key, order).alias("first_missing"))


def require_all(left: DataFrame, right: DataFrame, key: str, order: str) -> None:
    """Raise before anything is written if a row has no match."""
    row = missing_summary(left, right, key, order).head()
    if row["n_missing"]:
        raise ValueError(f"{row['n_missing']} rows have no match, the first is {row['first_missing']}")
