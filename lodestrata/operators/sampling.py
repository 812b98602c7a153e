"""Samples that do not depend on partitions: order by a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def turn(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for any partitioning."""
    return df.orderBy(turn(seed, key), key).limit(n)


def sample_by_group(df: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most n rows of each group; Spark keeps only n of a group in each task before it shuffles."""
    order = Window.partitionBy(group).orderBy(turn(seed, key), key)
    return df.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= n)


def oversampled(n: int, factor: float) -> int:
    return max(int(n * factor), n)
