"""What a viewer of shards asks for: an overview, filtered pages, one entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overview(entries: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Totals over all clusters: rows, clusters, smallest and largest."""
    sizes = entries.groupBy(cluster).agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("total"), F.count("*").alias("clusters"), F.min("n").alias("smallest"), F.max("n").alias("largest"))


def entry_filter(min_score: float | None = None, max_distance: float | None = None, has_url: bool | None = None, has_caption: bool | None = None) -> Column:
    """A predicate of the given bounds; what is not given does not filter."""
    out = F.lit(True)
    if min_score is not None:
        out &= F.col("aesthetic_score") >= min_score
    if max_distance is not None:
        out &= F.col("cluster_distance") <= max_distance
    for wanted, column in ((has_url, "url"), (has_caption, "caption")):
        if wanted is not None:
            there = F.coalesce(F.col(column), F.lit("")) != ""
            out &= there if wanted else ~there
    return out


def page(entries: DataFrame, after: int, size: int, key: str = "row_id") -> DataFrame:
    """The next entries after a known one: a range predicate and a top-k, not an offset."""
    return entries.where(F.col(key) > after).orderBy(key).limit(size)


def entry(entries: DataFrame, key_value: int, key: str = "row_id") -> DataFrame:
    return entries.where(F.col(key) == key_value)
