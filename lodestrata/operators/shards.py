"""Shard numbers, shard metadata and content versions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch


def assign_shards(df: DataFrame, shard_size: int, cluster: str = "cluster_id", key: str = "row_id", ranges: int | None = None) -> DataFrame:
    """Adds ``shard``: the place of a row in its cluster, by key, over the shard size.

    Places come in two levels: rows are counted by ranges of cluster and key, as many as the session's
    shuffle partitions, and numbered within those, so that a large cluster is not one task.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(ranges, cluster, key).sortWithinPartitions(cluster, key).withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    ordered = Scratch(df.sparkSession, "shards").keep(ordered, "ordered")
    counts = ordered.groupBy(cluster, "part").agg(F.count("*").alias("n"), F.min("seq").alias("low"))
    before = Window.partitionBy(cluster).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(cluster, "part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    place = F.col("begin") + F.col("seq") - F.col("low")
    return ordered.join(F.broadcast(starts), [cluster, "part"]).withColumn("shard", F.floor(place / shard_size)).drop("part", "begin", "low", "seq")


def shard_counts(assigned: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return assigned.groupBy(cluster).agg(F.countDistinct("shard").alias("n_shards"), F.count("*").alias("n"))


def metadata_json(cluster: str = "cluster_id", score: str = "aesthetic_score", distance: str = "cluster_distance", url: str = "url", caption: str = "original_caption"):
    """A sample's metadata as JSON; absent numbers are 0 and absent texts empty."""
    return F.to_json(
        F.struct(
            F.col(cluster).cast("int").alias("cluster_id"), F.coalesce(F.col(score), F.lit(0.0)).alias("aesthetic_score"), F.coalesce(F.col(distance), F.lit(0.0)).alias("cluster_distance"),
            F.coalesce(F.col(url), F.lit("")).alias("original_url"), F.coalesce(F.col(caption), F.lit("")).alias("original_caption"),
        ),
        {"ignoreNullFields": "false"},
    )


def version_tag(checksums: dict[str, str]) -> str:
    """A tag that names the content of all files."""
    return "v1.0.0-" + hashlib.sha256(json.dumps(checksums, sort_keys=True).encode()).hexdigest()[:8]
