"""Cluster quality without pairs: closed forms over per-cluster sums of unit vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.vectors import distances_to, dot, dots_with
from lodestrata.operators.cluster import centroid_matrix, centroids, with_assigned_distance


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def cluster_fractions(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Adds each cluster's share; the total is one number over the K rows."""
    sizes = cluster_sizes(df, cluster)
    total = sizes.agg(F.sum("n").alias("total"))
    return sizes.join(F.broadcast(total)).select(cluster, "n", (F.col("n") / F.col("total")).alias("fraction"))


def intra_similarity(unit: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Mean cosine of all pairs of a cluster: (|S|^2 - sum of squares) / (n (n - 1)); null for one row."""
    table = centroids(unit, cluster)
    squares = unit.groupBy(cluster).agg(F.sum(dot(F.col("unit"), F.col("unit"))).alias("squares"))
    value = (dot(F.col("total"), F.col("total")) - F.col("squares")) / (F.col("n") * (F.col("n") - 1))
    return table.join(squares, cluster).select(cluster, "n", F.when(F.col("n") > 1, value).alias("intra_cluster_cosine_sim"))


def boundary_fractions(unit: DataFrame, cluster: str = "cluster_id", ratio: float = 1.2) -> DataFrame:
    """Share of rows whose second-nearest centroid, normalised, is less than ``ratio`` times as far as the nearest; 0 with one cluster."""
    near = nearest_two(unit, cluster)
    close = F.coalesce((F.col("d2") / F.greatest(F.col("d1"), F.lit(1e-8)) < ratio).cast("double"), F.lit(0.0))
    return near.groupBy(cluster).agg(F.avg(close).alias("boundary_fraction"))


def nearest_two(unit: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Adds the distances d1 and d2 to the two nearest normalised centroids (d2 null with one cluster)."""
    _, points = centroid_matrix(centroids(unit, cluster), cluster)
    norms = np.linalg.norm(points, axis=1, keepdims=True)
    points = np.divide(points, norms, out=points.copy(), where=norms > 0)
    ordered = F.array_sort(distances_to(F.col("unit"), points))
    return unit.withColumn("d", ordered).withColumn("d1", F.get("d", F.lit(0))).withColumn("d2", F.get("d", F.lit(1))).drop("d")


def davies_bouldin(unit: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The mean over clusters of the largest (s_i + s_j) / |c_i - c_j|; coincident centroids are passed over."""
    ids, points = centroid_matrix(centroids(unit, cluster), cluster)
    spread = with_assigned_distance(unit, ids, points, cluster).groupBy(cluster).agg(F.avg("cluster_distance").alias("s"))
    of = {r[0]: r[1] for r in spread.collect()}
    s = np.array([of[i] for i in ids])
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    ratio = np.divide(s[:, None] + s[None], apart, out=np.zeros_like(apart), where=apart > 0)
    value = float(ratio.max(axis=1).mean()) if len(ids) > 1 else 0.0
    return unit.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def silhouettes(unit: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Adds each row's cosine silhouette from cluster sums alone; 0 for a cluster of one row, null with one cluster."""
    table = centroids(unit, cluster).orderBy(cluster).collect()
    ids, n = [r[cluster] for r in table], np.array([float(r["n"]) for r in table])
    totals = np.array([r["total"] for r in table], np.float64)
    place = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(cluster)).cast("int")
    rows = unit.withColumn("p", dots_with(F.col("unit"), totals)).withColumn("place", place)
    sizes = F.array(*[F.lit(float(x)) for x in n])
    size = F.element_at(sizes, F.col("place"))
    own = (size - F.element_at("p", F.col("place"))) / (size - 1)
    means = F.zip_with("p", sizes, lambda p, m: 1 - p / m)
    others = F.array_min(F.filter(means, lambda x, i: i + 1 != F.col("place")))
    rows = rows.withColumn("a", F.when(size > 1, own)).withColumn("b", others)
    value = F.when(size <= 1, F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return rows.withColumn("silhouette", F.when(F.col("b").isNotNull(), value)).drop("p", "place", "a", "b")
