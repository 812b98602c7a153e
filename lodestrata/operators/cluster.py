"""K-means on normalised vectors, centroids and assignment distances."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lodestrata.functions.vectors import distances_to

#: Partitions at least, rows of one at most, and fits that run at the same time.
FEWEST, ROWS, TOGETHER = 4, 50_000, 4


def centroids(unit: DataFrame, cluster: str = "cluster_id", vector: str = "unit") -> DataFrame:
    """cluster, n, mean and sum of its vectors; partial sums are made before the shuffle."""
    v = array_to_vector(F.col(vector))
    out = unit.groupBy(cluster).agg(F.count("*").alias("n"), Summarizer.mean(v).alias("m"), Summarizer.sum(v).alias("s"))
    return out.select(cluster, "n", vector_to_array("m").alias("centroid"), vector_to_array("s").alias("total"))


def centroid_matrix(table: DataFrame, cluster: str = "cluster_id", column: str = "centroid") -> tuple[list[int], np.ndarray]:
    """The K rows on the driver, by cluster id."""
    rows = table.select(cluster, column).orderBy(cluster).collect()
    return [r[0] for r in rows], np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1)


def with_assigned_distance(unit: DataFrame, ids: list[int], points: np.ndarray, cluster: str = "cluster_id", vector: str = "unit") -> DataFrame:
    """Adds ``cluster_distance``, to the row's own centroid as it is (not normalised again)."""
    place = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(cluster)).cast("int")
    return unit.withColumn("cluster_distance", F.element_at(distances_to(F.col(vector), points), place))


def fit_kmeans(unit: DataFrame, k: int, seeds: list[int], max_iter: int, key: str, vector: str = "unit") -> tuple[KMeansModel, float]:
    """The best of one fit for each seed by cost; the row order that k-means|| sees is fixed by range partitions of the key.

    Partitions follow the row count.  Seeds are fitted several at a time: an iteration is a short job that leaves cores free.
    """
    partitions = max(FEWEST, -(-unit.count() // ROWS))
    data = unit.select(key, array_to_vector(F.col(vector)).alias("features")).repartitionByRange(partitions, key).sortWithinPartitions(key).persist()
    fit = inheritable_thread_target(unit.sparkSession)(lambda s: KMeans(k=k, seed=s, maxIter=max_iter).fit(data))
    try:
        data.count()
        with ThreadPoolExecutor(min(len(seeds), TOGETHER)) as pool:
            fits = list(pool.map(fit, seeds))
        best = min(fits, key=lambda m: m.summary.trainingCost)
        return best, best.summary.trainingCost
    finally:
        data.unpersist()
