"""Queries over ``embeddings`` as images whose cluster is the label."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.config import CurationConfig
from lodestrata.functions.pixels import storage_mb
from lodestrata.functions.vectors import distances_to, l2_normalised
from lodestrata.operators import cluster as C
from lodestrata.operators import quality as Q
from lodestrata.operators.manifest import build_manifest
from lodestrata.operators.manifest import shard_health as health
from lodestrata.operators.sampling import sample_by_group
from lodestrata.operators.shards import assign_shards
from lodestrata.operators.shards import shard_counts as counted
from lodestrata.operators.validate import cluster_counts, imbalance
from lodestrata.operators.viewer import entry, entry_filter, page
from lodestrata.plans.registry import query, table
from lodestrata.sources.arrays import export_npy, import_npy
from lodestrata.sources.images import with_row_id
from lodestrata.sources.scratch import Scratch
from lodestrata.sources.tar_shards import write_tars

_UNIT = """
    parts AS (SELECT vec_id, label AS cluster_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    unit AS (SELECT vec_id, cluster_id, pos, CASE WHEN norm > 0 THEN x / norm ELSE x END AS x FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS norm FROM parts)),
    cent AS (SELECT cluster_id, pos, avg(x) AS c, sum(x) AS s FROM unit GROUP BY ALL),
    sizes AS (SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY ALL),
    ucent AS (SELECT cluster_id, pos, c / sqrt(sum(c * c) OVER (PARTITION BY cluster_id)) AS c FROM cent),
    dist AS (SELECT u.vec_id, any_value(u.cluster_id) AS own, c.cluster_id, sqrt(sum((u.x - c.c) * (u.x - c.c))) AS d FROM unit u JOIN cent c USING (pos) GROUP BY u.vec_id, c.cluster_id),
    udist AS (SELECT u.vec_id, any_value(u.cluster_id) AS own, c.cluster_id, sqrt(sum((u.x - c.c) * (u.x - c.c))) AS d FROM unit u JOIN ucent c USING (pos) GROUP BY u.vec_id, c.cluster_id),
    near AS (SELECT vec_id, own AS cluster_id, max(d) FILTER (WHERE k = 1) AS d1, max(d) FILTER (WHERE k = 2) AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d) AS k FROM udist) GROUP BY ALL),
    intra AS (
        SELECT cluster_id, n, (s2 - q) / (n * (n - 1)) AS sim FROM sizes JOIN (SELECT cluster_id, sum(s * s) AS s2 FROM cent GROUP BY ALL) USING (cluster_id) JOIN (SELECT cluster_id, sum(x * x) AS q FROM unit GROUP BY ALL) USING (cluster_id)
    ),
    bound AS (SELECT cluster_id, avg(coalesce((d2 / greatest(d1, 1e-8) < 1.2)::INTEGER, 0)) AS b FROM near GROUP BY ALL)
"""


def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster_id"), l2_normalised(F.col("embedding")).alias("unit"))


@query(f"""
    WITH {_UNIT} SELECT cluster_id, n, round(n / (SELECT sum(n) FROM sizes)::DOUBLE, 4) AS fraction, round(sim, 4) AS intra_cluster_cosine_sim, round(b, 4) AS boundary_fraction FROM intra JOIN bound USING (cluster_id)
""")
def cluster_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, share, mean pair similarity and boundary share of each cluster."""
    unit = unit_rows(spark, sf_dir)
    parts = Q.cluster_fractions(unit).join(F.broadcast(Q.intra_similarity(unit).drop("n")), "cluster_id").join(F.broadcast(Q.boundary_fractions(unit)), "cluster_id")
    return parts.select("cluster_id", "n", *[F.round(c, 4).alias(c) for c in ("fraction", "intra_cluster_cosine_sim", "boundary_fraction")])


@query(f"WITH {_UNIT} SELECT vec_id, pos::INTEGER AS pos, round(x, 6) AS x FROM unit")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unit_rows(spark, sf_dir).select("vec_id", F.posexplode("unit").alias("pos", "x"))
    return rows.select("vec_id", (F.col("pos") + 1).alias("pos"), F.round("x", 6).alias("x"))


@query(f"WITH {_UNIT} SELECT cluster_id, pos::INTEGER AS pos, round(c, 6) AS c FROM cent")
def centroid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.centroids(unit_rows(spark, sf_dir)).select("cluster_id", F.posexplode("centroid").alias("pos", "c"))
    return rows.select("cluster_id", (F.col("pos") + 1).alias("pos"), F.round("c", 6).alias("c"))


@query(f"WITH {_UNIT} SELECT vec_id, cluster_id, round(d, 6) AS distance FROM dist")
def centroid_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = unit_rows(spark, sf_dir)
    ids, points = C.centroid_matrix(C.centroids(unit))
    rows = unit.select("vec_id", F.posexplode(distances_to(F.col("unit"), points)).alias("at", "distance"))
    return rows.select("vec_id", F.element_at(F.array(*[F.lit(i) for i in ids]), F.col("at") + 1).alias("cluster_id"), F.round("distance", 6).alias("distance"))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = unit_rows(spark, sf_dir)
    return C.with_assigned_distance(unit, *C.centroid_matrix(C.centroids(unit)))


@query(f"WITH {_UNIT} SELECT vec_id, cluster_id, round(d, 6) AS cluster_distance FROM dist WHERE own = cluster_id")
def cluster_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir).select("vec_id", "cluster_id", F.round("cluster_distance", 6).alias("cluster_distance"))


@query(f"WITH {_UNIT} SELECT vec_id, round(d1, 6) AS d1, round(d2, 6) AS d2 FROM near")
def nearest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.nearest_two(unit_rows(spark, sf_dir)).select("vec_id", F.round("d1", 6).alias("d1"), F.round("d2", 6).alias("d2"))


@query(f"WITH {_UNIT} SELECT cluster_id, round(b, 6) AS boundary_fraction FROM bound")
def boundary_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.boundary_fractions(unit_rows(spark, sf_dir)).select("cluster_id", F.round("boundary_fraction", 6).alias("boundary_fraction"))


@query(f"""
    WITH {_UNIT}, pairs AS (SELECT a.cluster_id, a.vec_id, b.vec_id AS other, sum(a.x * b.x) AS sim FROM unit a JOIN unit b ON a.pos = b.pos AND a.cluster_id = b.cluster_id AND a.vec_id < b.vec_id GROUP BY ALL)
    SELECT cluster_id, n, round(avg(sim), 6) AS intra_cluster_cosine_sim FROM sizes LEFT JOIN pairs USING (cluster_id) GROUP BY ALL
""")
def intra_cluster_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.intra_similarity(unit_rows(spark, sf_dir)).select("cluster_id", "n", F.round("intra_cluster_cosine_sim", 6).alias("intra_cluster_cosine_sim"))


@query(f"""
    WITH {_UNIT}, s AS (SELECT cluster_id, avg(d) AS s FROM dist WHERE own = cluster_id GROUP BY ALL),
    apart AS (SELECT a.cluster_id AS i, b.cluster_id AS j, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m FROM cent a JOIN cent b ON a.pos = b.pos AND a.cluster_id <> b.cluster_id GROUP BY ALL)
    SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT i, max((x.s + y.s) / m) AS r FROM apart JOIN s x ON x.cluster_id = i JOIN s y ON y.cluster_id = j WHERE m > 0 GROUP BY i)
""")
def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.davies_bouldin(unit_rows(spark, sf_dir)).select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query(f"""
    WITH {_UNIT}, sims AS (SELECT a.vec_id, any_value(a.cluster_id) AS own, b.vec_id AS other, any_value(b.cluster_id) AS c, 1 - sum(a.x * b.x) AS d FROM unit a JOIN unit b ON a.pos = b.pos AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id),
    means AS (SELECT vec_id, own, c, avg(d) AS m FROM sims GROUP BY ALL),
    ab AS (SELECT vec_id, own, max(m) FILTER (WHERE c = own) AS a, min(m) FILTER (WHERE c <> own) AS b FROM means GROUP BY ALL)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab
""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean cosine silhouette of all rows, from cluster sums."""
    return Q.silhouettes(unit_rows(spark, sf_dir)).agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query("SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY ALL")
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.cluster_sizes(unit_rows(spark, sf_dir))


@query("SELECT label AS cluster_id, count(*) AS n, round(count(*) / (SELECT count(*) FROM embeddings)::DOUBLE, 6) AS fraction FROM embeddings GROUP BY ALL")
def cluster_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.cluster_fractions(unit_rows(spark, sf_dir)).select("cluster_id", "n", F.round("fraction", 6).alias("fraction"))


@query("SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY ALL HAVING count(*) / (SELECT count(*) FROM embeddings)::DOUBLE < 0.1")
def cluster_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imbalance(unit_rows(spark, sf_dir), least=0.1).select("cluster_id", "n")


@query(f"WITH {_UNIT} SELECT round(sum(d * d), 6) AS inertia FROM dist WHERE own = cluster_id")
def inertia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir).agg(F.round(F.sum(F.col("cluster_distance") * F.col("cluster_distance")), 6).alias("inertia"))


@query(f"""
    WITH {_UNIT} SELECT 8::BIGINT AS clusters, (SELECT count(*) FROM embeddings) AS n, true AS below_one_cluster, true AS centroids_are_means FROM (SELECT 1)
""")
def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the best of three fits whatever its labels: clusters, rows, a cost below that of one cluster, centroids that are their rows' means."""
    unit = unit_rows(spark, sf_dir).drop("cluster_id")
    model, cost = C.fit_kmeans(unit, 8, [42, 43, 44], 100, "vec_id")
    labelled = model.transform(unit.withColumn("features", C.array_to_vector("unit"))).withColumnRenamed("prediction", "cluster_id")
    ids, means = C.centroid_matrix(C.centroids(labelled))
    _, one = C.centroid_matrix(C.centroids(unit.withColumn("cluster_id", F.lit(0))))
    n = unit.count()
    single = n * (1 - float((one @ one.T)[0, 0]))  # of unit vectors: n less the square of their mean's length
    near = len(ids) == 8 and bool(np.abs(means - np.array(model.clusterCenters())).max() < 0.05)
    return spark.createDataFrame([(len(ids), n, cost < single, near)], "clusters long, n long, below_one_cluster boolean, centroids_are_means boolean")


@query("SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || vec_id), vec_id) AS k FROM embeddings) WHERE k <= 25")
def per_cluster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_by_group(table(spark, sf_dir, "embeddings").select("label", "vec_id"), "label", 25, "vec_id").select("label", "vec_id")


_SHARDED = "SELECT vec_id, label AS cluster_id, ((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 20)::BIGINT AS shard FROM embeddings"


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster_id")), 20, key="vec_id", ranges=8)


@query(_SHARDED)
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(spark, sf_dir).select("vec_id", "cluster_id", "shard")


@query(f"SELECT cluster_id, count(DISTINCT shard) AS n_shards, count(*) AS n FROM ({_SHARDED}) GROUP BY ALL")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(sharded(spark, sf_dir))


@query("""
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_id, label AS cluster_id, 'img' || vec_id AS image_id, round(embedding[1]::DOUBLE, 6) AS first_component, round(embedding[len(embedding)]::DOUBLE, 6) AS last_component FROM embeddings
""")
def router_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, id and vector of each row in one order: the vectors go out to an array file and come back from it."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster_id"), F.concat(F.lit("img"), F.col("vec_id")).alias("image_id"), "embedding")
    path = Scratch(spark, "router").path("embeddings.npy")
    export_npy(rows, path, "embedding", "vec_id", "float32", (rows.agg(F.max(F.size("embedding"))).head()[0],))
    ends = import_npy(spark, path).select("row_id", *[F.round(F.element_at("embedding", i).cast("double"), 6).alias(c) for i, c in ((1, "first_component"), (-1, "last_component"))])
    return with_row_id(rows.drop("embedding"), "vec_id").drop("vec_id").join(ends, "row_id")


@query(f"""
    WITH s AS (SELECT DISTINCT 'cluster_' || cluster_id || '/shard-' || shard AS path, shard, cluster_id FROM ({_SHARDED})),
    f AS (SELECT path, CASE WHEN shard = 1 THEN 0 ELSE 10 END AS size FROM s WHERE cluster_id <> 3 UNION ALL SELECT 'cluster_99/shard-0', 10)
    SELECT path, CASE WHEN f.size IS NULL THEN 'missing' WHEN s.shard IS NULL THEN 'extra' WHEN f.size = 0 THEN 'empty' ELSE 'ok' END AS state FROM s FULL JOIN f USING (path)
""")
def shard_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = sharded(spark, sf_dir).select("cluster_id", "shard").distinct().withColumn("path", F.concat(F.lit("cluster_"), F.col("cluster_id"), F.lit("/shard-"), F.col("shard")))
    found = paths.where("cluster_id <> 3").select("path", F.when(F.col("shard") == 1, 0).otherwise(10).alias("size")).unionByName(spark.createDataFrame([("cluster_99/shard-0", 10)], "path string, size int"))
    return health(paths, found)


@query("""
    SELECT 'cluster_' || cluster_id || '/shard-' || lpad(shard::VARCHAR, 4, '0') || '.tar' AS path, count(*) AS n
    FROM (SELECT label AS cluster_id, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 100 AS shard FROM embeddings) GROUP BY ALL
""")
def tar_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write tar shards of all vectors into the shared folder and list what is there: path, rows."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster_id"), "embedding")
    rows = assign_shards(rows, 100, key="vec_id")
    text = F.to_json("embedding").cast("binary")
    samples = rows.select("cluster_id", "shard", F.format_string("%08d", "vec_id").alias("image_id"), text.alias("latent"), text.alias("clip_emb"), F.lit("").alias("caption"), F.to_json(F.struct("cluster_id")).alias("metadata"))
    return write_tars(samples, Scratch(spark, "tar").path("expert_shards")).select("path", "n")


@query("SELECT count(*) AS total, count(DISTINCT label) AS num_clusters, max(n) AS largest, min(n) AS smallest, sum((n + 999) // 1000)::BIGINT AS n_shards FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label) JOIN embeddings USING (label)".replace("sum((n + 999) // 1000)::BIGINT", "(SELECT sum((m + 999) // 1000)::BIGINT FROM (SELECT count(*) AS m FROM embeddings GROUP BY label))"))
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the manifest, from its measured counts."""
    sizes = Q.cluster_sizes(table(spark, sf_dir, "embeddings").select(F.col("label").alias("cluster_id")))
    counts = [n for n in build_manifest(CurationConfig(), sizes, {}, None, {})["images_per_cluster"] if n]
    row = (sum(counts), len(counts), max(counts, default=None), min(counts, default=None), sum(-(-n // 1000) for n in counts))
    return spark.createDataFrame([row], "total long, num_clusters long, largest long, smallest long, n_shards long")


@query("SELECT round(sum(len(embedding) * 2) / 1048576.0::DOUBLE, 6) AS latents_mb, count(*) AS n FROM embeddings")
def latent_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Megabytes of all tensors at half precision, from their real lengths."""
    row = table(spark, sf_dir, "embeddings").agg(F.sum(F.size("embedding")).alias("elements"), F.count("*").alias("n")).head()
    return spark.createDataFrame([(round(storage_mb(1, row["elements"] or 0), 6), row["n"])], "latents_mb double, n long")


@query(f"""
    WITH {_UNIT} SELECT vec_id, cluster_id, round(d, 6) AS cluster_distance FROM dist WHERE own = cluster_id AND d <= 0.98 AND vec_id > 100 ORDER BY vec_id LIMIT 50
""")
def entry_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of filtered entries after a known row."""
    rows = page(assigned(spark, sf_dir).where(entry_filter(max_distance=0.98)), 100, 50, "vec_id")
    return rows.select("vec_id", "cluster_id", F.round("cluster_distance", 6).alias("cluster_distance"))


@query("SELECT vec_id, label, len(embedding)::INTEGER AS dim FROM embeddings WHERE vec_id = 7")
def entry_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entry(table(spark, sf_dir, "embeddings"), 7, "vec_id").select("vec_id", "label", F.size("embedding").alias("dim"))


@query("SELECT count(*) AS n, count(DISTINCT label) AS clusters, count(*) FILTER (WHERE len(embedding) <> 64) AS odd_vectors, count(*) FILTER (WHERE embedding IS NULL) AS null_vectors FROM embeddings")
def validate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_counts(table(spark, sf_dir, "embeddings"), 64, cluster="label")
