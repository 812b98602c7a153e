"""Checks between stages, each one aggregation over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ValidationError(ValueError):
    """A stage's output does not hold what the next one needs."""


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row for each column: column_name, n_null."""
    columns = columns or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return one.select(F.inline(pairs))


def ingest_summary(df: DataFrame, score: str = "aesthetic_score") -> DataFrame:
    """n, whether any score is there, and whether all are at most 0 (a missing score is not)."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.bool_or(F.col(score).isNotNull()), F.lit(False)).alias("has_score"), F.coalesce(F.bool_and(F.coalesce(F.col(score) <= 0, F.lit(False))), F.lit(False)).alias("all_zero"))


def check_rows(df: DataFrame, least: int = 1, what: str = "table") -> int:
    n = df.count()
    if n < least:
        raise ValidationError(f"{what} has {n} rows, at least {least} are needed")
    return n


def check_no_nulls(df: DataFrame, columns: list[str], what: str = "table") -> None:
    bad = {r["column_name"]: r["n_null"] for r in null_counts(df, columns).collect() if r["n_null"]}
    if bad:
        raise ValidationError(f"{what} has nulls: {bad}")


def check_ingest(df: DataFrame, min_score: float) -> None:
    row = ingest_summary(df).head()
    if row["n"] < 1:
        raise ValidationError("no images")
    if min_score > 0 and row["has_score"] and row["all_zero"]:
        raise ValidationError("all scores are 0 or less")


def check_files(df: DataFrame, found: DataFrame, path: str = "image_path", what: str = "table") -> None:
    """Raise unless each row's file is among those found."""
    row = df.join(found.select(path), path, "left_anti").agg(F.count("*").alias("n"), F.min(path).alias("first")).head()
    if row["n"]:
        raise ValidationError(f"{what}: {row['n']} files are missing, the first is {row['first']}")


def check_captions(df: DataFrame, caption: str = "synthetic_caption", encoding: str = "clip_emb") -> None:
    """Raise unless each row has a path, a caption and an encoding."""
    check_no_nulls(df, ["image_path", caption, encoding], "captioned table")


def check_document(document: dict | None, what: str) -> dict:
    if not document:
        raise ValidationError(f"{what} is missing or empty")
    return document


def cluster_counts(df: DataFrame, dim: int, vector: str = "embedding", cluster: str = "cluster_id") -> DataFrame:
    """One row: n, clusters, odd_vectors (of another length), null_vectors."""
    return df.agg(F.count("*").alias("n"), F.countDistinct(cluster).alias("clusters"), F.count_if(F.size(vector) != dim).alias("odd_vectors"), F.count_if(F.col(vector).isNull()).alias("null_vectors"))


def check_clusters(df: DataFrame, k: int, dim: int, vector: str = "embedding", cluster: str = "cluster_id") -> DataFrame:
    """Raise unless there are exactly k clusters and vectors of the right length; returns clusters under 5 % of the rows."""
    check_no_nulls(df, [cluster, vector], "clustered table")
    row = cluster_counts(df, dim, vector, cluster).head()
    if row["clusters"] != k:
        raise ValidationError(f"{row['clusters']} clusters, {k} expected")
    if row["odd_vectors"]:
        raise ValidationError(f"{row['odd_vectors']} vectors have another length than {dim}")
    return imbalance(df, cluster)


def imbalance(df: DataFrame, cluster: str = "cluster_id", least: float = 0.05) -> DataFrame:
    """Clusters with less than the least share of rows."""
    from lodestrata.operators.quality import cluster_fractions

    return cluster_fractions(df, cluster).where(F.col("fraction") < least)


def check_shards(health: DataFrame, manifest: dict | None) -> None:
    """Raise unless there is a manifest and all its shards are there with content, and no others."""
    if not manifest:
        raise ValidationError("no manifest")
    bad = {r["state"]: r["n"] for r in health.where("state <> 'ok'").groupBy("state").agg(F.count("*").alias("n")).collect()}
    if bad or not health.head(1):
        raise ValidationError(f"shards are not in order: {bad or 'none'}")
