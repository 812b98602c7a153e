"""Parquet tables and JSON documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table; with a schema, files need no footer inference."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path) if partition_by else df.write.mode("overwrite").parquet(path)


def read_document(spark: SparkSession, path: str) -> dict | None:
    """One JSON document from any file system, or null if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return json.loads(spark.read.text(path, wholetext=True).head()[0])


def head_slice(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows by key; all if n is not positive."""
    return df.orderBy(key).limit(n) if n > 0 else df
