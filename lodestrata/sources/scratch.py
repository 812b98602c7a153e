"""Written intermediate tables below the folder that driver and executors share.

A lost executor costs only the tasks it ran, since every later stage reads the written table
again.  The tables are deleted when the driver's process ends, also after a failed run.
"""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from lodestrata.session import shared_folder

_FOLDERS: list[str] = []


@atexit.register
def _deleted() -> None:
    """Results that are read lazily need their tables as long as the process that can ask for them."""
    gateway = SparkContext._gateway
    if gateway is None or not _FOLDERS:
        return
    try:
        for folder in _FOLDERS:
            path = gateway.jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except (Py4JError, OSError):  # the JVM has gone already
        pass


class Scratch:
    """Written intermediate tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = f"{shared_folder(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"
        _FOLDERS.append(self.base)

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` and return it as read again, which cuts its lineage."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.path(table))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
