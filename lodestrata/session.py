"""A session with the settings that the plans of this package are made for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "lodestrata", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew joins, Arrow transfer, UTC; ``conf`` overrides (dots as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only on a local master, where all is one machine, may the setting be absent: a temporary folder is
    set then.  On a cluster that would be a folder the executors can't see, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root and context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lodestrata-"))
    return (root or context._jsc.sc().getCheckpointDir().get()).rstrip("/")
