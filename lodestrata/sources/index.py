"""The candidate index: batch or stream, normalised once and kept under the settings that made it."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from lodestrata.config import CurationConfig
from lodestrata.operators.normalize import SCORE_NAMES, normalize_by_column
from lodestrata.operators.sampling import exact_sample, oversampled
from lodestrata.sources.tables import head_slice
from lodestrata.streaming.ingest import ingest_stream, with_backoff

_SETTINGS = ("index_path", "num_samples", "oversample_factor", "index_max_rows", "min_aesthetic_score", "null_policy", "random_seed", "score_names")


def settings_key(config: CurationConfig, streaming: bool) -> str:
    """Names the result of the settings that decide it, so that other settings never find it."""
    known = {k: v for k, v in asdict(config).items() if k in _SETTINGS} | {"streaming": streaming}
    return hashlib.sha256(json.dumps(known, sort_keys=True).encode()).hexdigest()[:12]


def load_index(spark: SparkSession, config: CurationConfig, streaming: bool = False, key: str = "url") -> DataFrame:
    """Normalised candidates: oversampled, in an order of the seed alone; read again if these settings have made them before."""
    path = f"{config.work_dir}/url_list-{settings_key(config, streaming)}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        if streaming:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(config.index_path).schema.fields)
            names = config.score_names or SCORE_NAMES
            # The checkpoint knows what has been read: an attempt after a failure goes on from there.
            with_backoff(lambda: ingest_stream(spark, config.index_path, schema, f"{path}.batches", f"{path}.checkpoint", config.min_aesthetic_score, names), config.retry_attempts, config.retry_backoff)
            rows = spark.read.parquet(f"{path}.batches").drop("batch")
        else:
            raw = spark.read.parquet(config.index_path)
            rows = normalize_by_column(head_slice(raw, config.index_max_rows, raw.columns[0]), config.min_aesthetic_score, config.null_policy == "keep", config.score_names or SCORE_NAMES)
        exact_sample(rows, oversampled(config.num_samples, config.oversample_factor), key, config.random_seed).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
