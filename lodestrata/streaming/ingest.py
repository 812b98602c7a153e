"""Bounded streaming ingest of an index: files that arrive are normalised once, and a lost run goes on where it stopped."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.operators.normalize import SCORE_NAMES, normalize_by_value
from lodestrata.operators.sampling import exact_sample


def ingest_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, min_score: float, score_names: tuple[str, ...] = SCORE_NAMES) -> None:
    """Read all new Parquet files below ``source``, normalise them and append to ``target``.

    Offsets in ``checkpoint`` stand for what was consumed, so that rejected rows are not read
    again.  Each batch goes to a folder of its own, written over when it is repeated.
    """

    def put(batch: DataFrame, number: int) -> None:
        normalize_by_value(batch, min_score, score_names).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def bounded(df: DataFrame, target: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``target`` rows, or all, in an order of the seed alone."""
    return exact_sample(df, target, key, seed)


def with_backoff(run: Callable[[], None], attempts: int, base: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> None:
    """Run again after a failure, waiting base * 2^(n - 1) seconds, ``most`` at most."""
    for n in range(1, attempts + 1):
        try:
            return run()
        except Exception:
            if n == attempts:
                raise
            sleep(min(base * 2 ** (n - 1), most))
    return None
