"""Near-duplicate removal by hash buckets, where the earlier of equal scores wins.

Within a bucket rows come in order; a live row removes the later live rows near it whose score
is not above its own, up to the first near one that beats it, which removes the row itself.
This is not the removal of all but the best of connected rows: what a removed row has
removed stays removed.  Rows of different buckets never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch


#: Rows of a bucket that one task compares with as many others; larger buckets are cut into tiles.
CHUNK = 4096
#: Later rows that a row is first compared with; four times as many follow as long as none of them beats it.
FIRST = 256


def _columns(words: np.ndarray) -> list[np.ndarray]:
    """The columns of hash words; two of 32 bits make one of 64."""
    if words.shape[1] == 2 and not (words >> 32).any():
        return [words[:, 0] << 32 | words[:, 1]]
    return [np.ascontiguousarray(words[:, k]) for k in range(words.shape[1])]


def _apart(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Bits in which hashes differ, given by columns."""
    total = np.bitwise_count(x[0] ^ y[0])
    for a, b in zip(x[1:], y[1:], strict=True):
        total = total.astype(np.uint16) + np.bitwise_count(a ^ b)
    return total


def _tile(keys: np.ndarray, words: list[np.ndarray], second: np.ndarray, same: bool, threshold: int) -> Iterator[pa.RecordBatch]:
    """Near pairs of one tile: of the rows of a chunk with those of the second one, or among themselves."""
    rows = np.flatnonzero(~second)
    others = rows if same else np.flatnonzero(second)
    held, size = [], 0
    step = max(1, (1 << 20) // max(len(others), 1))
    for at in range(0, len(rows), step):
        i, j = rows[at : at + step], others[at:] if same else others
        apart = _apart([w[i][:, None] for w in words], [w[j][None, :] for w in words])
        x, y = np.nonzero(apart <= threshold)
        a, b = keys[i[x]], keys[j[y]]
        kept = (a != b) & (y > x) if same else a != b
        held.append((np.minimum(a, b)[kept], np.maximum(a, b)[kept], apart[x, y][kept].astype(np.int32)))
        size += len(held[-1][0])
        if size > 100_000 or at + step >= len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["a", "b", "distance"])
            held, size = [], 0


def near_pairs(hashes: DataFrame, words: tuple[str, ...], threshold: int, key: str = "row_id") -> DataFrame:
    """All pairs of one bucket within the distance: a < b, distance.

    Pairs and comparisons grow as the square of a bucket, whatever is shared: a bucket is cut into chunks of about
    ``CHUNK`` rows, and each two of them, or one with itself, are a tile that is compared at once and by itself, wherever the
    shuffle takes it.  A task holds the rows of one tile and about a million comparisons.  The hashes are written once.
    """
    spark = hashes.sparkSession
    hashes = Scratch(spark, "pairs").keep(hashes.where(F.col(words[0]).isNotNull() & F.col(key).isNotNull()).select("bucket", key, *words), "hashes")
    chunks = hashes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    cut = hashes.join(chunks, "bucket").withColumn("chunk", F.pmod(F.xxhash64(key), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = cut.select("bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), (F.col("chunk") > F.col("other")).alias("second"), F.col(key).cast("long").alias("row"), *words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        columns = _columns(np.stack([rows[w].to_numpy().astype(np.int64) for w in words], axis=1))
        yield from _tile(rows["row"].to_numpy(), columns, rows["second"].to_numpy(), rows["low"][0] == rows["high"][0], threshold)

    # By number, so that the session does not join small partitions: tiles are small and their work is not.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(n, "bucket", "low", "high")
    return tiles.groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long, distance int")


def greedy_losers(order: np.ndarray, words: np.ndarray, scores: np.ndarray, threshold: int) -> np.ndarray:
    """Flags of the rows removed in one bucket; ``words`` has a row of 64-bit words for each row, in order.

    A row is compared with the rows after it only up to the one that beats it, and removed rows are taken out when they are most of the rest.
    """
    gone, place, columns = np.zeros(len(order), bool), np.arange(len(order)), _columns(words)
    live, i, dead = np.ones(len(order), bool), 0, 0
    while i < len(place):
        if live[i]:
            own, low, size = [c[i] for c in columns], i + 1, FIRST
            while low < len(place):
                high = min(low + size, len(place))
                near = low + np.flatnonzero((_apart([c[low:high] for c in columns], own) <= threshold) & live[low:high])
                stop = np.flatnonzero(~(scores[i] >= scores[near]))  # the comparison is false for NaN
                if len(stop):
                    near = near[: stop[0]]
                    live[i] = False
                live[near] = False
                dead += len(near)
                if len(stop):
                    break
                low, size = high, min(4 * size, 1 << 16)
            gone[place[i]] = not live[i]
        else:
            gone[place[i]] = True
            dead -= 1
        i += 1
        if 2 * dead > len(place) - i and dead > FIRST:
            gone[place[i:][~live[i:]]] = True
            left = i + np.flatnonzero(live[i:])
            place, columns, scores, live, i, dead = place[left], [c[left] for c in columns], scores[left], np.ones(len(left), bool), 0, 0
    return gone


def greedy_dedup(hashes: DataFrame, words: tuple[str, ...], score: str, threshold: int, key: str = "row_id") -> DataFrame:
    """Adds ``is_duplicate``; rows with a null hash are never compared and stay.

    ``hashes`` has key, bucket, hash words and score.  Buckets of one row need no Python.
    The hashes are written once and read three times.  The order within a bucket is the operator's meaning, so a bucket is one task's work.
    """
    schema = f"{key} long, is_duplicate boolean"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(key, kind="stable")
        gone = greedy_losers(rows[key].to_numpy(), rows[list(words)].to_numpy().astype(np.int64), rows[score].to_numpy(dtype=np.float64, na_value=np.nan), threshold)
        return pd.DataFrame({key: rows[key].to_numpy(), "is_duplicate": gone})

    hashes = Scratch(hashes.sparkSession, "dedup").keep(hashes, "hashes")
    hashed = hashes.where(F.col(words[0]).isNotNull())
    sizes = hashed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    gone = hashed.join(sizes, "bucket", "left_semi").select(key, "bucket", *words, F.col(score).cast("double").alias(score))
    n = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = gone.repartition(n, "bucket").groupBy("bucket").applyInPandas(run, schema)
    return hashes.join(gone, key, "left").withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(False)))
