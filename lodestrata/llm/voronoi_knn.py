"""Exact top-k by inner product with a Voronoi-partitioned kNN join.

A bounded sample of vectors serves as pivots; every vector belongs to the cell of its nearest
pivot.  Summaries of the cells (rows, radius) bound the scores between any query and any
vector of two cells from both sides.  For each query cell they give a score that its k-th best
result surely reaches, and a vector is sent to a group of queries only if it may
reach that score for one of the group's cells.  A group's queries and a chunk of the vectors
sent to it are solved by one exact matrix product; the chunks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch, arrow_map

#: Pivots: a bounded sample, those with the smallest hashes of their vectors.
MAX_PIVOTS = 256
#: Queries and vectors that one task solves at most, or nearly so (vectors are dealt by hash).
QUERY_ROWS = 1024
CHUNK_ROWS = 16_384
MOST = 2.0**62
LONG = 2**63 - 1
_UNIT = pa.schema([("query_uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])


def _unpacked(cells: list[bytes]) -> np.ndarray:
    """Equally long integer vectors packed as 64-bit numbers."""
    return np.frombuffer(b"".join(cells), np.int64).reshape(len(cells), -1) if cells and cells[0] else np.zeros((len(cells), 0), np.int64)


def _by_width(cells: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of packed vectors, those of one length together."""
    sizes = np.array([len(c) for c in cells], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, _unpacked([cells[i] for i in at])


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products; of vectors of different lengths the longer one's further components count nothing."""
    k = min(x.shape[1], y.shape[1])
    return x[:, :k] @ y[:, :k].T


def _lengths(cells: list[bytes]) -> np.ndarray:
    out = np.zeros(len(cells))
    for at, x in _by_width(cells):
        out[at] = np.linalg.norm(x.astype(np.float64), axis=1)
    return out


def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for v in batch.column(1):
                x = v.values.to_numpy(zero_copy_only=False) if v.is_valid else None
                good = x is not None and v.values.null_count == 0 and bool(np.isfinite(x).all())
                keep.append(good)
                if good:
                    with np.errstate(over="ignore"):
                        out.append(np.clip(np.floor(x.astype(np.float64) * scale), -MOST, MOST).astype(np.int64).tobytes())
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2), kept.column(3), pa.array(out, pa.binary())], names=["vec_id", "uid", "is_query", "q"])

    return run


def _celled(pivots: np.ndarray):
    norms = np.linalg.norm(pivots, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for at, x in _by_width(batch.column(3).to_pylist()):
                x = x.astype(np.float64)
                size = np.linalg.norm(x, axis=1)
                far = np.maximum(size[:, None] ** 2 + norms**2 - 2 * _products(x, pivots), 0)
                cell[at] = far.argmin(axis=1)
                # No shorter than it is, whatever the rounding of the squares.
                distance[at] = np.sqrt(far[np.arange(len(x)), cell[at]]) + 1e-7 * (size + norms[cell[at]])
            names = [*batch.schema.names, "cell", "distance"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(distance)], names=names)

    return run


class _Group(NamedTuple):
    """A group of queries: its cells, which share of a large cell's queries it has, the cells that it needs, and the chunks of their vectors."""

    cells: list[int]
    turn: int
    of: int
    needed: list[int]
    chunks: int


def _sent(pivots: np.ndarray, cells: dict[int, tuple[float, float]], groups: list[_Group]):
    """Rows for each group that needs a vector, and the queries for each chunk of their group; a group at a time, so memory does not follow their number."""
    norms = np.linalg.norm(pivots, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = batch.column(3).to_pylist()
            size, dots = _lengths(packed), np.zeros((batch.num_rows, len(pivots)))
            for at, x in _by_width(packed):
                dots[at] = _products(x.astype(np.float64), pivots)
            cell, uid = batch.column(4).to_numpy(), batch.column(1).to_numpy()
            ask = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            turns = uid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            rows = batch.select([0, 1, 3])

            def out(at: np.ndarray, g: int, part: np.ndarray, kind: int) -> pa.RecordBatch:
                taken = rows.take(pa.array(at))
                return pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.full(len(at), g, np.int32)), pa.array(part.astype(np.int64)), pa.array(np.full(len(at), kind, np.int8))], names=["vec_id", "uid", "q", "unit", "chunk", "kind"])

            for g, group in enumerate(groups):
                wanted = np.zeros(len(size), bool)
                for i in group.cells:
                    radius, reach = cells[i]
                    wanted |= dots[:, i] + (radius + 1e-9 * norms[i]) * size >= reach
                at = np.flatnonzero(wanted & np.isin(cell, group.needed))
                if len(at):
                    yield out(at, g, turns[at] % np.uint64(group.chunks), 0)
                asks = np.flatnonzero(ask & np.isin(cell, group.cells))
                asks = asks[chunk_of(uid[asks], group.of) == group.turn]
                for chunk in range(group.chunks if len(asks) else 0):
                    yield out(asks, g, np.full(len(asks), chunk), 1)

    return run


def chunk_of(uid: np.ndarray, of: int) -> np.ndarray:
    """Which share of a large cell's queries a row is in."""
    return (uid.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(35)) % np.uint64(of)


def _solved(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        vec_id, uid = table["vec_id"].to_numpy(), table["uid"].to_numpy()
        packed = table["q"].to_pylist()
        data = np.flatnonzero(kind == 0)
        data = data[np.lexsort((uid[data], vec_id[data]))]  # so that equal scores stand by vec_id
        asks = np.flatnonzero(kind == 1)
        if not len(data) or not len(asks):
            return _UNIT.empty_table()
        out = []
        parts = [(at, x, int(np.abs(x).max(initial=0))) for at, x in _by_width([packed[i] for i in data])]
        for places, q in _by_width([packed[i] for i in asks]):
            most = int(np.abs(q).max(initial=0))
            for at in range(0, len(places), 64):
                some = q[at : at + 64]
                bound = max(most * m * min(q.shape[1], x.shape[1]) for _, x, m in parts)
                # Doubles add integers exactly up to 2**53, longs up to 2**63; beyond, Python's own integers do.
                kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
                scores = np.zeros((len(some), len(data)), object if kind is object else np.int64)
                for cols, x, _ in parts:
                    scores[:, cols] = _products(some.astype(kind), x.astype(kind))
                if kind is object:
                    scores = np.clip(scores, -LONG - 1, LONG).astype(np.int64)
                for j, row in enumerate(scores):
                    i = asks[places[at + j]]
                    others = np.flatnonzero(uid[data] != uid[i])
                    row = row[others]
                    least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else np.iinfo(np.int64).min
                    best = np.flatnonzero(row >= least)
                    best = best[np.lexsort((best, ~row[best]))][:k]  # ~ turns the order of longs round
                    out.append((np.full(len(best), uid[i]), np.full(len(best), vec_id[i]), vec_id[data[others[best]]], uid[data[others[best]]], row[best]))
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], schema=_UNIT)

    return run


def _bounds(pivots: np.ndarray, sizes: dict[int, tuple[int, float]], queries: dict[int, tuple[int, float]], k: int) -> tuple[dict[int, float], dict[int, set[int]]]:
    """For each query cell, a score that its k-th best result reaches, and the cells that may reach it."""
    lengths = np.linalg.norm(pivots, axis=1)
    reach, needed = {}, {}
    for i, (_, rq) in queries.items():
        low, high = {}, {}
        for j, (_, r) in sizes.items():
            mid, slack = float(pivots[i] @ pivots[j]), rq * lengths[j] + r * lengths[i] + rq * r
            slack += 1e-9 * (1 + lengths[i] * lengths[j] + slack)  # for rounding
            low[j], high[j] = mid - slack, mid + slack
        have, reach[i] = 0, -np.inf
        for j in sorted(low, key=low.get, reverse=True):
            have += sizes[j][0]
            if have > k:  # one may be the query itself
                reach[i] = low[j]
                break
        needed[i] = {j for j in sizes if high[j] >= reach[i]}
    return reach, needed


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    ``vectors`` needs vec_id and embedding.  Components become floor(scale * x); the score is
    their integer inner product, ties go to the smaller vec_id.  Every row but the query's
    own is a candidate; with fewer than k, all are returned.  Rows whose vec_id or vector is null, or
    whose vector has a null or non-finite component, take no part.  Of vectors of different lengths the
    shorter one counts as filled up with zeros.  Rows that repeat a vec_id are rows of their own, as
    queries and as candidates.  Products are exact; quantised components beyond 2**62, and scores that no
    long can hold, are held at these ends.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "voronoi")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where("vec_id is not null and v is not null").select("vec_id", "v", F.monotonically_increasing_id().alias("uid"), "is_query")
    packed = scratch.keep(arrow_map(rows, _quantised(scale), "vec_id long, uid long, is_query boolean, q binary"), "packed")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n = packed.count()
    if not n:
        return empty
    sample = [bytes(r["q"]) for r in packed.groupBy("q").agg(F.xxhash64("q").alias("h")).orderBy("h", "q").limit(int(np.clip(np.sqrt(n) / 4, 1, MAX_PIVOTS))).collect()]
    pivots = np.zeros((len(sample), max(map(len, sample)) // 8))
    for at, x in _by_width(sample):
        pivots[at, : x.shape[1]] = x
    celled = scratch.keep(arrow_map(packed, _celled(pivots), "vec_id long, uid long, is_query boolean, q binary, cell int, distance double"), "celled")
    scratch.drop("packed")
    found = celled.groupBy("cell", "is_query").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()
    sizes: dict[int, tuple[int, float]] = {}
    for r in found:
        held = sizes.get(r["cell"], (0, 0.0))
        sizes[r["cell"]] = (held[0] + r["n"], max(held[1], r["radius"]))
    queries = {r["cell"]: (r["n"], r["radius"]) for r in found if r["is_query"]}
    if not queries:
        return empty
    reach, needed = _bounds(pivots, sizes, queries, k)
    # Groups of cells with few queries; a cell with many is split by hash.
    members: list[tuple[list[int], int, int]] = []
    now, held = [], 0
    for i in sorted(queries):
        m = queries[i][0]
        if m > QUERY_ROWS:
            of = -(-m // QUERY_ROWS)
            members += [([i], turn, of) for turn in range(of)]
            continue
        if held + m > QUERY_ROWS and now:
            members.append((now, 0, 1))
            now, held = [], 0
        now, held = [*now, i], held + m
    if now:
        members.append((now, 0, 1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = []
    for own, turn, of in members:
        want = sorted(set().union(*(needed[i] for i in own)))
        rows_wanted = sum(sizes[j][0] for j in want)
        chunks = max(-(-rows_wanted // CHUNK_ROWS), min(-(-parts // len(members)), -(-rows_wanted // 1024)))
        groups.append(_Group(own, turn, of, want, chunks))
    sent = arrow_map(celled, _sent(pivots, {i: (queries[i][1], reach[i]) for i in queries}, groups), "vec_id long, uid long, q binary, unit int, chunk long, kind tinyint")
    best = sent.groupBy("unit", "chunk").applyInArrow(_solved(k), "query_uid long, query_id long, vec_id long, uid long, score long")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
