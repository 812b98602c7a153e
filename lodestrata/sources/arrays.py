"""Exchange of vectors and tensors with ``.npy`` files; rows never pass the driver."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.sources import store
from lodestrata.sources.images import with_row_id

ROWS_AT_ONCE = 4096


def _header(dtype: np.dtype, shape: tuple[int, ...]) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(dtype), "fortran_order": False, "shape": shape})
    return out.getvalue()


def export_npy(df: DataFrame, path: str, column: str, order: str, dtype: str, shape: tuple[int, ...], packed: bool = False) -> int:
    """Write a column, in order, as one ``.npy`` array: each task writes its rows at their places in the file.

    A null is all zeros (texts: empty).  ``dtype`` "U" takes the longest text's length.  On a store whose files
    can't be written at places, the array is a folder of ``.npy`` files named by their first row.
    """
    n = df.count()
    if dtype == "U":
        dtype = f"<U{df.agg(F.max(F.length(column)).alias('n')).head()['n'] or 1}"
    kind = np.dtype(dtype)
    head, each = _header(kind, (n, *shape)), kind.itemsize * int(np.prod(shape))
    local, (_, at) = store.is_local(path), store.open_store(path)
    temp = f"{at}.{uuid.uuid4().hex}"
    if local:
        Path(temp).parent.mkdir(parents=True, exist_ok=True)
        with open(temp, "wb") as f:
            f.write(head)
            f.truncate(len(head) + n * each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            places, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            data = np.zeros((len(values), *shape), kind)
            for i, v in enumerate(values):
                if v is not None:
                    data[i] = np.frombuffer(v, kind).reshape(shape) if packed else np.asarray(v, kind)
            cuts = [0, *(np.flatnonzero(np.diff(places) != 1) + 1).tolist(), len(places)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y > x and local:
                    with open(temp, "r+b") as f:
                        f.seek(len(head) + int(places[x]) * each)
                        f.write(data[x:y].tobytes())
                elif y > x:
                    store.put_bytes(f"{path}/part-{int(places[x]):012d}.npy", npy_bytes(data[x:y]))
            done += len(values)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    with_row_id(df.select(order, column), order).select("row_id", column).mapInArrow(run, "n long").agg(F.sum("n")).head()
    if local:
        Path(temp).replace(at)
    return n


def import_npy(spark: SparkSession, path: str, column: str = "embedding") -> DataFrame:
    """row_id and an array column from a two-dimensional ``.npy`` file; each task reads its own byte range."""
    files, at = store.open_store(path)
    with files.open_input_file(at) as f:
        head = io.BytesIO(f.read(1 << 16))
        version = np.lib.format.read_magic(head)
        shape, fortran, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(head)
    begin = head.tell()
    if fortran or len(shape) != 2:
        raise ValueError(f"{path}: a two-dimensional array in C order is needed")
    n, dim = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = store.open_store(path)
        with files.open_input_file(at) as f:
            for batch in batches:
                for first in batch.column(0).to_pylist():
                    rows = min(ROWS_AT_ONCE, n - first)
                    data = np.frombuffer(f.read_at(rows * dim * kind.itemsize, begin + first * dim * kind.itemsize), kind).astype(np.float32)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * dim, pa.int32()), pa.array(data))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + rows)), lists], names=["row_id", column])

    parts = max(1, min(-(-n // ROWS_AT_ONCE), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, n, ROWS_AT_ONCE, parts).mapInArrow(run, f"row_id long, {column} array<float>")


def npy_bytes(values: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, values, allow_pickle=False)
    return out.getvalue()


def read_npy_files(spark: SparkSession, root: str) -> DataFrame:
    """image_id, shape and half-precision content of single-tensor files below ``root``."""
    import pandas as pd

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npy").load(root)

    def run(frames):
        for frame in frames:
            arrays = [np.load(io.BytesIO(c), allow_pickle=False) for c in frame["content"]]
            arrays = [a[0] if a.ndim and a.shape[0] == 1 else a for a in arrays]
            yield pd.DataFrame({"image_id": [Path(p).stem for p in frame["path"]], "shape": [list(a.shape) for a in arrays], "latent": [a.astype(np.float16).tobytes() for a in arrays]})

    return files.select("path", F.col("content")).mapInPandas(run, "image_id string, shape array<int>, latent binary")
