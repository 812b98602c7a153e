"""What the operators of this subpackage share: scratch tables, text bytes, word hashes.

Scratch tables are Parquet folders below the shared folder that the session names
in ``spark.checkpoint.dir``; a lost executor costs only the tasks it ran, since
every later stage reads the written table again.  They are deleted when the driver's process ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch  # noqa: F401  all operators take it from here

WORD_CACHE_ENTRIES = 200_000
#: Bytes of one batch that goes to a Python worker; the session's own bound, if smaller, stays.
ARROW_BYTES = 8 << 20
pa.set_memory_pool(pa.system_memory_pool())  # gives freed batches back to the system


#: What this Python worker keeps between tasks, by the name of what needs it.
CACHES: dict[str, dict] = {}


def _trimmed(keep: str = "", clear: bool = False) -> None:
    """Give memory back to the system; with ``clear``, also what tasks of other kinds have kept."""
    for name, cache in CACHES.items():
        if clear and name != keep:
            cache.clear()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(df: DataFrame, run: Callable, ddl: str, keep: str = "") -> DataFrame:
    """mapInArrow with batches of a bounded size, which the session keeps from then on.

    Python workers are used again by other operators: a task starts without the caches of
    other kinds than ``keep`` and gives free memory back when it ends.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _trimmed(keep, True)
        yield from run(batches)
        _trimmed()

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark = df.sparkSession
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))
    return df.mapInArrow(task, ddl)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def plain_words_table() -> bytes:
    """For bytes.translate: lower-cases A-Z and blanks all but 0-9, a-z and bytes from 0x80 on."""
    table = bytearray(i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
    table[65:91] = range(97, 123)
    return bytes(table)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen last; the hash does not depend on the process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, so that working memory does not follow the batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_batches(batches: Iterator[pa.RecordBatch], name: str, most: int = 1 << 20, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices whose texts in column ``name`` have about ``most`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = min(max(int(np.searchsorted(ends, base + most, "right")), at + 1), at + rows)
            yield batch.slice(at, to - at)
            at = to


def scan_texts(docs: DataFrame, make: Callable[[], Callable], report: pa.Schema, ddl: str, carry: list[str] | None = None, keep: str = "") -> DataFrame:
    """Map whole texts to the columns of ``report``, in one pass without a shuffle.

    ``make`` is called once in each task and returns a function of (texts as bytes, arrays of
    the carried columns) that returns one array for each field of ``report``.  The columns
    ``carry`` of ``docs`` come along as c0, c1, ... so that no name can clash.
    """
    carry = ["doc_id"] if carry is None else carry
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col("text").cast("string").alias("text"))
    kinds = [f"c{i} {inner.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in sized_batches(batches, "text"):
            kept = [batch.column(i) for i in range(len(carry))]
            found = work(column_bytes(batch, "text"), kept)
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[f"c{i}" for i in range(len(carry))] + report.names)

    return arrow_map(inner, run, ", ".join([*kinds, ddl]), keep)
