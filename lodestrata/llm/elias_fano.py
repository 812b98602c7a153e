"""Token ids of documents in binary files with Elias-Fano encoded document boundaries.

A file is one contiguous byte string that a reader can map into memory::

    b"LSEF" | u32 id width | u64 documents | u64 ids | u32 low bits | u32 samples | u64 high bytes | u32 name bits | u32 flags | i64 least name
    low parts, bit-packed | high parts, unary | select samples | names, bit-packed | null names | ids

The boundaries are the ends of the documents in the concatenated ids.  Each keeps its ``low
bits`` lowest bits as they are; what is above goes into a bit vector in which the i-th one
stands at (end >> low bits) + i.  So n ends below u take about 2 + log2(u / n) bits each.
``select`` finds the i-th one from the sample of its block of ``SAMPLE`` ones and the
population counts of the bytes after it, and needs no table of 64-bit offsets; a whole block is
found by one look at the bits between two samples.  Names (doc_ids) take as many bits as their span needs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch, arrow_map, sized_batches
from lodestrata.llm._encode import encoder as shared_encoder
from lodestrata.sources import store

MAGIC = b"LSEF"
HEADER = struct.Struct("<4sIQQIIQIIq")
SAMPLE = 64
#: Ids in one file at most, unless one document has more.
FILE_IDS = 1 << 21


_NAMED, _NULLS = 1, 2


def _packed(values: np.ndarray, bits: int) -> bytes:
    """Unsigned 64-bit values in so many bits each."""
    return np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpacked(data: np.ndarray, first: int, n: int, bits: int) -> np.ndarray:
    """``n`` values from ``first`` on, which is the first of a block and so begins a byte."""
    at = first * bits // 8
    each = np.unpackbits(data[at : at + -(-n * bits // 8)], count=n * bits, bitorder="little").reshape(n, bits).astype(np.uint64)
    return (each << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def write_file(ids: list[bytes], kind: str, names: list[int | None] | None = None) -> bytes:
    """The bytes of a file that holds these documents' ids, and their names if given, in order."""
    width = np.dtype(kind).itemsize
    ends = np.cumsum(np.array([len(x) // width for x in ids], np.int64))
    n, total = len(ends), int(ends[-1]) if len(ends) else 0
    low_bits = max(0, (total // max(n, 1)).bit_length() - 1)
    ones = (ends >> low_bits) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    high_bytes = np.packbits(high, bitorder="little").tobytes()
    samples = ones[::SAMPLE].astype("<u4").tobytes()
    known = [x for x in names or () if x is not None]
    least = min(known, default=0)
    name_bits = (max(known, default=0) - least).bit_length()
    flags = (_NAMED if names is not None else 0) | (_NULLS if names is not None and len(known) < n else 0)
    tail = []
    if flags:
        tail.append(_packed(np.array([0 if x is None else x - least for x in names], np.uint64), name_bits))
    if flags & _NULLS:
        tail.append(np.packbits(np.array([x is None for x in names]), bitorder="little").tobytes())
    return b"".join([HEADER.pack(MAGIC, width, n, total, low_bits, len(samples) // 4, len(high_bytes), name_bits, flags, least), _packed(ends.astype(np.uint64), low_bits), high_bytes, samples, *tail, *ids])


class TokenFile:
    """Reads one file, whose bytes may be mapped, without unpacking its boundaries."""

    def __init__(self, data) -> None:
        magic, self.width, self.documents, self.total, self.low_bits, samples, high, self.name_bits, self.flags, self.least = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.kind = f"<u{self.width}"
        n, at = self.documents, HEADER.size

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.low = part("u1", -(-n * self.low_bits // 8))
        self.high = part("u1", high)
        self.samples = part("<u4", samples)
        self.packed_names = part("u1", -(-n * self.name_bits // 8) if self.flags else 0)
        self.nulls = part("u1", -(-n // 8) if self.flags & _NULLS else 0)
        self.ids = part(self.kind, self.total)

    def select(self, i: int) -> int:
        """Where the i-th one (from 0) of the high bits stands."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        head = int(self.high[byte]) >> (at % 8)
        if head.bit_count() > left:
            bits, base = head, at
        else:
            left -= head.bit_count()
            counts = np.cumsum(np.bitwise_count(self.high[byte + 1 : byte + 1 + 8 * SAMPLE]), dtype=np.int64)
            step = 8 * SAMPLE
            while counts[-1] <= left:  # a run of long documents: look further
                step *= 2
                counts = np.cumsum(np.bitwise_count(self.high[byte + 1 : byte + 1 + step]), dtype=np.int64)
            k = int(np.searchsorted(counts, left, "right"))
            left -= int(counts[k - 1]) if k else 0
            bits, base = int(self.high[byte + 1 + k]), 8 * (byte + 1 + k)
        for _ in range(left):
            bits &= bits - 1
        return base + (bits & -bits).bit_length() - 1

    def end(self, i: int) -> int:
        """Ids of the documents 0 to i together."""
        first = i * self.low_bits
        low = 0
        for k in range(self.low_bits):
            low |= ((int(self.low[(first + k) // 8]) >> ((first + k) % 8)) & 1) << k
        return ((self.select(i) - i) << self.low_bits) | low

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.end(i - 1) if i else 0 : self.end(i)]

    def blocks(self) -> Iterator[tuple[np.ndarray, list[int | None]]]:
        """For each block of ``SAMPLE`` documents their ends and names, in order."""
        for block, at in enumerate(self.samples.tolist()):
            first = block * SAMPLE
            n = min(SAMPLE, self.documents - first)
            stop = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.high)
            bits = np.unpackbits(self.high[at // 8 : -(-stop // 8)], bitorder="little")[at % 8 : at % 8 + stop - at]
            ones = at + np.flatnonzero(bits)
            low = _unpacked(self.low, first, n, self.low_bits).astype(np.int64)
            yield ((ones - np.arange(first, first + n)) << self.low_bits) | low, self._names(first, n)

    def _names(self, first: int, n: int) -> list[int | None]:
        if not self.flags:
            return [None] * n
        names = (_unpacked(self.packed_names, first, n, self.name_bits) + np.uint64(self.least % (1 << 64))).view(np.int64).tolist()
        if self.flags & _NULLS:
            nulls = np.unpackbits(self.nulls[first // 8 : -(-(first + n) // 8)], count=n, bitorder="little")
            names = [None if gone else x for x, gone in zip(names, nulls.tolist(), strict=True)]
        return names

    def ends(self) -> np.ndarray:
        """All ends at once."""
        return np.concatenate([np.empty(0, np.int64), *(ends for ends, _ in self.blocks())])


def open_file(root: str, name: str) -> TokenFile:
    """One of the files below a folder; from a local disk it is mapped, not read."""
    if store.is_local(root):
        return TokenFile(pa.memory_map(f"{store.open_store(root)[1]}/{name}").read_buffer())
    return TokenFile(store.get_bytes(f"{root}/{name}"))


_FILES = "part int, file int, name string, first long, n_ids long"


def _encoded(path: str, end_id: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(path), TaskContext.get().partitionId()
        end, width = np.array([end_id], encoder.kind).tobytes(), np.dtype(encoder.kind).itemsize
        names, held, size, rows, first = [], [], 0, [], 0

        def done() -> None:
            name = f"part-{part:05d}-{len(rows):05d}.lsef"
            store.put_bytes(f"{folder}/{name}", write_file(held, encoder.kind, names))
            rows.append((part, len(rows), name, first, size))

        for batch in sized_batches(batches, "text"):
            for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).cast(pa.binary()).to_pylist()), strict=True):
                n = len(ids) // width + 1
                if held and size + n > FILE_IDS:
                    done()
                    names, held, first, size = [], [], first + size, 0
                names.append(name)
                held.append(ids + end)
                size += n
        if held:
            done()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["part", "file", "name", "first", "n_ids"])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, order: list[Column] | None = None) -> None:
    """Encode whole texts into files below ``path``/files, in ascending order of ``order`` (doc_id), listed by the table ``path``/list.

    The list has a row (part, file, name, first, n_ids) for each file; parts and files
    are in order; ``first`` counts the ids of the part before the file.  A task writes its files under other
    names and moves them into place, so a lost or repeated one leaves no half-written file; what the list
    does not name is no part of the result.  Nulls come first; rows of equal order are ordered by their
    text.  A null text is empty: it has the end id alone.  An empty table makes no file.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").cast("long")] if order is None else order
    keys = [f"o{i}" for i in range(len(order))] + ["tie"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c.alias(k) for c, k in zip(order, keys, strict=False)]).withColumn("tie", F.xxhash64("text"))
    ordered = docs.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "text").select("doc_id", "text")
    arrow_map(ordered, _encoded(tokenizer, end_id, f"{path}/files"), _FILES, "encoder").write.mode("overwrite").parquet(f"{path}/list")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = open_file(folder, name)
                names, starts, sizes, crcs, at = [], [], [], [], 0
                for ends, some in file.blocks():
                    names += some
                    for end in ends.tolist():
                        starts.append(begin + at)
                        sizes.append(end - at)
                        crcs.append(zlib.crc32(file.ids[at:end].astype("<u4")))
                        at = end
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (names, starts, sizes, crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(spark, path: str) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The driver gathers one number for each part (range partition) to know where parts begin.
    """
    files = spark.read.schema(_FILES).parquet(f"{path}/list")
    sums = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    begins, total = [], 0
    for part in sorted(sums):
        begins.append((part, total))
        total += sums[part]
    bases = spark.createDataFrame(begins, "part int, base long")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = files.repartition(n, "part", "file").join(F.broadcast(bases), "part").select((F.col("base") + F.col("first")).alias("begin"), "name")
    return arrow_map(held, _read(f"{path}/files"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, order: list[Column] | None = None) -> DataFrame:
    """Write the files into the scratch folder and read them again."""
    scratch = Scratch(docs.sparkSession, "elias-fano")
    write_token_files(docs, scratch.path("tokens"), tokenizer, end_id, order)
    return read_token_files(docs.sparkSession, scratch.path("tokens"))
