"""Token counts of documents in flat token files, by a scan for end-of-document ids.

A flat file is a run of ids without any index; it is read in blocks of equal size that know
nothing of documents.  Each block is searched for the end id in one vectorised comparison and
gives a summary: its ids, its ends, and what stands before the first and after the last end.  A
prefix scan over the summaries, within runs of ``RUN`` blocks and then over the runs, tells
how many documents ended before a block and how many ids of an open document enter it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch, arrow_map, sized_batches
from lodestrata.llm._encode import encoder as shared_encoder

BLOCK_IDS = 1 << 19
RUN = 1024


def _flat(path: str, end_id: int, block_ids: int):
    schema = pa.schema([("file", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("ordinal", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = shared_encoder(path, False), TaskContext.get().partitionId()
        end, size = np.array([end_id], encoder.kind).tobytes(), block_ids * np.dtype(encoder.kind).itemsize
        block = ordinal = 0
        rest = b""
        for batch in sized_batches(batches, "text"):
            names = batch.column(0).to_pylist()
            rest = b"".join([rest, *(x + end for x in encoder.encode(batch.column(1).cast(pa.binary()).to_pylist()))])
            rows = [(file, None, None, ordinal, names)]
            ordinal += len(names)
            for at in range(0, len(rest) - size + 1, size):
                rows.append((file, block, rest[at : at + size], None, None))
                block += 1
            rest = rest[len(rest) // size * size :]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
        if rest:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (file, block, rest, None, None), strict=True))], schema)

    return run


def write_flat_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode whole texts into flat files of ids, one for each input partition.

    Rows with ``ids`` are the files' blocks (file, block, ids); the others list the doc_ids in the
    order written, from ``ordinal`` on, for naming the results; the scan itself reads blocks
    only.  Strings of special tokens are encoded as ordinary text, so the end id occurs only
    at ends.  A null text is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    flat = arrow_map(docs, _flat(tokenizer, end_id, block_ids), "file int, block long, ids binary, ordinal long, doc_ids array<bigint>", "encoder")
    flat.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _summaries(end_id: int, kind: str):
    schema = pa.schema([("file", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("ends", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()), ("inner", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, block, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(data, kind)
                at = np.flatnonzero(ids == end_id)
                rows.append((file, block, len(ids), len(at), int(at[0]) if len(at) else len(ids), len(ids) - 1 - int(at[-1]) if len(at) else len(ids), np.diff(at) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _scanned(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """Adds, over the rows of a key before each: ends so far, and ids since the last end with whether there was one."""
    before = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    rows = rows.withColumn("start", start).withColumn("ends_before", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    last = F.last(F.when(F.col("ends") > 0, F.col("start") + F.col("n") - F.col("tail")), ignorenulls=True).over(before)
    rows = rows.withColumn("last_end", last)
    return rows.withColumn("open", F.col("start") - F.coalesce("last_end", F.lit(0))).withColumn("ended", F.col("last_end").isNotNull())


def token_counts(blocks: DataFrame, end_id: int, kind: str = "<u2") -> DataFrame:
    """One row for each document: file, ordinal (from 0 in the file), n_tokens without its end.

    ``blocks`` needs file, block and ids.  Ids after a file's last end are a document without
    an end and give a row too.  Empty files give no row.
    """
    scratch = Scratch(blocks.sparkSession, "separator-scan")
    s = arrow_map(blocks.select("file", "block", "ids"), _summaries(end_id, kind), "file int, block long, n long, ends long, head long, tail long, inner array<bigint>")
    s = scratch.keep(s.withColumn("run", F.floor(F.col("block") / RUN)), "summaries")
    within = _scanned(s, ["file", "run"], "block")
    # A run as one block: what stands after its last end, or all its ids.
    whole = s.groupBy("file", "run").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"), F.max(F.when(F.col("ends") > 0, F.struct("block", "tail"))).alias("last"), F.max("block").alias("stop"))
    after = s.join(whole.select("file", "run", F.col("last.block").alias("from")), ["file", "run"]).where("block > from").groupBy("file", "run").agg(F.sum("n").alias("more"))
    whole = whole.join(after, ["file", "run"], "left").withColumn("tail", F.coalesce(F.col("last.tail") + F.coalesce("more", F.lit(0)), F.col("n")))
    over = _scanned(whole.select("file", "run", "n", "ends", "tail"), ["file"], "run").select("file", "run", F.col("ends_before").alias("ends_over"), F.col("open").alias("open_over"))
    at = within.join(over, ["file", "run"])
    at = at.withColumn("base", F.col("ends_over") + F.col("ends_before")).withColumn("carry", F.col("open") + F.when(F.col("ended"), F.lit(0)).otherwise(F.col("open_over")))
    first = F.array(F.col("carry") + F.col("head"))
    closed = at.where("ends > 0").select("file", "base", F.posexplode(F.concat(first, "inner")).alias("i", "n_tokens")).select("file", (F.col("base") + F.col("i")).alias("ordinal"), "n_tokens")
    final = at.groupBy("file").agg(F.max(F.struct("block", F.col("base").alias("b"), "ends", "tail", "carry", "n")).alias("z")).select(
        "file", (F.col("z.b") + F.col("z.ends")).alias("ordinal"), F.when(F.col("z.ends") > 0, F.col("z.tail")).otherwise(F.col("z.carry") + F.col("z.n")).alias("n_tokens")
    )
    return closed.unionByName(final.where("n_tokens > 0"))


def counted_documents(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Token counts of documents through flat files in the scratch folder: doc_id, n_tokens.

    Rows repeat as in ``docs``; a null or empty text has 0 tokens; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "separator-scan")
    write_flat_files(docs, scratch.path("flat"), tokenizer, end_id, block_ids)
    flat = spark.read.parquet(scratch.path("flat"))
    kind = shared_encoder(tokenizer, False).kind
    counts = token_counts(flat.where("ids is not null"), end_id, kind)
    listed = flat.where("ids is null").select("file", "ordinal", F.posexplode("doc_ids").alias("i", "doc_id")).select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), "doc_id")
    return listed.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
