"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Null and empty texts, null and repeated ids pass through the filters as the stages' docstrings say: without words a text is not
toxic, has no near duplicate and no leak; the mix takes words, so such rows are not in it, nor in the
token files.  Extra columns of ``documents`` are not read; an empty table gives empty results at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch
from lodestrata.llm.curriculum import mixed_documents
from lodestrata.llm.decontam import leaked_passages, with_verdict
from lodestrata.llm.elias_fano import token_files_round_trip
from lodestrata.llm.minhash_dedup import near_duplicates
from lodestrata.llm.toxicity import toxicity_scores

#: Documents with at least this toxicity score are rejected.
TOXIC = 0.3
#: Words of a benchmark passage that no kept document holds.
WINDOW = 13
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Not expressible in SQL: the stages learn weights, sample hash functions and run a tokenizer.  Tests hold them against brute force.
ORACLE_SQL = None


def _carried(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents' own columns, which an operator carried along as c0, c1, ..."""
    return found.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects.

    It learns from labelled rows of ``docs``, a bounded sample if there are more than ``MAX_TRAIN_DOCS``
    of them, and scores these rows like all others.  Documents without words or text stay.
    """
    scored = toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=docs.columns)
    return _carried(scored.where(F.col("score") < TOXIC), docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that with the smallest doc_id, of equal ones that with the smallest digest of its text.

    Rows are told apart by a number of their own, so repeated rows and null ids are copies like any others.
    """
    scratch = Scratch(spark, "near-duplicates")
    rows = scratch.keep(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), percent=80).select(F.col("doc_id").alias("row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.md5(F.col("text").cast("binary")), "row").alias("rank")
    kept = found.join(rows.select("row", rank), "row").groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage.

    That is a run of at least ``WINDOW`` hit words, however long the document, or hit words that make up
    a twentieth of it.  Items shorter than a window that are less of a document are taken for chance: it stays as it is.
    """
    found = leaked_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), WINDOW, carry=docs.columns)
    run = F.exists(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x - F.get("spans", i - 1))), lambda n: F.coalesce(n >= WINDOW, F.lit(False)))
    return _carried(with_verdict(found).where(~F.col("contaminated") & ~run), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: every copy of a document that the mix takes, in training order."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the mix into token files, in training order, and list what they hold.

    The training order is that of the rows in the written mix: its part files, and the rows in each.
    """
    import public_tokenizers

    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    return token_files_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, order=order)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between each two."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
