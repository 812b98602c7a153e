"""The registered queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import oracles
from lodestrata.llm.ctw_lm import scored_texts
from lodestrata.llm.curriculum import planned, position
from lodestrata.llm.decontam import leaked_passages, with_verdict
from lodestrata.llm.elias_fano import token_files_round_trip
from lodestrata.llm.html_templates import main_texts
from lodestrata.llm.minhash_dedup import near_duplicates
from lodestrata.llm.secrets import digests, found_secrets
from lodestrata.llm.separator_scan import counted_documents
from lodestrata.llm.toxicity import fold, toxicity_scores
from lodestrata.llm.voronoi_knn import top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_ctw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(fold(F.col("doc_id")) % 7 == 2, F.lit(False))
    scored = scored_texts(_table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_elias_fano_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_round_trip(_table(spark, sf_dir, "documents"), _tokenizer(), end_id=1)


def op5_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_verdict(leaked_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))
    return found.select(F.col("c0").alias("doc_id"), F.col("words").alias("n_words"), "n_hit", "n_items", "items_sha256", "contaminated")


def op6_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, held = _table(spark, sf_dir, "labels"), F.coalesce(fold(F.col("doc_id")) % 4 == 2, F.lit(False))
    scored = toxicity_scores(_table(spark, sf_dir, "documents"), labels, ~held).withColumnRenamed("c0", "doc_id")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_documents(_table(spark, sf_dir, "documents"), _tokenizer(), end_id=49407)


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = planned(_table(spark, sf_dir, "documents"))
    first = F.least("taken", "size")
    at = F.when(F.col("taken") > 0, F.round(position(F.col("start"), first, F.col("target"), F.col("tilt")), 9))
    return plan.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", at.alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op9_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(found_secrets(_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_voronoi_topk": op2_voronoi_topk,
    "op3_ctw_scores": op3_ctw_scores,
    "op4_elias_fano_token_files": op4_elias_fano_token_files,
    "op5_wu_manber_decontamination": op5_wu_manber_decontamination,
    "op6_ftrl_toxicity": op6_ftrl_toxicity,
    "op7_separator_scan": op7_separator_scan,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_html_templates": op9_html_templates,
    "op10_secret_ownership": op10_secret_ownership,
}
ORACLES: dict[str, str] = {
    "op1_minhash_dedup": oracles.OP1,
    "op2_voronoi_topk": oracles.OP2,
    "op5_wu_manber_decontamination": oracles.OP5,
    "op8_curriculum_mix": oracles.OP8,
    "op10_secret_ownership": oracles.OP10,
}
