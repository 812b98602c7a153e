"""The curation run: stages as a graph over written tables, with resume, selection and dry run.

Caption, embedding and latent stages depend on the filtered table only, so a run may select any of them.
"""

from __future__ import annotations

import argparse
import json
import logging
import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.config import REQUIRED, CurationConfig, load_config
from lodestrata.functions.hashing import bucket_of, perceptual_hash
from lodestrata.functions.text import path_stem, strip_caption
from lodestrata.functions.vectors import l2_normalised
from lodestrata.logs import stage_logger
from lodestrata.operators import cluster as C
from lodestrata.operators import models as M
from lodestrata.operators import quality as Q
from lodestrata.operators import validate as V
from lodestrata.operators.dedup import greedy_dedup
from lodestrata.operators.filters import reject_reason, rejection_counts, unsafe
from lodestrata.operators.joins import attach, missing, require_all
from lodestrata.operators.manifest import build_manifest, quality_report, shard_health, write_json
from lodestrata.operators.normalize import with_sidecar
from lodestrata.operators.shards import assign_shards, metadata_json
from lodestrata.sources.arrays import export_npy, npy_bytes
from lodestrata.sources.images import cropped, image_structs, list_images, read_sidecars, store_images, with_row_id
from lodestrata.sources.index import load_index
from lodestrata.sources.store import exists, files_below, put_bytes
from lodestrata.sources.tables import read_document, read_table, write_table
from lodestrata.sources.tar_shards import write_tars

#: Channels, height and width of a latent.
LATENT = (4, 32, 32)
LOG = logging.getLogger("lodestrata")


class Run:
    """One run: its session, settings and tables below ``work_dir``."""

    def __init__(self, spark: SparkSession, config: CurationConfig) -> None:
        self.spark, self.config = spark, config

    def path(self, name: str) -> str:
        return f"{self.config.work_dir}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def model(self, df: DataFrame, factory: Callable, source: str, target: str, kind: str, batch: int = 64) -> DataFrame:
        """A model's results; with ``gpus`` its stage asks for such resources."""
        return M.apply_model(df, factory, source, target, kind, batch, M.gpu_profile(self.config.gpus) if self.config.gpus > 0 else None)

    def grown(self, source: DataFrame, name: str, make: Callable[[DataFrame], DataFrame], model: str) -> None:
        """Rows of ``source`` that ``name`` has no result of this model for: a rerun does only what is missing."""
        target = self.path(name)
        done = self.spark.read.parquet(target).where(F.col("model") == model).select("image_path") if _exists(self.spark, target) else None
        todo = source if done is None else missing(source, done, "image_path")
        make(todo).withColumn("model", F.lit(model)).write.mode("append").parquet(target)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def download(run: Run) -> dict:
    """Load the index, fetch its images into shard folders with sidecars, and crop them into ``image_dir``; each part is made once."""
    c = run.config
    if not c.fetch:
        raise V.ValidationError("an index needs fetch, a function of a url")
    if not _exists(run.spark, f"{run.path('fetched')}/_SUCCESS"):
        candidates = load_index(run.spark, c, c.index_streaming)
        got = store_images(candidates, run.path("downloads"), M.named(c.fetch, None), c.fetch_threads, c.fetch_retries)
        write_table(got, run.path("fetched"))
    if not _exists(run.spark, f"{run.path('crops')}/_SUCCESS") and run.table("fetched").where("error is null").head(1):
        write_table(cropped(run.spark, run.path("downloads"), c.image_dir, c.image_size), run.path("crops"))
    errors = run.table("fetched").agg(F.count("*").alias("n"), F.count("error").alias("bad")).head()
    return {"candidates": errors["n"], "fetch_errors": errors["bad"]}


def ingest(run: Run) -> dict:
    """Fetch the images of an index, if there is one; list them, join their sidecars, number them in the order of kind and path."""
    fetched = download(run) if run.config.index_path else {}
    images = list_images(run.spark, run.config.image_dir)
    rows = with_sidecar(images, read_sidecars(run.spark, run.config.image_dir), run.config.min_aesthetic_score)
    rows = rows.join(images.select("image_path", "ext_rank"), "image_path")
    rows = with_row_id(rows, "ext_rank", "image_path").drop("ext_rank").withColumn("image_id", path_stem(F.col("image_path")))
    write_table(rows, run.path("raw"))
    V.check_ingest(run.table("raw"), run.config.min_aesthetic_score)
    n = run.table("raw").count()
    return {"requested": run.config.num_samples, "downloaded": n, "failed": max(run.config.num_samples - n, 0)} | fetched


def filter_and_dedup(run: Run) -> dict:
    """The cascade on decoded sizes and scores, the unsafe-content model on survivors, then removal of near duplicates."""
    c = run.config
    # One pass over the images: sizes and hashes come from where they are read, and no pixels are shuffled.
    image = image_structs(run.spark, c.image_dir)
    write_table(image.select("image_path", F.col("image.width").alias("width"), F.col("image.height").alias("height"), perceptual_hash(F.col("image"), c.phash_size).alias("hash")), run.path("hashes"))
    sized = run.table("raw").join(run.table("hashes"), "image_path", "left")
    reasoned = sized.withColumn("reject_reason", reject_reason(F.col("width"), F.col("height"), F.col("aesthetic_score"), c.min_resolution, c.max_aspect_ratio, c.min_aesthetic_score))
    # The model sees survivors only: they are written first, so that its results are made once.
    write_table(reasoned, run.path("cascade"))
    reasoned = run.table("cascade")
    scored = run.model(reasoned.where("reject_reason is null"), M.named(c.unsafe_model, M.stub_unsafe_scores), "image_path", "predictions", "array<struct<label:string,score:double>>", 32)
    write_table(scored.withColumn("reject_reason", F.when(unsafe(F.col("predictions"), c.nsfw_threshold), "nsfw")).drop("predictions"), run.path("scored"))
    scored = run.table("scored")
    rejected = {r["reject_reason"]: r["n"] for r in rejection_counts(reasoned.select("reject_reason").unionByName(scored.select("reject_reason").where("reject_reason is not null"))).collect()}
    kept = scored.where("reject_reason is null").drop("reject_reason")
    hashed = kept
    words = tuple(f"h{i}" for i in range(-(-c.phash_size * c.phash_size // 64)))
    for i, w in enumerate(words):
        hashed = hashed.withColumn(w, F.get("hash", F.lit(i)))
    hashed = hashed.withColumn("bucket", bucket_of(F.col(words[0]), c.phash_bucket_bits))
    write_table(greedy_dedup(hashed, words, "aesthetic_score", c.phash_threshold), run.path("deduped"))
    flags = run.table("deduped")
    write_table(flags.where(~F.col("is_duplicate")).select(*run.table("raw").columns), run.path("filtered"))
    V.check_rows(run.table("filtered"), what="filtered table")
    V.check_no_nulls(run.table("filtered"), ["image_path"])
    V.check_files(run.table("filtered"), list_images(run.spark, c.image_dir), what="filtered table")
    n = flags.agg(F.count("*").alias("n"), F.count_if("is_duplicate").alias("d")).head()
    return {"after_filter": n["n"], "duplicates": n["d"], "final": n["n"] - n["d"], "rejected": rejected}


def caption(run: Run) -> dict:
    """Captions and their text encodings."""
    c = run.config

    def make(rows: DataFrame) -> DataFrame:
        rows = run.model(rows.select("row_id", "image_path"), M.named(c.caption_model, M.stub_caption), "image_path", "synthetic_caption", "string", 8)
        rows = rows.withColumn("synthetic_caption", strip_caption(F.col("synthetic_caption")))
        return run.model(rows, M.named(c.text_model, M.stub_text_encoding(c.text_tokens, c.text_dim)), "synthetic_caption", "clip_emb", "binary", 32)

    run.grown(run.table("filtered"), "captioned", make, f"{c.caption_model}|{c.text_model}")
    V.check_captions(run.table("captioned"))
    return {"captioned": run.table("captioned").count(), "caption_model": c.caption_model}


def embed_and_cluster(run: Run) -> dict:
    """Embeddings, the best of several K-means fits on unit vectors, and distances to the assigned centroid."""
    c = run.config
    run.grown(run.table("filtered"), "embedded", lambda rows: run.model(rows.select("row_id", "image_path"), M.named(c.image_model, M.stub_embedding(c.embedding_dim)), "image_path", "embedding", "array<float>"), c.image_model)
    unit = run.table("embedded").where("embedding is not null").withColumn("unit", l2_normalised(F.col("embedding")))
    model, cost = C.fit_kmeans(unit, c.num_clusters, [c.random_seed + i for i in range(c.kmeans_n_init)], c.kmeans_max_iter, "row_id")
    points = np.array(model.clusterCenters())
    put_bytes(run.path("kmeans_centroids.npy"), npy_bytes(points))
    labelled = model.transform(unit.withColumn("features", C.array_to_vector("unit"))).withColumnRenamed("prediction", "cluster_id")
    labelled = C.with_assigned_distance(labelled, list(range(len(points))), points)
    rows = run.table("filtered").join(labelled.select("image_path", "embedding", "cluster_id", "cluster_distance"), "image_path")
    write_table(rows, run.path("clustered"))
    V.check_clusters(run.table("clustered"), c.num_clusters, c.embedding_dim)
    sizes = {r["cluster_id"]: r["n"] for r in Q.cluster_sizes(run.table("clustered")).collect()}
    summary = {"num_clusters": len(sizes), "total_images": sum(sizes.values()), "cluster_sizes": sizes, "inertia": cost}
    write_json(run.path("cluster_summary.json"), summary)
    return summary


def measure(run: Run) -> dict:
    """Cluster quality, as a document and a report."""
    unit = run.table("clustered").select("row_id", "cluster_id", l2_normalised(F.col("embedding")).alias("unit"))
    rows = Q.cluster_fractions(unit).join(Q.intra_similarity(unit).drop("n"), "cluster_id").join(Q.boundary_fractions(unit), "cluster_id").collect()
    per = [r.asDict() for r in rows]
    silhouette = Q.silhouettes(unit).agg(F.avg("silhouette")).head()[0]
    davies = Q.davies_bouldin(unit).head()[0]
    rounded = {k: None if v is None else round(v, 4) for k, v in (("silhouette_score", silhouette), ("davies_bouldin_index", davies))}
    document = rounded | {"per_cluster": {str(r["cluster_id"]): {"n_samples": r["n"], **{k: None if r[k] is None else round(r[k], 4) for k in ("fraction", "intra_cluster_cosine_sim", "boundary_fraction")}} for r in per}}
    write_json(run.path("cluster_quality.json"), document)
    put_bytes(run.path("cluster_report.md"), quality_report(per, silhouette, davies).encode())
    V.check_document(read_document(run.spark, run.path("cluster_quality.json")), "cluster_quality.json")
    return rounded


def encode(run: Run) -> dict:
    """Latents as half-precision bytes, and how well a sample of them survives decoding and encoding."""
    c = run.config
    run.grown(run.table("filtered"), "latents", lambda rows: run.model(rows.select("row_id", "image_path", "image_id"), M.named(c.latent_model, M.stub_latent(c.latent_scale)), "image_id" if c.latent_model == "stub" else "image_path", "latent", "binary", 32), c.latent_model)
    total = run.table("latents").agg(F.count("latent").alias("n"), F.sum(F.length("latent")).alias("b")).head()
    if not total["n"]:
        raise V.ValidationError("no latents")
    errors = M.reconstruction_errors(run.table("latents").where("latent is not null"), c.latent_scale, M.named(c.latent_codec, M.stub_codec), LATENT)
    write_table(errors, run.path("reconstruction"))
    return {"latents": total["n"], "storage_mb": round(total["b"] / 2**20, 2), "reconstruction_error": round(run.table("reconstruction").agg(F.avg("error")).head()[0], 6)}


def shard(run: Run) -> dict:
    """Tar shards by cluster, router arrays and the manifest; a missing latent stops the stage before it writes."""
    c = run.config
    clustered = run.table("clustered")
    latents = run.table("latents").where("latent is not null")
    require_all(clustered, latents, "image_path", "row_id")
    numbered = assign_shards(clustered, c.shard_size)
    rows = attach(attach(numbered, run.table("captioned"), "image_path", "synthetic_caption", "row_id"), run.table("captioned"), "image_path", "clip_emb", "row_id")
    rows = rows.join(latents.select("image_path", "latent"), "image_path")
    samples = rows.select("cluster_id", "shard", "image_id", "latent", "clip_emb", F.col("synthetic_caption").alias("caption"), metadata_json().alias("metadata"))
    written = write_tars(samples, run.path("expert_shards"), clean=c.clean_shards).collect()
    export_npy(clustered, run.path("router_training/cluster_labels.npy"), "cluster_id", "row_id", "int32", ())
    export_npy(clustered, run.path("router_training/image_ids.npy"), "image_id", "row_id", "U", ())
    export_npy(rows, run.path("router_training/clip_text_embeddings.npy"), "clip_emb", "row_id", "float16", (c.text_tokens, c.text_dim), packed=True)
    export_npy(clustered, run.path("router_training/dinov2_embeddings.npy"), "embedding", "row_id", "float16", (c.embedding_dim,))
    export_npy(rows, run.path("router_training/latents.npy"), "latent", "row_id", "float16", LATENT, packed=True)
    manifest = build_manifest(c, Q.cluster_sizes(clustered), {r["path"]: f"sha256:{r['sha256']}" for r in written}, read_document(run.spark, run.path("cluster_quality.json")), {"total_images": clustered.count()})
    write_json(run.path("pipeline_manifest.json"), manifest)
    found = files_below(run.path("expert_shards"), ".tar")
    listed = run.spark.createDataFrame([(p,) for p in manifest["shard_checksums"]], "path string")
    if c.clean_shards:
        V.check_shards(shard_health(listed, run.spark.createDataFrame(found, "path string, size long")), manifest)
    return {"shards": len(written), "samples": sum(r["n"] for r in written), "tag": manifest["tag"]}


STAGES: dict[int, tuple[str, Callable[[Run], dict]]] = {
    1: ("ingest", ingest), 2: ("filter", filter_and_dedup), 3: ("caption", caption), 4: ("cluster", embed_and_cluster), 5: ("quality", measure), 6: ("encode", encode), 7: ("shard", shard),
}


def selected(stages: str | None, resume_from: int | None) -> list[int]:
    """Listed stages, in their given order, or all from one on."""
    if stages:
        return [int(x) for x in stages.split(",")]
    return [n for n in STAGES if n >= (resume_from or 1)]


def run_stages(run: Run, numbers: list[int]) -> dict:
    """Run stages until one fails; metrics are written also then, with the stages that are done."""
    metrics, began = {}, time.time()
    try:
        for n in numbers:
            name, stage = STAGES[n]
            stage_logger(name)
            at = time.time()
            metrics[name] = stage(run) | {"elapsed_seconds": round(time.time() - at, 1)}
            LOG.info("stage %d %s: %s", n, name, metrics[name])
    finally:
        metrics["total_elapsed_seconds"] = round(time.time() - began, 1)
        write_json(run.path("pipeline_metrics.json"), metrics)
    return metrics


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--stages")
    parser.add_argument("--resume-from", type=int)
    parser.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    numbers = selected(args.stages, args.resume_from)
    if args.dry_run:
        if exists(args.config):
            load_config(args.config, REQUIRED)
        print("\n".join(f"{n} {STAGES[n][0]}" for n in numbers))
        return 0
    from lodestrata.session import build_session

    try:
        config = load_config(args.config, REQUIRED)
        print(json.dumps(run_stages(Run(build_session(), config), numbers)))
    except Exception:
        LOG.exception("stopped")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
