"""Counts for the manifest and the health of shards against it."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.config import CurationConfig
from lodestrata.operators.shards import version_tag
from lodestrata.sources.store import put_bytes


def shard_health(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Paths of the manifest and on disk: ok, missing, extra or empty."""
    e = expected.select("path", F.lit(True).alias("listed"))
    f = found.select("path", "size")
    both = e.join(f, "path", "full_outer")
    state = F.when(F.col("size").isNull(), "missing").when(F.col("listed").isNull(), "extra").when(F.col("size") == 0, "empty").otherwise("ok")
    return both.select("path", state.alias("state"))


def build_manifest(config: CurationConfig, sizes: DataFrame, checksums: dict[str, str], quality: dict | None, totals: dict[str, int]) -> dict:
    """The manifest as a document; counts are measured, not configured."""
    per = {r["cluster_id"]: r["n"] for r in sizes.collect()}
    return {
        "version": "1.0.0", "tag": version_tag(checksums), "created_at": datetime.now(UTC).isoformat(), **totals,
        "images_per_cluster": [per.get(i, 0) for i in range(max(per, default=-1) + 1)],
        "models_used": {"caption": config.caption_model, "text": config.text_model, "image": config.image_model, "latent": config.latent_model},
        "cluster_quality": quality or {}, "random_seeds": {"pipeline": config.random_seed},
        "shard_format": "tar", "shard_contents": ["latent", "clip_emb", "caption", "metadata"], "shard_checksums": checksums,
    }


def quality_report(rows: list[dict], silhouette: float | None, davies_bouldin: float | None) -> str:
    """The cluster report in Markdown."""
    show = lambda x, n: "-" if x is None else f"{x:.{n}f}"
    lines = ["# Cluster quality", "", f"- silhouette (cosine): {show(silhouette, 4)}", f"- Davies-Bouldin: {show(davies_bouldin, 4)}", "", "| cluster | rows | share | similarity | boundary |", "|---|---|---|---|---|"]
    for r in sorted(rows, key=lambda r: r["cluster_id"]):
        lines.append(f"| {r['cluster_id']} | {r['n']} | {100 * r['fraction']:.1f}% | {show(r['intra_cluster_cosine_sim'], 3)} | {100 * r['boundary_fraction']:.1f}% |")
    return "\n".join(lines) + "\n"


def write_json(path: str, document: dict) -> None:
    put_bytes(path, json.dumps(document, indent=2).encode())
