"""Sources, sinks, streaming and the whole run on small files."""

from __future__ import annotations

import hashlib
import json
import math
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import png

from lodestrata.config import CurationConfig
from lodestrata.operators.manifest import shard_health
from lodestrata.plans import pipeline as P
from lodestrata.sources.arrays import export_npy, import_npy
from lodestrata.sources.images import fetched, list_images, with_row_id
from lodestrata.sources.tar_shards import write_tars
from lodestrata.streaming.ingest import bounded, ingest_stream, with_backoff


@pytest.fixture
def images(tmp_path):
    root = tmp_path / "images" / "000"
    root.mkdir(parents=True)
    for i in range(24):
        png(40 + i, 40, root / f"p{i:02d}.png")
        if i % 3:
            (root / f"p{i:02d}.json").write_text(json.dumps({"url": f"http://x/{i}", "caption": f"c{i}", "aesthetic_score": 6 + i % 3}))
    png(40, 40, root / "broken.png", truncated=True)
    (root / "notes.jpeg").write_text("no image")
    return tmp_path


def test_whole_run_and_rerun(spark, images):
    work = images / "work"
    work.mkdir()
    config = CurationConfig(work_dir=str(work), image_dir=str(images / "images"), num_samples=30, min_resolution=32, min_aesthetic_score=5.0, num_clusters=3, kmeans_n_init=2, kmeans_max_iter=20, embedding_dim=8, shard_size=5)
    run = P.Run(spark, config)
    metrics = P.run_stages(run, [1, 2, 3, 4, 5, 6, 7])
    assert metrics["ingest"]["downloaded"] == 25 and metrics["filter"]["final"] == 24 and metrics["filter"]["rejected"] == {"file_integrity": 1}
    assert metrics["shard"]["samples"] == 24
    manifest = json.loads((work / "pipeline_manifest.json").read_text())
    tars = {p: hashlib.sha256((work / "expert_shards" / p).read_bytes()).hexdigest() for p in manifest["shard_checksums"]}
    assert {p: f"sha256:{h}" for p, h in tars.items()} == manifest["shard_checksums"] and sum(manifest["images_per_cluster"]) == 24
    assert len(np.load(work / "router_training/cluster_labels.npy")) == 24 and np.load(work / "router_training/latents.npy").shape == (24, 4, 32, 32)
    again = P.run_stages(run, [3, 6, 7])
    assert again["caption"]["captioned"] == 24 and again["encode"]["latents"] == 24 and again["shard"]["tag"] == metrics["shard"]["tag"]


def test_planted_duplicate_image_goes(spark, images):
    """P12/J7: a copy under another name is found without any decoder package."""
    root, work = images / "images" / "000", images / "work"
    work.mkdir()
    (root / "q.png").write_bytes((root / "p05.png").read_bytes())
    config = CurationConfig(work_dir=str(work), image_dir=str(images / "images"), num_samples=30, min_resolution=32, min_aesthetic_score=5.0)
    metrics = P.run_stages(P.Run(spark, config), [1, 2])
    assert metrics["filter"]["after_filter"] == 25 and metrics["filter"]["duplicates"] == 1 and metrics["filter"]["final"] == 24
    kept = {r.image_id for r in P.Run(spark, config).table("filtered").select("image_id").collect()}
    assert len(kept & {"p05", "q"}) == 1


def test_cli_selection(capsys):
    assert P.selected("7,2", 3) == [7, 2] and P.selected(None, 5) == [5, 6, 7]
    assert P.main(["--dry-run", "--stages", "2,1"]) == 0 and capsys.readouterr().out.split("\n")[:2] == ["2 filter", "1 ingest"]


def test_tars_do_not_depend_on_partitions_and_stale_ones_go(spark, tmp_path):
    rows = [(i % 2, i // 6, f"k{i:02d}", bytearray(b"l"), bytearray(b"c"), "cap", "{}") for i in range(20)]
    df = spark.createDataFrame(rows, "cluster_id int, shard long, image_id string, latent binary, clip_emb binary, caption string, metadata string")
    stale = tmp_path / "s" / "cluster_9"
    stale.mkdir(parents=True)
    (stale / "shard-0000.tar").write_bytes(b"old")
    first = {r.path: r.sha256 for r in write_tars(df.repartition(1), str(tmp_path / "s")).collect()}
    second = {r.path: r.sha256 for r in write_tars(df.repartition(7), str(tmp_path / "s")).collect()}
    assert first == second and not stale.exists()
    with tarfile.open(tmp_path / "s" / "cluster_0" / "shard-0000.tar") as t:
        assert t.getnames()[:4] == ["k00.latent.npy", "k00.clip_emb.npy", "k00.caption.txt", "k00.metadata.json"]


def test_shard_health(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    found = spark.createDataFrame([("a", 5), ("b", 0), ("z", 1)], "path string, size int")
    assert {r.path: r.state for r in shard_health(listed, found).collect()} == {"a": "ok", "b": "empty", "c": "missing", "z": "extra"}


def test_arrays_go_out_and_in(spark, tmp_path):
    rows = [(i, [float(i), 0.5]) for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, embedding array<float>").repartition(5)
    assert export_npy(df, str(tmp_path / "e.npy"), "embedding", "row_id", "float16", (2,)) == 50
    assert sorted((r.row_id, r.embedding) for r in import_npy(spark, str(tmp_path / "e.npy")).collect()) == rows


def test_listing_and_row_ids(spark, images):
    rows = with_row_id(list_images(spark, str(images / "images")), "ext_rank", "image_path").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(25)) and [r.image_path for r in rows] == sorted(r.image_path for r in rows)


def test_fetch_errors_stay_with_their_rows(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("gone")
        return url.encode()

    rows = {r.url: (r.content, r.error) for r in fetched(spark.createDataFrame([("good",), ("bad",)], "url string"), fetch).collect()}
    assert rows["good"] == (bytearray(b"good"), None) and rows["bad"][0] is None and "gone" in rows["bad"][1]


def test_stream_reads_each_row_once(spark, tmp_path):
    def put(n, low):
        spark.range(low, low + n).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("c").alias("TEXT"), F.when(F.col("id") % 2 == 0, "9").alias("aesthetic_score")).write.mode("append").parquet(str(tmp_path / "in"))

    schema = "url string, TEXT string, aesthetic_score string"
    go = lambda: ingest_stream(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck"), 5.0)
    put(10, 0)
    go()
    put(10, 10)
    go()
    go()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 20 and out.select("url").distinct().count() == 20
    assert bounded(out, 7, "url").count() == 7


def test_backoff():
    waits, turns = [], []

    def fails():
        turns.append(1)
        if len(turns) < 4:
            raise OSError

    with_backoff(fails, 5, 1.0, 3.0, waits.append)
    assert waits == [1.0, 2.0, 3.0]
    with pytest.raises(OSError):
        with_backoff(lambda: (_ for _ in ()).throw(OSError), 2, 1.0, 3.0, waits.append)


@pytest.mark.parametrize("streaming", [False, True])
def test_index_is_kept_by_its_settings(spark, tmp_path, streaming):
    from lodestrata.sources.index import load_index

    spark.range(50).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("c").alias("caption"), (F.col("id") % 10).cast("string").alias("aesthetic_score")).write.parquet(str(tmp_path / "index"))
    config = CurationConfig(work_dir=str(tmp_path), index_path=str(tmp_path / "index"), num_samples=10, oversample_factor=1.5, min_aesthetic_score=5.0)
    first = sorted(map(tuple, load_index(spark, config, streaming).collect()))
    assert len(first) == 15 and all(r[2] >= 5 for r in first)
    assert sorted(map(tuple, load_index(spark, config, streaming).collect())) == first
    assert load_index(spark, CurationConfig(**{**config.__dict__, "num_samples": 20}), streaming).count() == 25


def test_shards_of_other_names_may_stay(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, "k", bytearray(b"l"), bytearray(b"c"), "cap", "{}")], "cluster_id int, shard long, image_id string, latent binary, clip_emb binary, caption string, metadata string")
    old = tmp_path / "s" / "cluster_9"
    old.mkdir(parents=True)
    (old / "shard-0000.tar").write_bytes(b"old")
    write_tars(df, str(tmp_path / "s"), clean=False)
    assert (old / "shard-0000.tar").read_bytes() == b"old" and (tmp_path / "s" / "cluster_0" / "shard-0000.tar").exists()


NAMED = """
def caption_by_name():
    return lambda paths: [f"seen {p}" for p in paths]

def too_large():
    raise MemoryError

def local_bytes(url):
    if "dead" in url:
        raise OSError("gone")
    with open(url.removeprefix("fake://"), "rb") as f:
        return f.read()
"""


@pytest.fixture(scope="module")
def named(spark, tmp_path_factory):
    """A module of models and a fetch function that driver and tasks can import."""
    path = tmp_path_factory.mktemp("named") / "named_models.py"
    path.write_text(NAMED)
    spark.sparkContext.addPyFile(str(path))
    return "named_models"


@pytest.mark.parametrize("streaming", [False, True])
def test_from_index_to_raw_table(spark, images, named, streaming):
    """Index, fetch, shard folders with sidecars, centre crops, listing; dead urls and files that are no images cost only themselves."""
    work = images / "work"
    files = [f"fake://{images}/images/000/p{i:02d}.png" for i in range(20)]
    rows = [(u, f"cap {i}", str(6 + i % 3)) for i, u in enumerate([*files, "fake://dead", f"fake://{images}/images/000/notes.jpeg", f"fake://{images}/images/000/broken.png"])]
    spark.createDataFrame([*rows, ("fake://low", "c", "1")], "URL string, TEXT string, AESTHETIC_SCORE string").write.parquet(str(images / "index"))
    config = CurationConfig(work_dir=str(work), index_path=str(images / "index"), image_dir=str(work / "crops256"), fetch=f"{named}:local_bytes", num_samples=20, image_size=32, index_streaming=streaming)
    run = P.Run(spark, config)
    metrics = P.run_stages(run, [1])["ingest"]
    assert (metrics["candidates"], metrics["fetch_errors"], metrics["downloaded"]) == (23, 2, 20)
    raw = run.table("raw").collect()
    assert sorted(r.original_caption for r in raw) == sorted(f"cap {i}" for i in range(20)) and {r.url for r in raw} == set(files) and all(6 <= r.aesthetic_score <= 8 for r in raw)
    from lodestrata.sources.images import decode_images

    assert {(r.width, r.height) for r in decode_images(spark, config.image_dir).collect()} == {(32, 32)}
    assert P.run_stages(run, [1])["ingest"]["downloaded"] == 20
    assert (work / "downloads/00000").is_dir()


def test_models_by_name_and_router_arrays(spark, images, named):
    """A caption model named by the settings, one that does not fit before it; all arrays of the router and the centroids."""
    work = images / "work"
    config = CurationConfig(
        work_dir=str(work), image_dir=str(images / "images"), num_samples=30, min_resolution=32, min_aesthetic_score=5.0, num_clusters=2, kmeans_n_init=2, kmeans_max_iter=20, embedding_dim=8, shard_size=5, caption_model=f"{named}:too_large, {named}:caption_by_name",
    )
    run = P.Run(spark, config)
    metrics = P.run_stages(run, [1, 2, 3, 4, 5, 6, 7])
    assert all(r.synthetic_caption.startswith("seen ") for r in run.table("captioned").collect()) 
    clipped = 2 * (math.exp(-0.5) / math.sqrt(2 * math.pi) - 0.5 * math.erfc(math.sqrt(0.5)))  # what a normal variable loses when it is held between -1 and 1
    assert metrics["encode"]["reconstruction_error"] == pytest.approx(0.18215 * clipped, rel=0.03)
    ordered = run.table("clustered").orderBy("row_id").collect()
    load = lambda name: np.load(work / f"router_training/{name}.npy")
    assert load("image_ids").tolist() == [r.image_id for r in ordered] and load("cluster_labels").tolist() == [r.cluster_id for r in ordered]
    assert np.allclose(load("dinov2_embeddings"), [r.embedding for r in ordered], atol=1e-2) and load("clip_text_embeddings").shape == (24, 77, 8)
    assert np.load(work / "kmeans_centroids.npy").shape == (2, 8)
    with pytest.raises(ValueError, match="module:factory"):
        P.M.named("nothing", P.M.stub_caption)


def test_cli_needs_its_settings(tmp_path, capsys):
    from lodestrata.config import REQUIRED, ConfigError

    path = tmp_path / "c.yaml"
    path.write_text("num_samples: 3\nwork_dirr: x\n")
    assert P.main(["--config", str(path)]) == 1
    with pytest.raises(ConfigError, match="work_dir"):
        P.main(["--config", str(path), "--dry-run"])
    path.write_text("".join(f"{k}: 1\n" for k in REQUIRED))
    assert P.main(["--config", str(path), "--dry-run"]) == 0


def test_checks_of_files_captions_and_documents(spark):
    from lodestrata.operators import validate as V

    rows = spark.createDataFrame([("a", "c", None), ("b", "c", bytearray(b"x"))], "image_path string, synthetic_caption string, clip_emb binary")
    for check in (lambda: V.check_files(rows, rows.where("image_path = 'a'")), lambda: V.check_captions(rows), lambda: V.check_document(None, "quality"), lambda: V.check_document({}, "quality")):
        with pytest.raises(V.ValidationError):
            check()
    V.check_files(rows, rows)
    V.check_captions(rows.where("clip_emb is not null"))
