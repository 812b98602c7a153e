"""Unit and property tests of the curation operators on hand-made edge rows."""

from __future__ import annotations

import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.config import ConfigError, from_mapping, load_config
from lodestrata.functions.hashing import bucket_of, dct_hash, hamming
from lodestrata.functions.scores import coerce_score, max_label_score
from lodestrata.functions.text import path_stem, strip_caption
from lodestrata.functions.vectors import l2_normalised
from lodestrata.operators import cluster as C
from lodestrata.operators import dedup as D
from lodestrata.operators import models as M
from lodestrata.operators import quality as Q
from lodestrata.operators import validate as V
from lodestrata.operators.dedup import greedy_dedup, greedy_losers
from lodestrata.operators.filters import UNSAFE_LABELS, reject_reason, unsafe
from lodestrata.operators.joins import attach, require_all
from lodestrata.operators.normalize import normalize_by_column, normalize_by_value
from lodestrata.operators.sampling import exact_sample, oversampled
from lodestrata.operators.shards import assign_shards, version_tag


def png(width, height, path, truncated=False):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + bytes([(x * 7 + y) % 256 for x in range(width * 3)]) for y in range(height))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    path.write_bytes(data[: len(data) // 2] if truncated else data)


def test_coerced_scores(spark):
    cases = {"6.5": 6.5, " 6.5 ": 6.5, "": None, None: None, "abc": None, "nan": None, "inf": math.inf, "-inf": -math.inf, "1e3": 1000.0, "6.5d": None, "6f": None, "1_000": None, "+.5": 0.5, "5.": 5.0}
    df = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", coerce_score(F.col("raw")).alias("x"))
    assert {r.raw: r.x for r in df.collect()} == cases


def test_null_policies_differ(spark):
    df = spark.createDataFrame([("u", "c", "7"), ("u", "c", None), ("", "c", "9"), ("u", None, "1")], "url string, TEXT string, score0 string").withColumnRenamed("score0", "aesthetic_score")
    assert normalize_by_column(df, 5.0).count() == 2
    assert sorted(r.aesthetic_score for r in normalize_by_value(df, 5.0).collect()) == [5.0, 7.0]


def test_detection_by_column_and_by_value(spark):
    df = spark.createDataFrame([("a", "b", "", "cap", "3", "4")], "url string, URL2 string, TEXT string, caption string, clip_score string, aesthetic_score string").withColumnRenamed("URL2", "URL")
    by_column, by_value = normalize_by_column(df, 0.0).head(), normalize_by_value(df, 0.0).head()
    assert (by_column.url, by_column.caption, by_column.aesthetic_score) == ("a", "", 3.0)
    assert (by_value.url, by_value.caption, by_value.aesthetic_score) == ("b", "cap", 4.0)
    with pytest.raises(ValueError):
        normalize_by_column(df.drop("url", "URL"), 0.0)


@pytest.mark.parametrize(("path", "stem"), [("a/b.jpg", "b"), ("a.tar.jpg", "a.tar"), (".hidden", ".hidden"), ("x/noext", "noext"), ("d.d/f.png", "f")])
def test_path_stem(spark, path, stem):
    assert spark.createDataFrame([(path,)], "p string").select(path_stem(F.col("p"))).head()[0] == stem


def test_strip_caption(spark):
    cases = ["\ta ", " b ", "\x1cc\x1f", "  ", "in side"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "c string").select(strip_caption(F.col("c"))).collect()]
    assert got == [c.strip() for c in cases]


@pytest.mark.parametrize(
    ("w", "h", "score", "reason"),
    [(256, 256, 6.0, None), (255, 256, 6.0, "resolution"), (256, 512, 6.0, None), (256, 513, 6.0, "aspect_ratio"), (0, 0, 6.0, "file_integrity"), (-1, -1, 1.0, "file_integrity"), (None, None, 6.0, "file_integrity"),
     (300, 900, 1.0, "aspect_ratio"), (100, 900, 1.0, "resolution"), (300, 300, 5.9, "aesthetic_score"), (300, 300, None, None)],
)
def test_first_failing_reason(spark, w, h, score, reason):
    df = spark.createDataFrame([(w, h, score)], "w int, h int, s double")
    assert df.select(reject_reason(F.col("w"), F.col("h"), F.col("s"), 256, 2.0, 6.0)).head()[0] == reason


def test_unsafe_labels(spark):
    rows = [(1, [("ok", 0.9)]), (2, [("NSFW", 0.3)]), (3, [("porn", 0.1), ("sexy", 0.29)]), (4, [])]
    df = spark.createDataFrame(rows, "i int, p array<struct<label:string,score:double>>")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", max_label_score(F.col("p"), UNSAFE_LABELS), unsafe(F.col("p"), 0.3)).collect()}
    assert got == {1: (0.0, False), 2: (0.3, True), 3: (0.29, False), 4: (0.0, False)}


def loops(words, scores, threshold):
    """The nested loops that the removal rule is stated by."""
    dead = [False] * len(words)
    for i in range(len(words)):
        if dead[i]:
            continue
        for j in range(i + 1, len(words)):
            if dead[j] or bin(words[i] ^ words[j]).count("1") > threshold:
                continue
            if scores[i] >= scores[j]:
                dead[j] = True
            else:
                dead[i] = True
                break
    return dead


def test_greedy_removal_equals_loops():
    rng = random.Random(0)
    for _ in range(2000):
        n = rng.randrange(1, 9)
        words = [rng.randrange(1 << 8) for _ in range(n)]
        scores = [rng.choice([1.0, 2.0, 3.0, math.nan]) for _ in range(n)]
        assert greedy_losers(np.arange(n), np.array(words)[:, None], np.array(scores), 2).tolist() == loops(words, scores, 2)


def test_greedy_removal_of_large_buckets(monkeypatch):
    """The same by loops over several rounds of later rows, and work that follows the rows where each is soon beaten."""
    rng = random.Random(1)
    for n, bits, columns in ((3000, 30, 1), (3000, 12, 2), (1500, 40, 3), (2500, 3, 1)):
        words = [[rng.randrange(1 << bits) for _ in range(columns)] for _ in range(n)]
        scores = [rng.choice([1.0, 2.0, 3.0, math.nan]) for _ in range(n)]
        one = [sum(w << (bits * k) for k, w in enumerate(row)) for row in words]
        assert greedy_losers(np.arange(n), np.array(words), np.array(scores), 6).tolist() == loops(one, scores, 6)
    compared, count = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: compared.append(x.size) or count(x))
    assert greedy_losers(np.arange(5000), np.zeros((5000, 1), np.int64), np.full(5000, math.nan), 6).tolist() == [True] * 4999 + [False]
    assert sum(compared) <= 300 * 5000  # 12,497,500 when all later rows were compared


def test_near_pairs_of_cut_buckets(spark, monkeypatch):
    """Buckets of one and of several chunks, copies, repeated keys and nulls; a dense bucket is many tasks' work."""
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 1, 2]), rng.randrange(1 << 9), rng.choice([0, 0xFFFFFFFF, rng.randrange(1 << 4)])) for i in range(400)]
    rows += [(7, 0, 0, 0), (None, 0, 0, 0), (500, 0, None, None), (501, 3, 1, 1), (502, 4, 2, 2), (503, 4, 1, 2)]
    expected = sorted((x[0], y[0], d) for x in rows for y in rows if None not in (x[0], y[0], x[2], y[2]) and x[1] == y[1] and x[0] < y[0] for d in [(x[2] ^ y[2]).bit_count() + (x[3] ^ y[3]).bit_count()] if d <= 3)
    df = spark.createDataFrame(rows, "doc_id long, bucket long, hi long, lo long")
    for most in (4096, 40):
        monkeypatch.setattr(D, "CHUNK", most)
        found = D.near_pairs(df, ("hi", "lo"), 3, "doc_id").withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r.a, r.b, r.distance) for r in found) == expected
    assert len({r.task for r in found}) > 1


@pytest.mark.parametrize(("words", "scores", "kept"), [([0, 0x3F, 0xFFF], [3, 2, 1], [0, 2]), ([0, 0x3F, 0xFC0], [5, 1, 6], [2]), ([5, 5], [1, 1], [0]), ([None, 5, 5], [9, None, None], [0, 2])])
def test_greedy_dedup_in_spark(spark, words, scores, kept):
    rows = [(i, 0, w, None if s is None else float(s)) for i, (w, s) in enumerate(zip(words, scores, strict=True))]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "row_id long, bucket long, w long, s double").repartition(parts)
        assert sorted(r.row_id for r in greedy_dedup(df, ("w",), "s", 6).where("not is_duplicate").collect()) == kept


def test_buckets_and_distances(spark):
    df = spark.createDataFrame([(-1, 0)], "a long, b long")
    row = df.select(*[bucket_of(F.col("a"), n).alias(f"b{n}") for n in (0, 12, 64, 100)], hamming((F.col("a"),), (F.col("b"),)).alias("d")).head()
    assert (row.b0, row.b12, row.b64, row.b100, row.d) == (0, 4095, -1, -1, 64)
    gray = np.random.default_rng(0).random((64, 64))
    assert len(dct_hash(gray)) == 4 and dct_hash(gray) == dct_hash(gray * 2)


def units(spark, rows):
    df = spark.createDataFrame([(i, c, [float(x) for x in v]) for i, (c, v) in enumerate(rows)], "vec_id long, cluster_id int, embedding array<float>")
    return df.withColumn("unit", l2_normalised(F.col("embedding")))


def test_quality_of_planted_clusters(spark):
    rng = np.random.default_rng(1)
    rows = [(c, np.eye(3)[c] + rng.normal(size=3) * 0.2) for c in range(3) for _ in range(20)]
    unit = units(spark, rows)
    x = np.array([v / np.linalg.norm(v) for _, v in rows])
    label = np.array([c for c, _ in rows])
    sims = x @ x.T
    for r in Q.intra_similarity(unit).collect():
        s = sims[np.ix_(label == r.cluster_id, label == r.cluster_id)]
        assert r.intra_cluster_cosine_sim == pytest.approx((s.sum() - np.trace(s)) / (20 * 19), abs=1e-6)
    values = []
    for i in range(len(x)):
        d = 1 - sims[i]
        a = d[(label == label[i]) & (np.arange(len(x)) != i)].mean()
        b = min(d[label == c].mean() for c in range(3) if c != label[i])
        values.append((b - a) / max(a, b))
    assert Q.silhouettes(unit).agg(F.avg("silhouette")).head()[0] == pytest.approx(np.mean(values), abs=1e-6)
    model, cost = C.fit_kmeans(unit, 3, [42, 43], 50, "vec_id")
    centre = np.array([x[label == c].mean(axis=0) for c in range(3)])
    assert cost <= ((x - centre[label]) ** 2).sum() * 1.01 and len(model.clusterCenters()) == 3


def test_quality_edges(spark):
    alone = units(spark, [(0, [1, 0]), (0, [0, 0])])
    assert Q.boundary_fractions(alone).head().boundary_fraction == 0 and Q.davies_bouldin(alone).head()[0] == 0
    assert Q.silhouettes(alone).head().silhouette is None
    mixed = units(spark, [(0, [1, 0]), (1, [1, 0]), (1, [1, 0])])
    assert {r.cluster_id: r.intra_cluster_cosine_sim for r in Q.intra_similarity(mixed).collect()} == {0: None, 1: pytest.approx(1)}
    assert Q.davies_bouldin(mixed).head()[0] == 0


def test_models_keep_rows_apart(spark):
    def factory():
        def model(part):
            if any(v == "bad" for v in part):
                raise ValueError("bad")
            return [f"<{v}>" for v in part]

        return model

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "p string").coalesce(1)
    assert [r.r for r in M.apply_model(df, factory, "p", "r", "string", 2).collect()] == ["<a>", None, "<c>"]
    assert M.seeded("k", 4).tolist() == M.seeded("k", 4).tolist()

    def too_big():
        raise MemoryError

    assert M.with_fallback(too_big, lambda: "small")() == "small"


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    assert len({tuple(r.k for r in exact_sample(df.repartition(p), 20, "k").collect()) for p in (1, 4, 7)}) == 1
    assert oversampled(10, 1.4) == 14 and oversampled(10, 0.5) == 10


@pytest.mark.parametrize("ranges", [1, 5])
def test_published_sizes_make_thirteen_shards(spark, ranges):
    # Rows of each cluster in the published run.
    sizes = [645, 544, 544, 548, 1143, 3746, 1370, 454]
    rows = [(i, c) for i, c in enumerate(c for c, n in enumerate(sizes) for _ in range(n))]
    out = assign_shards(spark.createDataFrame(rows, "row_id long, cluster_id int").repartition(5), 1000, ranges=ranges)
    shards = {(r.cluster_id, r.shard): r["count"] for r in out.groupBy("cluster_id", "shard").count().collect()}
    assert sum(sizes) == 8994 and len(shards) == 13 and max(shards.values()) == 1000
    assert version_tag({"b": "2", "a": "1"}) == version_tag({"a": "1", "b": "2"})


def test_last_match_wins_and_missing_rows_stop(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "k string, v string, o int")
    assert {r.k: r.v for r in attach(left, right, "k", "v", "o", F.lit("-")).collect()} == {"a": "new", "b": "-"}
    with pytest.raises(ValueError, match="1 rows"):
        require_all(left.withColumn("row_id", F.lit(0)), right, "k", "row_id")


def test_validators(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], None), (1, [1.0, 2.0], 0.0)], "cluster_id int, embedding array<double>, aesthetic_score double")
    V.check_clusters(df, 2, 2)
    for bad in (lambda: V.check_clusters(df, 3, 2), lambda: V.check_clusters(df, 2, 3), lambda: V.check_rows(df, 3), lambda: V.check_no_nulls(df, ["aesthetic_score"]), lambda: V.check_ingest(df.where("aesthetic_score is not null"), 1.0), lambda: V.check_ingest(df.limit(0), 0.0)):
        with pytest.raises(V.ValidationError):
            bad()
    V.check_ingest(df, 1.0)


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("num_clusters: 4\nshard_size: '10'\nclean_shards: true # note\nother: x\n")
    c = load_config(tmp_path / "c.yaml")
    assert (c.num_clusters, c.shard_size, c.clean_shards, c.extra) == (4, 10, True, {"other": "x"})
    with pytest.raises(ConfigError, match="b"):
        from_mapping({"a": 1}, ("a", "b"))
    with pytest.raises(ConfigError):
        from_mapping({"num_clusters": "many"})


def test_encoder_input_and_shapes():
    from lodestrata.functions.pixels import checked_shape, encoder_input, resized, storage_mb

    flat = np.full((30, 50, 3), 255, np.uint8)
    assert encoder_input(flat, 16).shape == (3, 16, 16) and np.allclose(encoder_input(flat, 16), 1)
    assert np.allclose(resized(np.arange(4.0).reshape(2, 2, 1), 2, 2)[..., 0], [[0, 1], [2, 3]])
    assert checked_shape(np.zeros((1, 4, 2)), (4, 2)).shape == (4, 2)
    with pytest.raises(ValueError):
        checked_shape(np.zeros((2, 4, 2)), (4, 2))
    assert round(storage_mb(8994, 4 * 32 * 32), 1) == 70.3


def test_reconstructions_are_measured(spark):
    latents = spark.createDataFrame([(f"i{k}", bytearray(np.full((4, 32, 32), k, np.float16).tobytes())) for k in range(12)], "image_id string, latent binary")
    rows = M.reconstruction_errors(latents, 1.0, lambda: (lambda x: x * 0, lambda x: np.zeros((4, 32, 32))), n=5).collect()
    assert len(rows) == 5 and all(r.error == float(r.image_id[1:]) for r in rows)


def test_viewer(spark):
    from lodestrata.operators.viewer import entry, entry_filter, overview, page

    df = spark.createDataFrame([(i, i % 2, float(i), 0.5, "" if i % 3 else "u", None) for i in range(10)], "row_id long, cluster_id int, aesthetic_score double, cluster_distance double, url string, caption string")
    assert tuple(overview(df).head()) == (10, 2, 5, 5)
    assert [r.row_id for r in page(df.where(entry_filter(2, 0.5, False, False)), 4, 3).collect()] == [5, 7, 8]
    assert entry(df, 3).head().row_id == 3


def test_log_prefix_is_not_doubled(tmp_path):
    from lodestrata.logs import stage_logger

    log = stage_logger("filter", str(tmp_path / "log"))
    log.info("done")
    assert (tmp_path / "log").read_text().count("[filter +") == 1


def test_shard_check(spark):
    ok = spark.createDataFrame([("a", "ok")], "path string, state string")
    V.check_shards(ok, {"x": 1})
    for health, manifest in ((ok, None), (ok.limit(0), {"x": 1}), (ok.withColumn("state", F.lit("extra")), {"x": 1})):
        with pytest.raises(V.ValidationError):
            V.check_shards(health, manifest)


def test_simhash_of_edge_texts(spark):
    from lodestrata.functions.hashing import simhash

    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "One one TWO"), (5, "one ONE two"), (6, "x " * 50_000)], "doc_id long, text string")
    rows = {r.doc_id: (r.hi, r.lo) for r in simhash(df).collect()}
    assert set(rows) == {4, 5, 6} and rows[4] == rows[5]
    digest = int.from_bytes(__import__("hashlib").md5(b"x").digest()[:8], "big")
    assert rows[6] == (digest >> 32, digest & 0xFFFFFFFF)
    assert simhash(df.limit(0)).count() == 0
