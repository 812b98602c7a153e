"""Image files: listing in a fixed order, decoding, sidecars, fetching."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.functions.pixels import centre_crop, png_bytes
from lodestrata.sources import store
from lodestrata.sources.scratch import Scratch

PER_FOLDER = 1000
# Listed file kinds, in their order.
EXTENSIONS = ("jpg", "png", "webp")


def ranked_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Paths of the listed kinds with ``ext_rank``, the order of their kind."""
    ext = F.regexp_extract(path, r"\.([^./]+)$", 1)
    rank = F.array_position(F.array(*[F.lit(e) for e in EXTENSIONS]), ext)
    return df.withColumn("ext_rank", rank).where("ext_rank > 0")


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """image_path, size and ext_rank of all listed files below ``root``, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{jpg,png,webp}").load(root)
    return ranked_paths(files.select("path", F.col("length").alias("size"))).withColumnRenamed("path", "image_path").orderBy("ext_rank", "image_path")


def image_structs(spark: SparkSession, root: str) -> DataFrame:
    """image_path and image, Spark's struct of sizes and pixels; sizes are -1 for a file that can't be decoded."""
    image = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{jpg,png,webp}").option("dropInvalid", "false").load(root)
    origin = F.regexp_replace("image.origin", "^file:/+", "file:/")  # as listings spell it
    return image.select(origin.alias("image_path"), "image")


def decode_images(spark: SparkSession, root: str) -> DataFrame:
    """image_path, width, height of decoded images; -1 for a file that can't be decoded."""
    return image_structs(spark, root).select("image_path", F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def read_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """sidecar_path and content of all JSON files below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    return files.select(F.col("path").alias("sidecar_path"), F.decode("content", "UTF-8").alias("content"))


def fetched(urls: DataFrame, fetch: Callable[[str], bytes], threads: int = 16, retries: int = 1) -> DataFrame:
    """url, content, error: each task fetches its urls with a pool of threads; a failed url has an error and no content."""

    def one(url: str) -> tuple[bytes | None, str | None]:
        for turn in range(retries + 1):
            try:
                return fetch(url), None
            except Exception as e:  # noqa: BLE001  any fetch error is this row's result
                error = f"{type(e).__name__}: {e}"
        return None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                got = list(pool.map(one, frame["url"]))
                yield pd.DataFrame({"url": frame["url"].to_numpy(), "content": [g[0] for g in got], "error": [g[1] for g in got]})

    return urls.select("url").mapInPandas(run, "url string, content binary, error string")


def store_images(rows: DataFrame, root: str, fetch: Callable[[str], bytes], threads: int = 16, retries: int = 1) -> DataFrame:
    """Fetch the images of index rows (url, caption, aesthetic_score) into folders of ``PER_FOLDER``: url, image_path, error.

    Each image gets a JSON sidecar with its caption and score.  Files take the kind that their content says; content of no listed kind is an error of its row.
    """
    numbered = with_row_id(rows, "url")
    got = fetched(numbered, fetch, threads, retries).dropDuplicates(["url"])
    kept = numbered.join(got, "url")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            paths, errors = [], []
            for r in frame.itertuples(index=False):
                kind = None if r.content is None else kind_of(bytes(r.content))
                errors.append(r.error if r.content is None else None if kind else "no image of a listed kind")
                name = f"{root.rstrip('/')}/{r.row_id // PER_FOLDER:05d}/{r.row_id:09d}"
                paths.append(f"{name}.{kind}" if kind else None)
                if kind:
                    side = {"url": r.url, "caption": r.caption or "", "aesthetic_score": None if pd.isna(r.aesthetic_score) else r.aesthetic_score}
                    store.put_bytes(f"{name}.json", json.dumps(side).encode())
                    store.put_bytes(paths[-1], bytes(r.content))
            yield pd.DataFrame({"url": frame["url"].to_numpy(), "image_path": paths, "error": errors})

    return kept.select("row_id", "url", "caption", "aesthetic_score", "content", "error").mapInPandas(run, "url string, image_path string, error string")


def kind_of(content: bytes) -> str | None:
    """The listed kind of an image by its first bytes."""
    # How files of each kind begin.
    if content[:3] == b"\xff\xd8\xff":
        return "jpg"
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return "png"
    return "webp" if content[:4] == b"RIFF" and content[8:12] == b"WEBP" else None


def cropped(spark: SparkSession, source: str, target: str, side: int = 256) -> DataFrame:
    """Centre crops of all images below ``source`` as PNG files of side x side below ``target``, with their sidecars: image_path, error.

    Folders and names stay.  A file that can't be decoded has an error and no crop.
    """
    base = source.rstrip("/")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors = []
            for r in frame.itertuples(index=False):
                if r.height <= 0:
                    errors.append("not decoded")
                    continue
                stem = r.image_path[r.image_path.index(base.split(":")[-1].lstrip("/")) + len(base.split(":")[-1].lstrip("/")) + 1 :].rsplit(".", 1)[0]
                pixels = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
                rgb = np.repeat(pixels, 3, axis=2) if r.nChannels == 1 else pixels[:, :, 2::-1]
                store.put_bytes(f"{target.rstrip('/')}/{stem}.png", png_bytes(centre_crop(rgb, side)))
                if store.exists(f"{base}/{stem}.json"):
                    store.put_bytes(f"{target.rstrip('/')}/{stem}.json", store.get_bytes(f"{base}/{stem}.json"))
                errors.append(None)
            yield pd.DataFrame({"image_path": frame["image_path"].to_numpy(), "error": errors})

    return image_structs(spark, source).select("image_path", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(run, "image_path string, error string")


def with_row_id(df: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """Adds ``row_id`` from 0 in the given order, without sorting all rows in one task.

    Ranges are as many as the session's shuffle partitions.  The ordered rows are written once, as
    ranges drawn a second time could be others.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    ordered = Scratch(df.sparkSession, "row-id").keep(ordered, "ordered")
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("seq").alias("low"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return ordered.join(F.broadcast(starts), "part").withColumn("row_id", F.col("begin") + F.col("seq") - F.col("low")).drop("part", "seq", "low", "begin")
