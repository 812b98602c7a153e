"""Deterministic tar shards: one for each cluster and shard number, written by tasks and put in place at the end."""

from __future__ import annotations

import hashlib
import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources import store


def _member(archive: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size, info.mtime, info.mode = len(data), 0, 0o644
    archive.addfile(info, io.BytesIO(data))


class _Digested:
    """A stream that also takes the digest of what is written."""

    def __init__(self, stream) -> None:
        self.stream, self.digest = stream, hashlib.sha256()

    def write(self, data) -> int:
        self.digest.update(data)
        self.stream.write(data)
        return len(data)


def write_tars(samples: DataFrame, root: str, key: str = "image_id", clean: bool = True) -> DataFrame:
    """Write ``samples`` (cluster_id, shard, image_id, latent, clip_emb, caption, metadata) below ``root``.

    Rows of a shard stream through one task in key order; shards of a cluster go to different
    tasks.  ``root`` is on any file system that tasks and driver share.  Each shard is written under a name of the
    attempt and moved, so a repeated task replaces it whole; shards of the old root go, with those of clusters that
    are empty now, only when all are written (``clean``; else shards of other names stay).  Returns
    path, n, sha256 (small: one row for each shard).
    """
    staging = f"{root.rstrip('/')}.{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store.open_store(staging)
        now, archive, out, temp, n = None, None, None, "", 0
        done: list[tuple[str, int, str]] = []

        def finish() -> None:
            archive.close()
            out.stream.close()
            final = f"cluster_{now[0]}/shard-{now[1]:04d}.tar"
            store.moved(files, temp, f"{base}/{final}")
            done.append((final, n, out.digest.hexdigest()))

        for batch in batches:
            for row in batch.to_pylist():
                if (row["cluster_id"], row["shard"]) != now:
                    if archive is not None:
                        finish()
                    now, n = (row["cluster_id"], row["shard"]), 0
                    files.create_dir(f"{base}/cluster_{now[0]}", recursive=True)
                    temp = f"{base}/cluster_{now[0]}/.{uuid.uuid4().hex}"
                    out = _Digested(files.open_output_stream(temp))
                    archive = tarfile.open(fileobj=out, mode="w|", format=tarfile.USTAR_FORMAT)
                for part, suffix in (("latent", "latent.npy"), ("clip_emb", "clip_emb.npy")):
                    _member(archive, f"{row['key']}.{suffix}", row[part] or b"")
                _member(archive, f"{row['key']}.caption.txt", (row["caption"] or "").encode())
                _member(archive, f"{row['key']}.metadata.json", (row["metadata"] or "{}").encode())
                n += 1
        if archive is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["path", "n", "sha256"])

    rows = samples.select("cluster_id", "shard", F.col(key).alias("key"), "latent", "clip_emb", "caption", "metadata")
    ordered = rows.repartition("cluster_id", "shard").sortWithinPartitions("cluster_id", "shard", "key")
    written = ordered.mapInArrow(run, "path string, n long, sha256 string").collect()
    files, base = store.open_store(root.rstrip("/"))
    if clean:
        store.delete(root)
    for path in [w["path"] for w in written]:
        files.create_dir(f"{base}/{path.rsplit('/', 1)[0]}", recursive=True)
        store.moved(files, f"{store.open_store(staging)[1]}/{path}", f"{base}/{path}")
    store.delete(staging)
    return samples.sparkSession.createDataFrame([tuple(r) for r in written], "path string, n long, sha256 string")
