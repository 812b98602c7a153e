"""Files on any file system that Spark's paths name, for driver and Python tasks."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path on it."""
    if "://" not in path or path.startswith("file:"):
        return fs.LocalFileSystem(), urlsplit(path).path if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def is_local(path: str) -> bool:
    return isinstance(open_store(path)[0], fs.LocalFileSystem)


def exists(path: str) -> bool:
    store, at = open_store(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def get_bytes(path: str) -> bytes:
    store, at = open_store(path)
    with store.open_input_stream(at) as f:
        return f.read()


def put_bytes(path: str, data: bytes) -> None:
    """Write a file whole, under another name first: repeated tasks make equal files, and the last to be there stays."""
    store, at = open_store(path)
    base, _, name = at.rpartition("/")
    store.create_dir(base or ".", recursive=True)
    temp = f"{base or '.'}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temp) as f:
        f.write(data)
    moved(store, temp, at)


def moved(store: fs.FileSystem, temp: str, at: str) -> None:
    """Put a finished file in its place, over an older one."""
    try:
        store.move(temp, at)
    except OSError:  # some file systems don't move over a file
        store.delete_file(at)
        store.move(temp, at)


def files_below(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """Relative paths and sizes of all files below a folder; none if it is not there."""
    store, at = open_store(path)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True))
    return sorted((f.path[len(at.rstrip("/")) + 1 :], f.size) for f in found if f.is_file and f.path.endswith(suffix))


def delete(path: str) -> None:
    store, at = open_store(path)
    if store.get_file_info(at).type == fs.FileType.Directory:
        store.delete_dir(at)
