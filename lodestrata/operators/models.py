"""Seams for batch models; the stubs are deterministic and need no weights.

A model is a callable from an iterator of frames to an iterator of frames, made by a factory
that runs once in each task.  A row that a model fails on gets null, never another row's result.
"""

from __future__ import annotations

import hashlib
import importlib
import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Batch = Iterator[pd.DataFrame]
LOG = logging.getLogger(__name__)


def gpu_profile(gpus: float = 1.0, cores: int = 4):
    """A resource profile for stages that need a GPU; without it a model runs on the default resources."""
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    return ResourceProfileBuilder().require(ExecutorResourceRequests().cores(cores).resource("gpu", max(1, int(gpus)))).require(TaskResourceRequests().cpus(1).resource("gpu", gpus)).build


def apply_model(df: DataFrame, factory: Callable[[], Callable[[pd.Series], list]], source: str, target: str, kind: str, batch: int = 64, profile=None) -> DataFrame:
    """Adds ``target``, the model's result for ``source``, in batches of ``batch`` rows; ``profile`` asks for resources."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{target}` {kind}"])

    def run(frames: Batch) -> Batch:
        model = factory()
        for frame in frames:
            out: list = []
            for at in range(0, len(frame), batch):
                part = frame[source].iloc[at : at + batch]
                try:
                    out += list(model(part))
                except Exception:  # noqa: BLE001  try the rows alone, so that one bad row costs only itself
                    for value in part:
                        try:
                            out += list(model(pd.Series([value])))
                        except Exception:  # noqa: BLE001
                            out.append(None)
            yield frame.assign(**{target: pd.Series(out, index=frame.index, dtype=object)})

    return df.mapInPandas(run, schema, profile=profile)


def named(name: str, stub: Callable) -> Callable:
    """The factory that a setting names: the stub, or ``module:factory``; of several, with commas between, the first that fits."""
    if name == "stub":
        return stub
    found = []
    for one in name.split(","):
        module, _, attribute = one.strip().partition(":")
        if not attribute:
            raise ValueError(f"{one}: module:factory is needed")
        found.append(getattr(importlib.import_module(module), attribute))
    return with_fallback(*found) if len(found) > 1 else found[0]


def with_fallback(*factories: Callable[[], Callable]) -> Callable[[], Callable]:
    """The first factory that does not run out of memory."""

    def make() -> Callable:
        for i, factory in enumerate(factories):
            try:
                return factory()
            except MemoryError:
                if i == len(factories) - 1:
                    raise
                LOG.warning("model %d does not fit, taking the next", i)
        raise ValueError("no model")

    return make


def seeded(key: str, size: int, seed: int = 42) -> np.ndarray:
    """Numbers that depend on the key and seed alone."""
    start = int.from_bytes(hashlib.sha256(f"{seed}|{key}".encode()).digest()[:8], "big")
    return np.random.default_rng(start).standard_normal(size)


def stub_caption() -> Callable[[pd.Series], list]:
    return lambda paths: [None if p is None else f"image {p}" for p in paths]


def stub_embedding(dim: int) -> Callable[[], Callable[[pd.Series], list]]:
    return lambda: lambda keys: [None if k is None else seeded(str(k), dim).astype(np.float32).tolist() for k in keys]


def stub_text_encoding(tokens: int, dim: int) -> Callable[[], Callable[[pd.Series], list]]:
    return lambda: lambda texts: [None if t is None else seeded(str(t), tokens * dim).astype(np.float16).tobytes() for t in texts]


def stub_latent(scale: float, shape: tuple[int, ...] = (4, 32, 32)) -> Callable[[], Callable[[pd.Series], list]]:
    return lambda: lambda keys: [None if k is None else (seeded(str(k), int(np.prod(shape))) * scale).astype(np.float16).tobytes() for k in keys]


def stub_unsafe_scores() -> Callable[[pd.Series], list]:
    return lambda keys: [[{"label": "nsfw", "score": 0.0}] for _ in keys]


def stub_codec() -> tuple[Callable[[np.ndarray], np.ndarray], Callable[[np.ndarray], np.ndarray]]:
    """Decoder and encoder of the stub latents: pixels are the latents themselves, from -1 to 1."""
    return (lambda z: z), (lambda pixels: (pixels - 0.5) / 0.5)


def latent_to_pixels(latent: np.ndarray, scale: float, decode: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Undo the scale, decode, and clip to [0, 1]."""
    return np.clip(decode(latent / scale) * 0.5 + 0.5, 0, 1)


def reconstruction_errors(latents: DataFrame, scale: float, codec: Callable[[], tuple], shape: tuple[int, ...] = (4, 32, 32), n: int = 10, seed: int = 42) -> DataFrame:
    """image_id and error of a sample: how far the encoding of a decoded latent is from it; ``codec`` makes decoder and encoder, once in each task."""
    from lodestrata.operators.sampling import exact_sample

    def run(frames: Batch) -> Batch:
        decode, encode = codec()
        for frame in frames:
            errors = []
            for data in frame["latent"]:
                latent = np.frombuffer(data, np.float16).astype(np.float64).reshape(shape)
                errors.append(float(np.abs(encode(latent_to_pixels(latent, scale, decode)) * scale - latent).mean()))
            yield pd.DataFrame({"image_id": frame["image_id"], "error": errors})

    return exact_sample(latents.select("image_id", "latent"), n, "image_id", seed).mapInPandas(run, "image_id string, error double")
