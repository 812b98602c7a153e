"""Typed settings of a run; a YAML mapping overrides the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path


#: Settings that a file must have: others have defaults, these decide what a run is.
REQUIRED = ("num_samples", "min_aesthetic_score", "min_resolution", "caption_model", "text_model", "image_model", "latent_model", "num_clusters", "shard_size", "work_dir", "image_dir", "random_seed")


class ConfigError(ValueError):
    """A setting is missing, unknown or of the wrong type."""


@dataclass(frozen=True)
class CurationConfig:
    """Settings of all stages; directories may be any path that Spark can open.

    A model is "stub" or ``module:factory``; several, with commas between, are tried in turn for want of
    memory.  With ``index_path``, ``fetch`` names a function of a url that returns bytes.
    """

    work_dir: str = "work"
    index_path: str = ""
    image_dir: str = "images"
    num_samples: int = 10_000
    oversample_factor: float = 1.4
    index_max_rows: int = 0
    min_aesthetic_score: float = 5.0
    null_policy: str = "drop"
    min_resolution: int = 256
    max_aspect_ratio: float = 2.0
    nsfw_threshold: float = 0.3
    phash_size: int = 16
    phash_threshold: int = 6
    phash_bucket_bits: int = 12
    num_clusters: int = 8
    kmeans_n_init: int = 20
    kmeans_max_iter: int = 500
    embedding_dim: int = 768
    latent_scale: float = 0.18215
    shard_size: int = 1_000
    clean_shards: bool = True
    random_seed: int = 42
    caption_model: str = "stub"
    text_model: str = "stub"
    image_model: str = "stub"
    latent_model: str = "stub"
    unsafe_model: str = "stub"
    latent_codec: str = "stub"
    fetch: str = ""
    fetch_threads: int = 16
    fetch_retries: int = 1
    image_size: int = 256
    index_streaming: bool = False
    retry_attempts: int = 3
    retry_backoff: float = 5.0
    text_tokens: int = 77
    text_dim: int = 8
    gpus: float = 0.0
    score_names: tuple = ()
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.null_policy not in ("drop", "keep"):
            raise ConfigError("null_policy is drop or keep")
        for name in ("num_samples", "num_clusters", "shard_size"):
            if getattr(self, name) < 1:
                raise ConfigError(f"{name} must be positive")


def load_config(path: str | Path, required: tuple[str, ...] = ()) -> CurationConfig:
    """Read a flat YAML mapping (``key: value`` lines where PyYAML is not installed)."""
    text = Path(path).read_text()
    try:
        import yaml

        raw = yaml.safe_load(text) or {}
    except ImportError:
        raw = dict(_plain(text))
    return from_mapping(raw, required)


def _plain(text: str):
    import ast

    for line in text.splitlines():
        line = line.split(" #")[0].strip()
        if line and not line.startswith("#") and ":" in line:
            key, _, value = (x.strip() for x in line.partition(":"))
            try:
                yield key, {"true": True, "false": False}.get(value.lower(), ast.literal_eval(value) if value else None)
            except (ValueError, SyntaxError):
                yield key, value


def from_mapping(raw: dict, required: tuple[str, ...] = ()) -> CurationConfig:
    """Unknown keys are kept in ``extra``; missing required ones are named together."""
    if missing := sorted(set(required) - set(raw)):
        raise ConfigError(f"missing settings: {', '.join(missing)}")
    known = {f.name: f for f in fields(CurationConfig)}
    given = {}
    for key, value in raw.items():
        if key not in known or key == "extra":
            continue
        kind = {"int": int, "float": float, "str": str, "bool": bool}.get(str(known[key].type), None)
        try:
            given[key] = kind(value) if kind else value
        except (TypeError, ValueError) as e:
            raise ConfigError(f"{key}: {value!r}") from e
    return CurationConfig(**given, extra={k: v for k, v in raw.items() if k not in known})
