"""The quality cascade: cheap predicates first, the model on survivors only, the first failing reason kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.scores import max_label_score
from lodestrata.functions.text import aspect_ratio

# Labels whose scores make an image unsafe.
UNSAFE_LABELS = ("nsfw", "porn", "sexy", "hentai")
# Reasons to reject, in the order they are tried; a file that does not open fails its integrity.
REASONS = ("file_integrity", "file_open_error", "resolution", "aspect_ratio", "aesthetic_score", "nsfw")


def reject_reason(width: Column, height: Column, score: Column, min_resolution: int, max_ratio: float, min_score: float) -> Column:
    """The first reason to reject, or null.  A null score passes, unless its column is missing (pass 0 then)."""
    broken = F.coalesce((width <= 0) | (height <= 0), F.lit(True))
    return (
        F.when(broken, "file_integrity")
        .when((width < min_resolution) | (height < min_resolution), "resolution")
        .when(aspect_ratio(width, height) > max_ratio, "aspect_ratio")
        .when(F.coalesce(score < min_score, F.lit(False)), "aesthetic_score")
    )


def score_model(df: DataFrame, score: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Run a batch model over the rows that are left; it is loaded once for each task."""
    return df.mapInPandas(score, schema)


def unsafe(predictions: Column, threshold: float) -> Column:
    return max_label_score(predictions, UNSAFE_LABELS) >= threshold


def rejection_counts(reasons: DataFrame, column: str = "reject_reason") -> DataFrame:
    """Rows for each reason, most first."""
    return reasons.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
