"""Scores as they come from an index: coercion, null policy, label scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def coerce_score(raw: Column) -> Column:
    """A double of a number's text; null for null, blank, not a number or NaN; infinities stay.

    Underscores in digits are not accepted.
    """
    text = raw.cast("string")
    number = F.when(text.rlike(_NUMBER) | text.rlike(_INFINITE), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(number), number)


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def max_label_score(predictions: Column, labels: tuple[str, ...]) -> Column:
    """The largest score among an array of (label, score) whose label, in any case, is listed; 0 without one."""
    scores = F.transform(F.filter(predictions, lambda p: F.lower(p["label"]).isin(*labels)), lambda p: p["score"])
    return F.coalesce(F.array_max(scores), F.lit(0.0))
