"""Paths, captions and content digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_stem(path: Column) -> Column:
    """The last component of a path without its last suffix; a leading dot is no suffix."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def strip_caption(caption: Column) -> Column:
    """Trim white space of any script from both ends."""
    return F.regexp_replace(caption, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def first_present(*columns: Column) -> Column:
    """The first value that is neither null nor the empty text."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns])


def checksum(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def aspect_ratio(width: Column, height: Column) -> Column:
    return F.greatest(width, height) / F.greatest(F.least(width, height), F.lit(1))
