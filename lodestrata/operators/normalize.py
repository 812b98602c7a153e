"""Index rows of any naming to url, caption and aesthetic score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.scores import coerce_score
from lodestrata.functions.text import first_present

# The names under which indexes hold each field, in order of preference.
URL_NAMES = ("URL", "url")
CAPTION_NAMES = ("TEXT", "text", "caption", "description")
SCORE_NAMES = (
    "AESTHETIC_SCORE",
    "aesthetic_score",
    "AESTHETICS_SCORE",
    "aesthetics_score",
    "LAION_AESTHETIC_SCORE",
    "laion_aesthetic_score",
    "CLIP_SCORE",
    "clip_score",
    "AESTHETIC",
    "aesthetic",
)


def _positions(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table under positional names, since names may differ in case only."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def detect_column(columns: list[str], names: tuple[str, ...]) -> str | None:
    """The first column, in table order, whose lower-cased name is listed."""
    wanted = {n.lower() for n in names}
    return next((c for c in columns if c.lower() in wanted), None)


def normalize_by_column(df: DataFrame, min_score: float, keep_null_scores: bool = False, score_names: tuple[str, ...] = SCORE_NAMES) -> DataFrame:
    """One column for each field, found by name in table order; rows below the least score go.

    ``score_names`` may leave out names of scores on another scale.  A table without url is an error; without caption it is empty, without score all rows have the least one.
    """
    table, names = _positions(df)
    found = {}
    for field, synonyms in (("url", URL_NAMES), ("caption", CAPTION_NAMES), ("score", score_names)):
        name = detect_column(names, synonyms)
        found[field] = None if name is None else F.col(f"c{names.index(name)}")
    if found["url"] is None:
        raise ValueError("the index has no url column")
    score = F.lit(float(min_score)) if found["score"] is None else coerce_score(found["score"])
    caption = F.lit("") if found["caption"] is None else F.coalesce(found["caption"].cast("string"), F.lit(""))
    out = table.select(found["url"].cast("string").alias("url"), caption.alias("caption"), score.alias("aesthetic_score"))
    return score_filter(out, min_score, keep_null_scores)


def normalize_by_value(df: DataFrame, min_score: float, score_names: tuple[str, ...] = SCORE_NAMES) -> DataFrame:
    """For each row the first value present, in order of preference; rows without url or below the least score go."""
    table, names = _positions(df)

    def present(synonyms: tuple[str, ...]) -> Column:
        columns = [F.col(f"c{names.index(n)}") for n in synonyms if n in names]
        return first_present(*columns) if columns else F.lit(None).cast("string")

    out = table.select(present(URL_NAMES).alias("url"), F.coalesce(present(CAPTION_NAMES), F.lit("")).alias("caption"), coerce_score(present(score_names)).alias("aesthetic_score"))
    return score_filter(out.where(F.coalesce("url", F.lit("")) != ""), min_score, True)


def score_filter(df: DataFrame, min_score: float, keep_null: bool, column: str = "aesthetic_score") -> DataFrame:
    """Rows of at least the least score; null scores go, or stay at the least score."""
    score = F.coalesce(column, F.lit(float(min_score))) if keep_null else F.col(column)
    return df.withColumn(column, score).where(F.col(column) >= min_score)


def with_sidecar(images: DataFrame, sidecars: DataFrame, min_score: float, path: str = "image_path") -> DataFrame:
    """image_path, url, original_caption and score, with the JSON sidecar of the same path stem where there is one.

    ``sidecars`` has sidecar_path and the JSON text in ``content``.
    """
    stem = F.regexp_replace(F.col(path), r"\.[^./]*$", "")
    side = sidecars.select(F.regexp_replace("sidecar_path", r"\.json$", "").alias("stem"), F.from_json("content", "url string, caption string, aesthetic_score string").alias("j"))
    joined = images.withColumn("stem", stem).join(side, "stem", "left")
    score = F.coalesce(coerce_score(F.col("j.aesthetic_score")), F.lit(float(min_score)))
    return joined.select(path, F.coalesce("j.url", F.lit("")).alias("url"), F.coalesce("j.caption", F.lit("")).alias("original_caption"), score.alias("aesthetic_score"))
