"""Mixing sources to target weights along a time-varying curriculum.

Training runs over t from 0 to 1.  Source s is drawn at the rate w_s * (1 + a_s * (2t - 1)),
whose integral over the run is its weight w_s, so the shares of the whole run are the weights
while early and late training differ.  The words that s has supplied by t are
target_s * ((1 - a_s) * t + a_s * t**2); solving this for t gives every document, from the
words of its source that stand before it, its position in training.  Within a source,
documents come in the order of the md5 of their ids, and start again when they have been used up.

Running sums are taken in two levels, over hash ranges of a source and within each, so that
no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
#: How the rates change over the run: rising, even, falling, repeating in the order of the sources.
TILTS = (0.5, 0.0, -0.5)
BUCKET_ROWS = 512
#: A larger table of sources is joined by a shuffle instead of a broadcast: bytes of the names, and of what else a row holds.
BROADCAST_BYTES = 8 << 20
SOURCE_BYTES = 100
WORD = r"[^\x20\x09-\x0D]+"


def _numbered(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``source_no``: the place of a source by code point, a null one last.  The driver gathers one number for each range partition."""
    ordered = found.orderBy(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    ordered = scratch.keep(ordered, "ordered")
    parts = sorted(ordered.groupBy("part").agg(F.min("seq"), F.count("*")).collect())
    begins = [(part, sum(n for *_, n in parts[:i]) - low) for i, (part, low, _) in enumerate(parts)]
    starts = found.sparkSession.createDataFrame(begins, "part int, begin long")
    return ordered.join(F.broadcast(starts), "part").select(*found.columns, (F.col("begin") + F.col("seq")).alias("source_no"))


def targets(sources: DataFrame, scratch: Scratch, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Adds source_no, target, tilt to ``sources`` (source, source_size, n): shares of budget * all sizes by weight; none above cap * its size.

    The excess of sources above their cap is shared again by weight among the rest, until none is
    above.  Each turn is one sum over the table of sources, which stays in Spark.
    """
    place = F.col("source_no")
    pick = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), (place % len(values)).cast("int"))
    table = _numbered(sources, scratch).withColumn("weight", pick(weights)).withColumn("tilt", pick(TILTS)).withColumn("most", cap * F.col("source_size"))
    table = scratch.keep(table, "weighed")
    whole, spare = table.agg(budget * F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).head()
    total, left, capped = float(whole), spare, 0
    while left > 0:
        share = F.col("weight") * F.lit(total) / F.lit(left)
        n, most, weight = table.where(F.col("most") <= share).agg(F.count("*"), F.coalesce(F.sum("most"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).head()
        if n == capped:
            return table.withColumn("target", F.least(F.col("most").cast("double"), share))
        total, left, capped = float(whole) - float(most), spare - weight, n
    return table.withColumn("target", F.col("most").cast("double"))


def planned(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP, carry: list[str] | None = None) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, start, tilt, and the columns ``carry`` as c0, c1, ...

    ``size`` counts the words of the whole text (null: 0); ``taken`` the words that the mix
    takes, repeats counted: the document where a source's demand ends is taken up to that
    word, so taken words sum to the target without its fraction.  ``start`` counts the words of the
    source before the document.  A null source is a source, the last one; sources of size 0 take
    nothing.  Repeated rows are documents of their own; rows of one doc_id and text come in the order of a hash of their carried columns.  An empty table gives an empty result.
    The table of sources stays in Spark, and is broadcast only below ``BROADCAST_BYTES``.
    """
    carry = carry or []
    text = F.col("text").cast("string")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("tie"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
    )
    hashable = [f"c{i}" for i in range(len(carry)) if not any(x in sized.schema[f"c{i}"].dataType.simpleString() for x in ("map<", "variant"))]
    sized = sized.withColumn("more", F.xxhash64(*hashable) if hashable else F.lit(0).cast("long"))
    scratch = Scratch(docs.sparkSession, "curriculum")
    found = scratch.keep(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    rows, number, long = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0))).head()
    many = max(BUCKET_ROWS, int(rows**0.5))
    table = targets(found, scratch, weights, budget, cap).select("source", "source_no", "source_size", "target", "tilt", F.ceil(F.col("n") / many).alias("buckets"))
    table = F.broadcast(table) if number * SOURCE_BYTES + long <= BROADCAST_BYTES else table
    sized = sized.withColumnRenamed("source", "own").join(table, F.col("own").eqNullSafe(F.col("source")))
    part = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    sized = sized.withColumn("bucket", F.floor(part * F.col("buckets") / F.lit(1 << 32)).cast("int")).drop("own", "source", "buckets")
    sums = sized.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("turn", "tie", "more").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(sums, ["source_no", "bucket"]).withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    demand = F.floor("target").cast("long")
    rounds = [F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), demand - F.col("start") - k * F.col("source_size"))) for k in range(cap)]
    taken = rounds[0]
    for r in rounds[1:]:
        taken = taken + r
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "start", "tilt", "tie", "more", *[f"c{i}" for i in range(len(carry))])


def position(start, words, target, tilt):
    """Where in training the middle of ``words`` words after ``start`` of a source comes: the demand's inverse."""
    share = (start + words / 2) / target
    return 2 * share / ((1 - tilt) + F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, once for each time they are taken, range-sorted by position.

    A document taken in part has its text cut after the last word taken; a column n_chars, if
    there is one, follows.
    """
    names = docs.columns
    plan = planned(docs, weights, budget, cap, names)
    copy = F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))
    rows = plan.where("taken > 0").withColumn("copy", copy)
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    rows = rows.withColumn("words", words).where("words > 0")
    rows = rows.withColumn("position", position(F.col("start") + F.col("copy") * F.col("source_size"), F.col("words"), F.col("target"), F.col("tilt")))
    text = F.col(f"c{names.index('text')}")
    cut = F.array_join(F.slice(F.split(text, r"(?<=\S)(?=\s)"), F.lit(1), F.col("words").cast("int")), "")
    held = F.when(F.col("words") < F.col("size"), cut).otherwise(text)
    rows = rows.orderBy("position", "doc_id", "tie", "more", "copy")
    return rows.select(*[held.alias("text") if n == "text" else F.when(F.col("words") < F.col("size"), F.length(held)).otherwise(F.col(f"c{i}")).cast(docs.schema[n].dataType).alias(n) if n == "n_chars" else F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
