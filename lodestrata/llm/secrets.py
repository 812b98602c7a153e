"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Regular expressions find candidates in every whole text.  A candidate's hash is aggregated
over the corpus by distinct repositories and owners: what many owners, or two owners in many
repositories, hold is a copied example; what one owner holds, in however many repositories, or two
in few looks like a live credential.  The base kinds are always reported; the further kinds only
where the candidate is owner-specific.

Positions come from the pieces between matches: a match ends after all pieces and matches up to
it, whose lengths in code points add up in a running sum over the matches of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch

#: Kinds in order: name, a cheap test that any text with a match passes, pattern, group that is the secret, least length of it.
BASE = (
    ("assign", "(?i)passw|secret|token|api_?key", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", "AKIA", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32}", r"[0-9a-f]{32,}", 0, 32),
)
MORE = (
    ("jwt", "eyJ", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*", 0, 24),
    ("prefixed", "gh[opsu]_|xox[abp]-|glpat-|sk_live_", r"(?:gh[opsu]_|xox[abp]-|glpat-|sk_live_)[A-Za-z0-9_-]{16,}", 0, 20),
    ("url", "://", r"[a-z][a-z0-9+.-]{1,15}://[^\s:@/]{1,64}:([^\s@/]{6,128})@", 1, 6),
)
#: A candidate that more owners hold, or several owners in more repositories, is a copied example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 8
#: Candidates with over 1 / HOT of all spans are fewer than HOT.
HOT = 1000
_MATCH = "array<struct<kind:int,gap:int,size:int,hash:string>>"
_SPAN = "array<struct<start:bigint,kind:int,stop:bigint,hash:string>>"


def _matches(text: Column, number: int, kind: tuple) -> Column:
    """All matches of one kind, in order: what stands before each, its size, and the hash of its secret if that is long enough."""
    name, test, pattern, group, least = kind
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    own = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("piece"), whole.alias("whole"), own.alias("own"))
    digest = lambda r: F.when(F.length(r["own"]) >= least, F.sha2(r["own"].cast("binary"), 256))
    found = F.transform(rows, lambda r: F.struct(F.lit(number).alias("kind"), F.length(r["piece"]).alias("gap"), F.length(r["whole"]).alias("size"), digest(r).alias("hash")))
    passes = text.contains(test) if test in ("AKIA", "eyJ", "://") else text.rlike(test)
    return F.when(passes, found).otherwise(F.array().cast(_MATCH))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in (*BASE, *MORE)])
    return F.concat_ws(",", F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["stop"].cast("string"))))


def found_secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row for each document: doc_id, base and added (arrays of spans), owner-specific and example counts.

    Columns: doc_id; ``base`` spans; ``added`` spans of the further kinds whose candidate is
    owner-specific; ``n_live`` and ``n_example``, the candidates of any kind that are
    owner-specific or copied examples.  Spans are structs (start, kind, stop, hash), in code
    points, stop exclusive; kind is the place in BASE + MORE.  A null text has none.  Null
    repositories and owners are not counted as holders.  Rows repeat as they come; an empty
    table gives an empty result.

    Matches leave their text as rows, so a text's work follows its length and matches.  No more than
    ``HOT`` candidates can have over that share of all spans: these are looked up by a broadcast, the others by a shuffle.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hits = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{repository}`").cast("string").alias("repository"), F.col(f"`{owner}`").cast("string").alias("owner"),
        F.concat(*[_matches(text, i, k) for i, k in enumerate((*BASE, *MORE))]).alias("found"),
    )
    hits = scratch.keep(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    each = hits.where(F.size("found") > 0).select("row", "repository", "owner", F.posexplode("found").alias("place", "m")).select("row", "repository", "owner", "place", "m.*")
    so_far = F.sum(F.col("gap").cast("long") + F.col("size")).over(Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("stop", so_far).where("hash is not null")
    each = scratch.keep(each.select("row", "repository", "owner", F.struct((F.col("stop") - F.col("size")).alias("start"), "kind", "stop", "hash").alias("span"), "hash"), "spans")
    few = (F.col("owners") <= 1) | ((F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES))
    held = each.groupBy("hash").agg(F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners"), F.count("*").alias("n")).select("hash", few.alias("live"), "n")
    held = scratch.keep(held, "held")
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]
    hot = F.col("n") * HOT > total
    often = F.broadcast(held.where(hot).select("hash", "live"))
    rest = each.join(often.select("hash"), "hash", "left_anti").join(held.where(~hot).select("hash", "live"), "hash")
    judged = each.join(often, "hash").select("row", "span", "live").unionByName(rest.select("row", "span", "live"))
    is_base = F.col("span.kind") < len(BASE)
    judged = judged.groupBy("row").agg(
        F.collect_list(F.when(is_base, F.col("span"))).alias("base"), F.collect_list(F.when(F.col("live") & ~is_base, F.col("span"))).alias("added"), F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example")
    )
    out = hits.select("row", "doc_id").join(judged, "row", "left")
    none, zero = F.array().cast(_SPAN), F.lit(0).cast("long")
    return out.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k[0]}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat("base", "added")).alias("spans"), "n_live", "n_example")
