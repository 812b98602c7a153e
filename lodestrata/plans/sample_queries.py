"""Queries over samples: documents with labels stand for images with scores, events for measured files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.hashing import bucket_of, simhash
from lodestrata.functions.scores import coerce_score
from lodestrata.functions.text import checksum, path_stem
from lodestrata.operators.dedup import greedy_dedup, near_pairs
from lodestrata.operators.filters import reject_reason, rejection_counts, unsafe
from lodestrata.operators.joins import attach, missing, missing_summary, present
from lodestrata.operators.normalize import normalize_by_column, normalize_by_value, score_filter, with_sidecar
from lodestrata.operators.sampling import exact_sample, oversampled
from lodestrata.operators.shards import metadata_json, version_tag
from lodestrata.operators.validate import ingest_summary, null_counts
from lodestrata.plans.registry import query, table
from lodestrata.sources.images import ranked_paths

_SCORED = "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.quality * 5 + (d.n_chars % 50) / 10.0::DOUBLE AS score FROM documents d LEFT JOIN labels l USING (doc_id)"
_WORDS = "SELECT doc_id, md5(w) AS h FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '\\s+')) AS w FROM documents) WHERE w <> ''"
_HASHES = f"""
    bits AS (
        SELECT doc_id, b, CASE WHEN 2 * sum((('0x' || substr(h, 1, 8))::BIGINT >> b) & 1) > count(*) THEN 1::BIGINT << b ELSE 0 END AS hi,
               CASE WHEN 2 * sum((('0x' || substr(h, 9, 8))::BIGINT >> b) & 1) > count(*) THEN 1::BIGINT << b ELSE 0 END AS lo
        FROM ({_WORDS}) CROSS JOIN (SELECT unnest(range(32)) AS b) GROUP BY doc_id, b
    ),
    hashes AS (SELECT doc_id, sum(hi)::BIGINT AS hi, sum(lo)::BIGINT AS lo, sum(hi)::BIGINT >> 20 AS bucket FROM bits GROUP BY doc_id)
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a nullable score: 5 for quality, and a fraction of the length."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").withColumn("score", F.col("quality") * 5 + (F.col("n_chars") % 50) / 10.0)


@query(f"""
    SELECT url, caption, aesthetic_score FROM (
        SELECT coalesce(CASE WHEN doc_id % 2 = 0 THEN 'http://h/' || doc_id END, CASE WHEN doc_id % 5 <> 0 THEN 'http://h/' || doc_id END) AS url,
               CASE WHEN doc_id % 3 = 0 THEN lang ELSE source END AS caption, coalesce(score, 2.0) AS aesthetic_score FROM ({_SCORED})
    ) WHERE url IS NOT NULL AND aesthetic_score >= 2.0
""")
def normalize_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by the first value present, null scores kept at the least one; rows with neither url go."""
    url = F.concat(F.lit("http://h/"), F.col("doc_id"))
    wide = scored(spark, sf_dir).select(
        F.when(F.col("doc_id") % 2 == 0, url).alias("URL"), F.when(F.col("doc_id") % 5 != 0, url).alias("url"), F.lit(None).cast("string").alias("TEXT"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source")).alias("text"), F.col("lang").alias("caption"), F.col("score").alias("aesthetic_score"),
    )
    return normalize_by_value(wide, 2.0)


@query(f"SELECT source AS url, lang AS caption, score AS aesthetic_score FROM ({_SCORED}) WHERE score >= 5.0")
def normalize_by_column_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by column name, null scores dropped."""
    return normalize_by_column(scored(spark, sf_dir).select(F.col("source").alias("Url"), F.col("lang").alias("Caption"), F.col("score").alias("AESTHETIC_SCORE")), 5.0)


@query("""
    SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN value WHEN event_id % 7 = 5 THEN 100.0 ELSE NULL END AS score FROM events
""")
def coerce_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of numbers, blanks, words and suffixed numbers to doubles."""
    kind, value = F.col("event_id") % 7, F.col("value").cast("string")
    raw = F.when(kind == 0, value).when(kind == 1, F.concat(F.lit(" "), value, F.lit(" "))).when(kind == 2, "").when(kind == 3, "abc").when(kind == 4, "nan").when(kind == 5, "1e2").otherwise(F.concat(value, F.lit("d")))
    return table(spark, sf_dir, "events").select("event_id", coerce_score(raw).alias("score"))


@query(f"SELECT doc_id, score FROM ({_SCORED}) WHERE score >= 5.0")
def score_filter_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter(scored(spark, sf_dir).select("doc_id", "score"), 5.0, False, "score")


@query(f"SELECT doc_id, coalesce(score, 5.0) AS score FROM ({_SCORED}) WHERE coalesce(score, 5.0) >= 5.0")
def score_filter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter(scored(spark, sf_dir).select("doc_id", "score"), 5.0, True, "score")


@query("SELECT page_id, url FROM pages WHERE url IS NOT NULL AND url <> ''")
def url_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an index that have a url; their number goes along as the caption."""
    rows = normalize_by_value(table(spark, sf_dir, "pages").select("url", F.col("page_id").cast("string").alias("caption")), 0.0)
    return rows.select(F.col("caption").cast("long").alias("page_id"), "url")


@query(r"SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', '') || '.jpg', '([^/]+?)(\.[^./]*)?$', 1) AS stem FROM pages")
def path_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit(".jpg"))
    return table(spark, sf_dir, "pages").select("page_id", path_stem(path).alias("stem"))


@query("""
    SELECT 'img/' || event_id || '.jpg' AS image_path, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS url, '' AS original_caption,
           CASE WHEN event_id % 3 = 0 THEN 4.0 ELSE value END AS aesthetic_score FROM events
""")
def sidecar_json_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with the JSON beside them; a third have none."""
    events = table(spark, sf_dir, "events")
    images = events.select(F.concat(F.lit("img/"), F.col("event_id"), F.lit(".jpg")).alias("image_path"))
    side = events.where("event_id % 3 <> 0").select(
        F.concat(F.lit("img/"), F.col("event_id"), F.lit(".json")).alias("sidecar_path"), F.to_json(F.struct(F.col("event_type").alias("url"), F.col("value").alias("aesthetic_score"))).alias("content")
    )
    return with_sidecar(images, side, 4.0)


_MEASURED = "SELECT event_id, user_id AS width, (json_extract_string(props, '$.k'))::INTEGER AS height, value AS score FROM events"


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measured files: user_id is the width, the k of props the height, value the score."""
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("width"), F.get_json_object("props", "$.k").cast("int").alias("height"), F.col("value").alias("score"))


@query(f"SELECT event_id, width, height FROM ({_MEASURED}) WHERE width >= 20 AND height >= 20 AND greatest(width, height) <= 2 * least(width, height)")
def resolution_aspect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = reject_reason(F.col("width"), F.col("height"), F.lit(None).cast("double"), 20, 2.0, 0.0)
    return measured(spark, sf_dir).where(reason.isNull()).select("event_id", "width", "height")


_REASONED = f"""
    SELECT event_id, CASE WHEN coalesce(width <= 0 OR height <= 0, true) THEN 'file_integrity' WHEN width < 20 OR height < 20 THEN 'resolution'
        WHEN greatest(width, height)::DOUBLE / greatest(least(width, height), 1) > 2.0 THEN 'aspect_ratio' WHEN coalesce(score < 30.0, false) THEN 'aesthetic_score' END AS reject_reason
    FROM ({_MEASURED})
"""


@query(_REASONED)
def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failing predicate of each file, null for survivors."""
    return measured(spark, sf_dir).select("event_id", reject_reason(F.col("width"), F.col("height"), F.col("score"), 20, 2.0, 30.0).alias("reject_reason"))


@query(f"SELECT reject_reason, count(*) AS n FROM ({_REASONED}) WHERE reject_reason IS NOT NULL GROUP BY ALL")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_counts(quality_cascade(spark, sf_dir))


@query("SELECT doc_id, greatest(toxic * 0.9, quality * 0.1)::DOUBLE AS nsfw, toxic * 0.9 >= 0.3 AS rejected FROM labels")
def nsfw_max_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest score among unsafe labels, and whether it rejects."""
    from lodestrata.functions.scores import max_label_score
    from lodestrata.operators.filters import UNSAFE_LABELS

    guess = F.array(
        F.struct(F.lit("NSFW").alias("label"), (F.col("toxic") * 0.9).alias("score")), F.struct(F.lit("sexy").alias("label"), (F.col("quality") * 0.1).alias("score")), F.struct(F.lit("normal").alias("label"), F.lit(0.95).alias("score")),
    )
    rows = table(spark, sf_dir, "labels").select("doc_id", guess.alias("p"))
    return rows.select("doc_id", max_label_score(F.col("p"), UNSAFE_LABELS).alias("nsfw"), unsafe(F.col("p"), 0.3).alias("rejected"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), 100, "doc_id")


@query("SELECT doc_id FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 70")
def oversample_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_sample(table(spark, sf_dir, "documents").select("doc_id"), oversampled(50, 1.4), "doc_id", 7)


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 40")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestrata.sources.tables import head_slice

    return head_slice(table(spark, sf_dir, "documents").select("doc_id"), 40, "doc_id")


def bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(table(spark, sf_dir, "documents")).withColumn("bucket", bucket_of(F.col("hi"), 12, 32))


@query(f"WITH {_HASHES} SELECT doc_id, hi, lo, bucket FROM hashes")
def simhash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucketed(spark, sf_dir)


@query(f"""
    WITH {_HASHES} SELECT x.doc_id AS a, y.doc_id AS b, (bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)))::INTEGER AS distance
    FROM hashes x JOIN hashes y ON x.bucket = y.bucket AND x.doc_id < y.doc_id WHERE bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 6
""")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(bucketed(spark, sf_dir), ("hi", "lo"), 6, "doc_id")


_GREEDY = f"""
    WITH RECURSIVE {_HASHES},
    b AS (
        SELECT bucket, list(doc_id ORDER BY doc_id) AS ids, list(hi ORDER BY doc_id) AS h, list(lo ORDER BY doc_id) AS l, list(score ORDER BY doc_id) AS s, count(*) AS n
        FROM hashes JOIN (SELECT doc_id, score FROM ({_SCORED})) USING (doc_id) GROUP BY bucket
    ),
    r AS (
        SELECT bucket, 1::BIGINT AS i, list_transform(ids, lambda x: true) AS alive FROM b
        UNION ALL
        SELECT bucket, i + 1, CASE WHEN NOT alive[i] THEN alive ELSE list_transform(range(1, n + 1), lambda k:
            CASE WHEN k < i THEN alive[k] WHEN k = i THEN stop IS NULL
                 ELSE alive[k] AND NOT (bit_count(xor(h[i], h[k])) + bit_count(xor(l[i], l[k])) <= 6 AND (stop IS NULL OR k < stop)) END) END
        FROM (
            SELECT r.bucket, r.i, r.alive, b.h, b.l, b.n, list_min(list_filter(range(r.i + 1, b.n + 1), lambda k:
                r.alive[k] AND bit_count(xor(b.h[r.i], b.h[k])) + bit_count(xor(b.l[r.i], b.l[k])) <= 6 AND NOT coalesce(b.s[r.i] >= b.s[k], false))) AS stop
            FROM r JOIN b USING (bucket) WHERE r.i <= b.n
        )
    ),
    done AS (SELECT unnest(b.ids) AS doc_id, NOT unnest(r.alive) AS is_duplicate FROM r JOIN b USING (bucket) WHERE r.i = b.n + 1),
    marked AS (SELECT d.doc_id, coalesce(is_duplicate, false) AS is_duplicate FROM documents d LEFT JOIN done USING (doc_id))
"""


@query(f"{_GREEDY} SELECT doc_id, is_duplicate FROM marked")
def greedy_dedup_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-dependent removal within buckets; a document without words has no hash and stays."""
    hashes = scored(spark, sf_dir).select("doc_id", "score").join(bucketed(spark, sf_dir), "doc_id", "left")
    return greedy_dedup(hashes, ("hi", "lo"), "score", 6, "doc_id").select("doc_id", "is_duplicate")


@query(f"{_GREEDY} SELECT count(*) AS before_dedup, count(*) FILTER (WHERE is_duplicate) AS duplicates, count(*) FILTER (WHERE NOT is_duplicate) AS kept FROM marked")
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = greedy_dedup_flags(spark, sf_dir)
    return flags.agg(F.count("*").alias("before_dedup"), F.count_if("is_duplicate").alias("duplicates"), F.count_if(~F.col("is_duplicate")).alias("kept"))


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as captions of documents, many to one: the last turn wins."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "role", "turn")


@query("SELECT doc_id, role FROM documents LEFT JOIN (SELECT conv_id AS doc_id, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id) USING (doc_id)")
def caption_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach(table(spark, sf_dir, "documents").select("doc_id"), captions(spark, sf_dir), "doc_id", "role", "turn")


@query("SELECT doc_id, coalesce(label, -1) AS label FROM documents LEFT JOIN (SELECT vec_id AS doc_id, label FROM embeddings) USING (doc_id)")
def clip_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label", F.col("vec_id").alias("row_id"))
    return attach(table(spark, sf_dir, "documents").select("doc_id"), right, "doc_id", "label", "row_id", F.lit(-1))


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def latent_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def latent_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT count(*) AS n_missing, min(doc_id) AS first_missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_latents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id").withColumn("row_id", F.col("doc_id"))
    return missing_summary(docs, table(spark, sf_dir, "labels"), "doc_id", "row_id")


@query(f"SELECT doc_id, doc_id % 8 AS cluster_id, coalesce(score, 0.0) AS aesthetic_score, 0.0::DOUBLE AS cluster_distance, '' AS original_url, lang AS original_caption FROM ({_SCORED})")
def shard_metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as JSON and read back, so that spacing does not matter."""
    none = F.lit(None)
    rows = scored(spark, sf_dir).select("doc_id", (F.col("doc_id") % 8).alias("cluster_id"), F.col("score").alias("aesthetic_score"), none.cast("double").alias("cluster_distance"), none.cast("string").alias("url"), F.col("lang").alias("original_caption"))
    parsed = F.from_json(metadata_json(), "cluster_id long, aesthetic_score double, cluster_distance double, original_url string, original_caption string")
    return rows.select("doc_id", parsed.alias("j")).select("doc_id", "j.*")


@query("SELECT doc_id, 'sha256:' || sha256(text) AS checksum FROM documents")
def content_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", checksum(F.col("text").cast("binary")).alias("checksum"))


@query("""
    SELECT 'v1.0.0-' || substr(sha256('{' || coalesce(string_agg('"' || source || '": "' || c || '"', ', ' ORDER BY source), '') || '}'), 1, 8) AS tag
    FROM (SELECT source, sum((('0x' || substr(sha256(text), 1, 8))::BIGINT))::BIGINT AS c FROM documents WHERE source IS NOT NULL GROUP BY source)
""")
def version_tag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag of all content: the sources' sums of digests stand for the shards' checksums."""
    part = F.conv(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 8), 16, 10).cast("long")
    sums = table(spark, sf_dir, "documents").where("source is not null").groupBy("source").agg(F.sum(part).alias("c")).collect()
    return spark.createDataFrame([(version_tag({r["source"]: str(r["c"]) for r in sums}),)], "tag string")


@query(f"""
    SELECT unnest(['text', 'lang', 'quality', 'score']) AS column_name, unnest([a, b, c, d]) AS n_null FROM (
        SELECT count(*) FILTER (WHERE text IS NULL) AS a, count(*) FILTER (WHERE lang IS NULL) AS b, count(*) FILTER (WHERE quality IS NULL) AS c, count(*) FILTER (WHERE score IS NULL) AS d FROM ({_SCORED}))
""")
def null_counts_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(scored(spark, sf_dir), ["text", "lang", "quality", "score"])


@query(f"SELECT count(*) AS n, bool_or(score IS NOT NULL) AS has_score, bool_and(coalesce(score <= 0, false)) AS all_zero FROM ({_SCORED})")
def validate_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_summary(scored(spark, sf_dir), "score")


@query("""
    SELECT path, (CASE ext WHEN 'jpg' THEN 1 WHEN 'png' THEN 2 ELSE 3 END)::BIGINT AS ext_rank FROM (
        SELECT 'img/' || page_id || '.' || ext AS path, ext FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'webp' ELSE 'jpeg' END AS ext FROM pages)
    ) WHERE ext <> 'jpeg'
""")
def union_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed kinds in the order of kind and path; other kinds are passed over."""
    ext = F.element_at(F.array(*[F.lit(x) for x in ("jpg", "png", "webp", "jpeg")]), (F.col("page_id") % 4 + 1).cast("int"))
    paths = table(spark, sf_dir, "pages").select(F.concat(F.lit("img/"), F.col("page_id"), F.lit("."), ext).alias("path"))
    return ranked_paths(paths).orderBy("ext_rank", "path")
