"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(text, '{_UPPER}', '{_LOWER}')"
_EMPTY_SHA = "sha256('')"

OP1 = f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOW}, ''), '[^ \\t-\\r]+') AS w FROM documents),
    s AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
    ),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (n - c) UNION ALL SELECT b, a FROM p WHERE 100 * c >= 85 * (n - c)),
    r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a),
    k AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
    SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN k USING (doc_id)
"""

OP2 = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
    ), s AS (
        SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
"""

_PLAIN = f"regexp_extract_all(coalesce({_LOW}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP5 = f"""
    WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents), b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
    p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
    g AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
    h AS (SELECT doc_id, item_id, i, n FROM g JOIN p USING (n, g)),
    x AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM h) GROUP BY doc_id),
    y AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, {_EMPTY_SHA}) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""

OP8 = """
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS turn, md5(coalesce(text, '')) AS tie FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][1 + no % 3] AS weight, [0.5, 0.0, -0.5][1 + no % 3]::DOUBLE AS tilt, 2 * source_size AS cap, (SELECT 1.5 * sum(source_size)::DOUBLE FROM s) AS total, (SELECT sum([3, 1, 2][1 + no % 3])::DOUBLE FROM s) AS all_weights FROM s),
    o AS (SELECT *, total - coalesce(sum(cap) OVER before, 0)::DOUBLE AS left_total, all_weights - coalesce(sum(weight) OVER before, 0)::DOUBLE AS left_weights
          FROM w WINDOW before AS (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    c AS (SELECT *, cap <= weight * left_total / left_weights AS capped FROM o),
    f AS (SELECT arg_min(left_total, cap / weight) AS t, arg_min(left_weights, cap / weight) AS v FROM c WHERE NOT capped),
    g AS (SELECT source, source_size, tilt, CASE WHEN capped THEN cap::DOUBLE ELSE weight * t / v END AS target FROM c LEFT JOIN f ON true),
    p AS (SELECT d.*, source_size, tilt, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY turn, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
    q AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - start)) + greatest(0, least(size, floor(target)::BIGINT - start - source_size)) AS taken FROM p),
    z AS (SELECT *, (start + least(taken, size)::DOUBLE / 2) / target AS share FROM q)
    SELECT doc_id, size, source_size, round(target, 6) AS target, taken, CASE WHEN taken > 0 THEN round(2 * share / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)), 9) END AS position FROM z
"""


def _kind(number: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: what stands before a match has the lengths of all earlier pieces and matches."""
    own = f"regexp_extract_all(text, {pattern}, {group})"
    return f"""
        SELECT row, doc_id, owner, {number} AS kind, spot AS start, spot + length(m) AS stop, sha256(own) AS hash FROM (
            SELECT row, doc_id, owner, unnest(ms) AS m, unnest(os) AS own, unnest(list_transform(range(1, len(ms) + 1), lambda i:
                (list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT)) AS spot
            FROM (SELECT row, doc_id, owner, regexp_extract_all(text, {pattern}, 0) AS ms, {own} AS os, string_split_regex(text, {pattern}) AS ps FROM docs)
        ) WHERE length(own) >= {least}
    """


_WORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
OP10 = f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source AS owner, coalesce(text, '') AS text FROM documents),
    spans AS (
        {_kind(0, f"'{_WORD}[\"'']? *[:=] *[\"'']?([A-Za-z0-9+/_.=-]+)'", 2, 8)} UNION ALL {_kind(1, "'AKIA[A-Z0-9]+'", 0, 16)} UNION ALL {_kind(2, "'[0-9a-f]{32,}'", 0, 32)}
        UNION ALL {_kind(3, "'eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]*'", 0, 24)}
        UNION ALL {_kind(4, "'(?:gh[opsu]_|xox[abp]-|glpat-|sk_live_)[A-Za-z0-9_-]{16,}'", 0, 20)}
        UNION ALL {_kind(5, "'[a-z][a-z0-9+.-]{1,15}://[^ \\t-\\r:@/]{1,64}:([^ \\t-\\r@/]{6,128})@'", 1, 6)}
    ),
    held AS (SELECT hash, count(DISTINCT owner) <= 1 OR (count(DISTINCT owner) <= 2 AND count(DISTINCT doc_id) <= 8) AS live FROM spans GROUP BY hash),
    judged AS (SELECT *, kind || '' AS k, ['assign', 'access', 'hex', 'jwt', 'prefixed', 'url'][kind + 1] || ':' || start || ':' || stop AS span FROM spans JOIN held USING (hash)),
    each AS (
        SELECT row, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
               string_agg(span, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3 OR live) AS spans,
               count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example FROM judged GROUP BY row
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
           coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
    FROM docs LEFT JOIN each USING (row)
"""
