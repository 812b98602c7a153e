"""The registered queries on the smallest tables: against their SQL, or their contract's columns and row counts."""

from __future__ import annotations

import math
import os
import zlib

import pytest

from lodestrata.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
COLUMNS = {
    "op3_ctw_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"}, "op4_elias_fano_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op6_ftrl_toxicity": {"doc_id", "held_out", "score", "predicted"}, "op7_separator_scan": {"doc_id", "n_tokens"}, "op9_html_templates": {"page_id", "url", "text", "n_chars"},
}


def rows_of(frame):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else v

    return sorted((tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        expected = c.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(expected.columns) and rows_of(got) == rows_of(expected)
        return
    table, key = ("pages", "page_id") if name.startswith("op9_") else ("documents", "doc_id")
    ids = [r[0] for r in c.execute(f"SELECT {key} FROM {table} ORDER BY 1").fetchall()]
    assert set(got.columns) == COLUMNS[name] and sorted(got[key]) == ids


def test_base_scores_equal_sql(spark):
    """What SQL can say of op3: all columns but those of the context tree."""
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    got = QUERIES["op3_ctw_scores"](spark, SF).toPandas()
    held = {i for i in got.doc_id if zlib.crc32(str(i).encode()) % 7 == 2}
    c.execute("CREATE TABLE held AS SELECT unnest($1::BIGINT[]) AS doc_id", [sorted(map(int, held))])
    expected = c.execute(f"""
        WITH t AS (SELECT doc_id, unnest(list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+'), chr(10))) AS w FROM '{SF}/documents.parquet'),
        k AS (SELECT w, count(*) AS c FROM t WHERE doc_id NOT IN (SELECT doc_id FROM held) GROUP BY w), s AS (SELECT sum(c) AS n, count(*) AS v FROM k)
        SELECT doc_id, doc_id IN (SELECT doc_id FROM held) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n)::BIGINT AS train_tokens,
               sum(log10((coalesce(c, 0) + 1) / (n + v + 1)::DOUBLE)) AS base_score FROM t LEFT JOIN k USING (w) CROSS JOIN s GROUP BY doc_id
    """).df()
    assert rows_of(got[list(expected.columns)]) == rows_of(expected) and (got.score < 0).all()
