"""Every registered query that has SQL against DuckDB on the smallest tables; the others must run."""

from __future__ import annotations

import math
import os

import pytest

import lodestrata.plans.cluster_queries  # noqa: F401
import lodestrata.plans.sample_queries  # noqa: F401
from lodestrata.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows_of(frame):
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else v

    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


def test_entry(spark):
    import __spark_entry__ as E

    assert E.entry(spark).count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
