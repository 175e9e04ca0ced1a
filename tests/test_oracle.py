"""Every registered query against its DuckDB oracle at sf0.001."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from lamina.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    """Of the library's own queries; those of an optional subpackage may have none."""
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _canon([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _canon(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["url", "granularity", "bucket", "pageviews"]
    assert df.count() > 0
