"""Every registered query against its DuckDB oracle SQL (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got_cols, got = _rows(entry.queries()[name](spark, SF0001).toPandas())
    want_cols, want = _rows(duck.sql(entry.oracle_sql()[name]).df())
    assert got_cols == want_cols
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF0001).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["value", "distance"]
    assert df.count() > 0
