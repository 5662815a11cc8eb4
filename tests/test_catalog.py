"""Every registered query equals its SQL twin (DuckDB) on the smallest driver tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from quarry.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, pd.Timestamp):
        return v.tz_convert("UTC").tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")), key=repr)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_partkey", "title", "tag_count", "discipline"]
    assert df.count() > 0
