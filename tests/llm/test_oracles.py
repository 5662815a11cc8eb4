"""Corpus queries with SQL twins, compared with DuckDB on the smallest tables."""

import duckdb
import pytest

from quarry.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[columns].values.tolist()), key=repr)
    assert rows(got) == rows(want)
