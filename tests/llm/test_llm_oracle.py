"""Queries with an SQL form, against DuckDB."""

import os

import duckdb
import pytest

from quakescope.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas().convert_dtypes()
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        path = f"{SF}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    want = con.execute(registry.ORACLE[name]).fetchdf().convert_dtypes()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a, b = (t[columns].sort_values(columns).reset_index(drop=True) for t in (got, want))
    assert len(a) == len(b)
    assert a.dtypes.astype(str).tolist() == b.dtypes.astype(str).tolist()
    assert a.equals(b)
