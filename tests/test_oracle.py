"""Every registered query against its SQL form (DuckDB) at sf0.001.

Same comparison as the driver's gate: row count, sorted column names and the
order-insensitive multiset of exact values.  Queries without a SQL form are
run for their row count only.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, rows_of, type_diff  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from quakescope.plans import analysis, analysis_sql, oracle, registry  # noqa: E402

QUERIES = {**registry.QUERIES, **analysis.QUERIES}
ORACLE = {**oracle.ORACLE, **analysis_sql.ORACLE}

SLOW = {"kmeans_sampled", "report_bundle"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k in ORACLE))
def test_matches_sql(spark, duck, key):
    frame = QUERIES[key](spark, SF_SMALL)
    rel = duck.sql(ORACLE[key])
    assert type_diff(frame, rel) == {}
    got = frame.toPandas()
    want = rel.df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in ORACLE and k not in SLOW))
def test_rows_only(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() >= 1


def test_entry_schema_stable(spark):
    from __spark_entry__ import entry

    a, b = entry(spark), entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert a.columns == ["lat_grid", "lon_grid", "event_count", "avg_mag", "max_mag"]
