import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quakescope.session import build_session

    s = build_session("quakescope-tests", master="local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="qs-test-ckpt-"))
    yield s
    s.stop()


def catalog_rows(spark, rows):
    """DataFrame with the catalogue schema from dicts (missing keys → null)."""
    from quakescope.schema import CATALOG

    full = [tuple(r.get(f.name) for f in CATALOG.fields) for r in rows]
    return spark.createDataFrame(full, CATALOG)


def base_row(**kw):
    row = {"time": "2026-05-01T10:00:00.000Z", "latitude": 1.0, "longitude": 2.0, "depth": 10.0,
           "mag": 2.5, "rms": 0.5, "type": "earthquake", "id": "a"}
    row.update(kw)
    return row
