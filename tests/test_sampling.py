"""Bottom-k samples against a brute-force sort on the driver (small fixture)."""

import hashlib

import pytest

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.operators.sampling import bottom_k
from quakescope.sources.fixture import quakes


def brute(ids, n, seed):
    keyed = sorted(((hashlib.md5(f"{i}#{seed}".encode()).hexdigest(), i) for i in ids))
    return [i for _, i in keyed[:n]]


@pytest.fixture(scope="module")
def display(spark):
    return C.display_clean(quakes(spark, SF_SMALL))


@pytest.mark.parametrize("n,seed", [(1, 42), (10, 42), (100, 1), (500, 7), (5000, 42)])
def test_bottom_k_exact(spark, display, n, seed):
    ids = [r["id"] for r in display.select("id").collect()]
    got = [r["id"] for r in bottom_k(display, n, seed).select("id").collect()]
    assert sorted(got) == sorted(brute(ids, n, seed))
    assert len(got) == min(n, len(ids))


def test_bottom_k_repeatable(spark, display):
    a = sorted(r["id"] for r in bottom_k(display, 50, 3).select("id").collect())
    b = sorted(r["id"] for r in bottom_k(display.repartition(7), 50, 3).select("id").collect())
    assert a == b


def test_bottom_k_empty(spark, display):
    assert bottom_k(display.limit(0), 10, 1).count() == 0
    assert bottom_k(display, 0, 1).count() == 0 and bottom_k(display, -3, 1).count() == 0


def test_bottom_k_refines_and_handles_one_hot_key(spark, display, monkeypatch):
    import quakescope.operators.sampling as samp

    monkeypatch.setattr(samp, "STEP", 1)
    ids = [r["id"] for r in display.select("id").collect()]
    # refinement path: one digit at a time, distinct ids
    for n in (10, 300):
        got = [r["id"] for r in samp.bottom_k(display, n, 42).select("id").collect()]
        assert sorted(got) == sorted(brute(ids, n, 42))
    # one key on a third of the rows: all of them tie on the rank
    from pyspark.sql import functions as F

    skewed = (display.withColumn("_r", F.monotonically_increasing_id())
              .withColumn("id", F.when(F.col("_r") % 3 == 0, F.lit("HOT")).otherwise(F.col("id")))
              .drop("_r").repartition(5))
    rows = skewed.select("id").collect()
    sk_ids = [r["id"] for r in rows]
    hot_rank = hashlib.md5("HOT#42".encode()).hexdigest()
    n = 600
    got = samp.bottom_k(skewed, n, 42).select("id").collect()
    assert len(got) == n
    want = brute(set(sk_ids), len(set(sk_ids)), 42)
    below = [i for i in want if hashlib.md5(f"{i}#42".encode()).hexdigest() < hot_rank]
    got_ids = [r["id"] for r in got]
    if len(below) < n:
        assert set(below) <= set(got_ids)
        assert got_ids.count("HOT") == min(n - len(below), sk_ids.count("HOT"))


def test_ties_are_broken_by_content_not_position(spark, display):
    from pyspark.sql import functions as F

    hot = display.withColumn("id", F.lit("HOT"))
    a, b = (sorted(map(str, bottom_k(t, 37, 5).collect())) for t in (hot, hot.repartition(6)))
    assert len(a) == 37 and a == b
