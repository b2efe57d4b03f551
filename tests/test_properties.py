"""Property tests on random small catalogues."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import catalog_rows
from quakescope.operators import clean as C
from quakescope.operators import reports as R

TIMES = st.sampled_from([None, "not-a-time", "2024-02-29T23:59:59.999Z", "2025-01-01T00:00:00.000Z",
                         "2025-06-15T12:30:00.000Z"])
NUM = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 2.0, 2.5, 3.0, 6.0, 7.0, 70.0, 300.0,
                                            701.0, float("nan")]))
ROW = st.fixed_dictionaries({
    "time": TIMES,
    "latitude": st.one_of(st.none(), st.sampled_from([0.5, -0.5, 1.49, 2.5, 45.0])),
    "longitude": st.one_of(st.none(), st.sampled_from([0.5, -179.5, 179.5, 100.25])),
    "depth": NUM, "mag": NUM,
    "rms": st.one_of(st.none(), st.sampled_from([0.1, 2.0, 2.01])),
    "type": st.sampled_from(["earthquake", "earthquake", "quarry blast", None]),
    "id": st.sampled_from(["a", "b", "c", "d", "e", None]),
})
SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(rows=st.lists(ROW, min_size=0, max_size=25))
def test_quality_matches_clean(spark, rows):
    df = catalog_rows(spark, rows)
    q = R.quality_report(df).first()
    cl = C.clean(df)
    n = cl.count()
    assert q["raw_records"] == len(rows)
    assert q["clean_records"] == n
    assert q["dropped_records"] == len(rows) - n
    # every surviving row passes the rule; keys are unique
    assert cl.filter(~F.coalesce(C.cleaning_predicate(), F.lit(False))).count() == 0
    assert cl.select("time", "latitude", "longitude").distinct().count() == n


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=25))
def test_one_pass_reports_and_sums(spark, rows):
    cl = C.clean(catalog_rows(spark, rows))
    n = cl.count()
    parts = R.split_report_pass(R.report_pass(cl), 200)
    for name, single in {"mag_distribution": R.mag_distribution(cl), "monthly": R.monthly(cl),
                         "hotspots": R.hotspots(cl, 200), "global_stats": R.global_stats(cl)}.items():
        assert sorted(map(tuple, parts[name].collect()), key=repr) == \
            sorted(map(tuple, single.collect()), key=repr), name
    assert sum(r["jumlah"] for r in parts["mag_distribution"].collect()) == n
    assert sum(r["jumlah"] for r in parts["monthly"].collect()) == n
    assert sum(r["event_count"] for r in parts["hotspots"].collect()) == n
