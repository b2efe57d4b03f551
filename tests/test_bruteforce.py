"""Random catalogues against plain-Python brute force of the same rules."""

import hashlib
import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import catalog_rows
from quakescope.functions.classes import MAG5_EDGES, MAG5_LABELS, mag_class_right
from quakescope.operators import clean as C
from quakescope.operators import reports as R
from quakescope.operators.sampling import bottom_k

NUM = st.one_of(st.none(), st.just(float("nan")),
                st.sampled_from([-0.5, 0.0, 0.49, 0.5, 1.5, 2.5, 3.0, 5.0, 6.99, 7.0, 300.0]))
ROW = st.fixed_dictionaries({
    "time": st.sampled_from([None, "bad", "2025-03-01T00:00:00.000Z", "2026-05-01T10:00:00.000Z"]),
    "latitude": st.one_of(st.none(), st.sampled_from([-2.5, -0.5, 0.5, 1.5, 2.5, 10.0])),
    "longitude": st.one_of(st.none(), st.sampled_from([-0.5, 0.5, 100.5, 179.5])),
    "depth": NUM, "mag": NUM,
    "rms": st.one_of(st.none(), st.just(float("nan")), st.sampled_from([0.0, 1.99, 2.0, 2.01])),
    "type": st.sampled_from(["earthquake", "earthquake", "explosion", None]),
    "id": st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])),
})
SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def ok(x):
    return x is not None and not math.isnan(x)


def brute_clean(rows):
    kept = [r for r in rows
            if r["type"] == "earthquake" and all(ok(r[c]) for c in ("mag", "latitude", "longitude", "depth"))
            and r["mag"] >= 0 and r["depth"] >= 0 and ok(r["rms"]) and r["rms"] <= 2.0]
    best = {}
    for r in kept:
        key = (r["time"], r["latitude"], r["longitude"])
        rank = (r["id"] is not None, r["id"] or "")
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    return [r for _, r in best.values()]


def right_class(m):
    for edge, label in zip(MAG5_EDGES, MAG5_LABELS):
        if m <= edge:
            return label
    return MAG5_LABELS[-1]


@SETTINGS
@given(rows=st.lists(ROW, max_size=30))
def test_clean_matches_brute_force(spark, rows):
    got = C.clean_rows(catalog_rows(spark, rows)).select("time", "latitude", "longitude", "mag", "id").collect()
    want = brute_clean(rows)
    assert Counter(tuple(r) for r in got) == Counter(
        (r["time"], r["latitude"], r["longitude"], r["mag"], r["id"]) for r in want)


@SETTINGS
@given(rows=st.lists(ROW, max_size=30))
def test_right_closed_classes_and_even_cells(spark, rows):
    want = brute_clean(rows)
    cl = C.clean_rows(catalog_rows(spark, rows))
    classes = Counter(r[0] for r in cl.select(mag_class_right("mag")).collect())
    assert classes == Counter(right_class(r["mag"]) for r in want)
    cells = {(r["lat_grid"], r["lon_grid"]): r["event_count"]
             for r in R.hotspots(cl, 10_000, ties="even").collect()}
    assert cells == dict(Counter((float(round(r["latitude"])), float(round(r["longitude"]))) for r in want))


@SETTINGS
@given(ids=st.lists(st.one_of(st.none(), st.sampled_from([f"e{i}" for i in range(40)])), max_size=60),
       n=st.integers(min_value=1, max_value=70), seed=st.integers(min_value=0, max_value=5))
def test_bottom_k_matches_brute_force(spark, ids, n, seed):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = sorted(hashlib.md5(f"{r['id'] or ''}#{seed}".encode()).hexdigest()
                 for r in bottom_k(df, n, seed).collect())
    want = sorted(hashlib.md5(f"{i or ''}#{seed}".encode()).hexdigest() for i in ids)[:n]
    assert got == want


def brute_view(rows):
    shown = [r for r in rows if all(ok(r[c]) for c in ("latitude", "longitude", "mag", "depth"))
             and r["mag"] >= 0]
    year = {"2025-03-01T00:00:00.000Z": 2025, "2026-05-01T10:00:00.000Z": 2026}
    if not shown:
        return []
    depth_hi = min(max(r["depth"] for r in shown), 700.0)
    years = [year[r["time"]] for r in shown if r["time"] in year]
    out = [r for r in shown if r["depth"] <= depth_hi]
    if years:
        out = [r for r in out if r["time"] in year]
    return out


@SETTINGS
@given(rows=st.lists(ROW, max_size=30))
def test_dashboard_view_matches_brute_force(spark, rows):
    rows = [dict(r, depth=(701.0 if r["depth"] == 300.0 else r["depth"])) for r in rows]
    got = C.dashboard_view(C.display_clean(catalog_rows(spark, rows))).select("time", "mag", "depth", "id")
    want = brute_view(rows)
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (r["time"], r["mag"], r["depth"], r["id"]) for r in want)
