"""Choice of k, trend, regions, correlation and smoothing against plain loops on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import base_row, catalog_rows
from quakescope.operators import choice_of_k as K
from quakescope.operators import clean as C
from quakescope.operators import clustering as Z
from quakescope.operators import restarts
from quakescope.operators import supervised as S
from quakescope.operators.correlation import correlation, twice_ranks
from quakescope.operators.regions import boxes_around, region_stats
from quakescope.operators.smoothing import kernel, smoothed_density
from quakescope.operators.trend import monthly_counts, trend


def events(spark, n=200, seed=0):
    rng = random.Random(seed)
    rows = [base_row(id=f"e{i}", latitude=round(rng.uniform(-90, 90), 2), longitude=round(rng.uniform(-180, 180), 2), depth=round(rng.uniform(0, 600), 1),
                     mag=round(rng.uniform(0, 8), 1)) for i in range(n)]
    rows += [base_row(id=f"h{i}", latitude=3.0, longitude=100.0, mag=4.0) for i in range(n // 2)]  # one place, a third of the rows
    rows += [base_row(id="x1", latitude=None), base_row(id="x2", mag=float("nan")), base_row(id="x3", depth=None), base_row(id="x4", longitude=180.0, latitude=90.0),
             base_row(id="x5", longitude=-180.0, latitude=-90.0), base_row(id="x6", latitude=0.0, longitude=-0.0)]
    return catalog_rows(spark, rows), [r for r in rows if all(r[c] is not None and not math.isnan(r[c]) for c in ("latitude", "longitude", "depth", "mag"))]


# --- choice of k -------------------------------------------------------------


def brute_silhouette(rows, centres, features):
    x = np.array([[r[f] for f in features] for r in rows], float)
    unit = x.std(axis=0, ddof=1)
    z, c = x / unit, np.array(centres, float) / unit
    away = ((z[:, None] - c[None]) ** 2).sum(axis=2)
    zone = away.argmin(axis=1)
    pair = ((z[:, None] - z[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(z)):
        mine = zone == zone[i]
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = pair[i, mine].sum() / (mine.sum() - 1)
        b = min(pair[i, zone == k].mean() for k in set(zone) - {zone[i]})
        scores.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return len(set(zone)), away.min(axis=1).sum(), float(np.mean(scores))


def test_silhouette_equals_all_pairs(spark):
    df, rows = events(spark)
    sets = [[(0, 0, 0, 0), (50, 100, 300, 5)], [(0, 0, 0, 0), (50, 100, 300, 5), (-50, -100, 100, 2)], [(3, 100, 10, 4), (80, 80, 500, 7), (9e9, 0, 0, 0)],
            [(r["latitude"], r["longitude"], r["depth"], r["mag"]) for r in rows[:9]]]
    features = ("latitude", "longitude", "depth", "mag")
    got = K.silhouettes(df, sets).collect()
    for r, centres in zip(got, sets):
        zones, cost, score = brute_silhouette(rows, centres, features)
        assert (r["k"], r["zones"], r["events"]) == (len(centres), zones, len(rows))
        assert math.isclose(r["cost"], cost, rel_tol=1e-9) and math.isclose(r["silhouette"], score, abs_tol=1e-9)
    best = max(got, key=lambda r: (r["silhouette"], -r["k"]))["k"]
    assert K.best_k(K.silhouettes(df, sets)) == best


def test_silhouette_of_odd_inputs(spark):
    same = catalog_rows(spark, [base_row(id=str(i)) for i in range(5)])
    far = [(0, 0, 0, 0), (50, 100, 300, 5)]
    (one,) = K.silhouettes(same, [far]).collect()
    assert one["zones"] == 1 and one["silhouette"] is None
    (none,) = K.silhouettes(same.limit(0), [far]).collect()
    assert (none["zones"], none["events"], none["silhouette"]) == (0, 0, None)
    assert K.best_k(K.silhouettes(same, [far])) is None
    two = catalog_rows(spark, [base_row(id="a"), base_row(id="b", latitude=50.0, depth=300.0)])
    assert K.silhouettes(two, [[(1, 2, 10, 2.5), (50, 2, 300, 2.5)]]).first()["silhouette"] == 0.0  # single rows count 0


def test_fitted_sets_find_separate_groups(spark):
    rng = np.random.default_rng(0)
    groups = [(-40, -100, 50, 2), (0, 0, 300, 4), (40, 100, 550, 6)]
    rows = [base_row(id=f"{g}{i}", latitude=float(a + rng.normal()), longitude=float(b + rng.normal()), depth=float(c + rng.normal()), mag=float(m + 0.1 * rng.normal()))
            for g, (a, b, c, m) in enumerate(groups) for i in range(60)]
    df = catalog_rows(spark, rows)
    scored = K.silhouettes(df, K.fitted_sets(df, range(2, 6)))
    assert K.best_k(scored) == 3 and scored.filter("k = 3").first()["silhouette"] > 0.95
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_fits_share_their_rows(spark, monkeypatch):
    df, _ = events(spark, 60)
    held, fit = [], K.fit_zones
    monkeypatch.setattr(K, "fit_zones", lambda df, **options: held.append(C.feature_rows(df).storageLevel.useMemory) or fit(df, **options))
    assert [len(c) for c in K.fitted_sets(df, (2, 3, 4))] == [2, 3, 4]
    assert held == [False, True, True] and not spark.sparkContext._jsc.getPersistentRDDs()


# --- restarts ----------------------------------------------------------------


def test_one_pass_moves_all_starts(spark, monkeypatch):
    monkeypatch.setattr(restarts, "BLOCK", 16)
    df, rows = events(spark)
    features = ["latitude", "longitude", "depth", "mag"]
    x = np.array([[r[f] for f in features] for r in rows], float)
    shift, unit = x.mean(axis=0), x.std(axis=0, ddof=1)
    z = (x - shift) / unit
    starts = restarts.spread_starts(z, 3, range(4))
    n, sums, cost = restarts.fold_rows(C.feature_rows(df), starts, shift, unit)
    moved, costs = restarts.refine(C.feature_rows(df), starts, shift, unit, 7)
    for s in range(4):
        away = ((z[:, None] - starts[s][None]) ** 2).sum(axis=2)
        zone = away.argmin(axis=1)
        assert n[s].tolist() == np.bincount(zone, minlength=3).tolist()
        assert np.allclose(sums[s], [z[zone == k].sum(axis=0) for k in range(3)]) and math.isclose(cost[s], away.min(axis=1).sum())
        centres = starts[s].copy()
        for _ in range(7):
            zone = ((z[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.array([z[zone == k].mean(axis=0) if (zone == k).any() else centres[k] for k in range(3)])
        assert np.allclose(moved[s], centres, atol=1e-3) and math.isclose(costs[s], ((z[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum(), rel_tol=1e-3)


def test_few_rows_are_not_folded_in_many_tasks(spark, monkeypatch):
    df, rows = events(spark)
    seen = []
    monkeypatch.setattr(Z, "refine", lambda rows, *args: seen.append(rows.rdd.getNumPartitions()) or restarts.refine(rows, *args))
    monkeypatch.setattr(restarts, "TASK_ROWS", math.ceil(len(rows) / 3))
    fit = Z.fit_zones(df.repartition(40), k=3, restarts=2, max_iter=2)
    assert seen == [3] and fit.assigned().count() == len(rows)
    fit.unpersist()


def test_equal_rows_and_more_zones_than_rows(spark):
    same = catalog_rows(spark, [base_row(id=str(i)) for i in range(5)])
    fit = Z.fit_zones(same, k=3, restarts=3, max_iter=4)
    assert fit.cost == 0.0 and fit.assigned().select("cluster").distinct().count() == 1
    fit.unpersist()


def test_rows_are_released_when_the_fit_raises(spark, monkeypatch):
    df, _ = events(spark)

    def fails(*args):
        raise RuntimeError("no fit")

    for target, options in (("_mllib_start", {}), ("refine", {"restarts": 2})):
        monkeypatch.setattr(Z, target, fails)
        with pytest.raises(RuntimeError):
            Z.fit_zones(df, **options)
        monkeypatch.undo()
        assert not spark.sparkContext._jsc.getPersistentRDDs()
    with pytest.raises(ValueError):
        Z.fit_zones(df.limit(0))
    assert not spark.sparkContext._jsc.getPersistentRDDs()


# --- trend -------------------------------------------------------------------


def test_trend_fills_months_without_events(spark):
    times = ["2023-11-02", "2023-11-05", "2024-02-01", "2024-02-02", "2024-02-03", "2024-04-30", None, "not-a-time"]
    df = C.with_batch_columns(catalog_rows(spark, [base_row(id=str(i), time=t and f"{t}T00:00:00.000Z" if t != "not-a-time" else t) for i, t in enumerate(times)]))
    counts = [2, 0, 0, 3, 0, 1]
    assert [r["events"] for r in monthly_counts(df).orderBy("month_index").collect()] == counts
    slope, intercept = np.polyfit(range(6), counts, 1)
    rows = sorted(trend(df, 2).collect())
    assert [(r["year"], r["month"], r["events"]) for r in rows] == [(2023, 11, 2), (2023, 12, 0), (2024, 1, 0), (2024, 2, 3), (2024, 3, 0), (2024, 4, 1), (2024, 5, None), (2024, 6, None)]
    assert all(math.isclose(r["fitted"], intercept + slope * i, abs_tol=1e-9) for i, r in enumerate(rows))


def test_trend_of_one_month_and_none(spark):
    df = C.with_batch_columns(catalog_rows(spark, [base_row(id="a"), base_row(id="b")]))
    assert [tuple(r) for r in trend(df).collect()] == [(2026, 5, 2, 0.0, 2.0, 2.0)]
    assert trend(df.filter("year IS NULL"), 3).collect() == []


# --- regions -----------------------------------------------------------------


def test_regions_equal_plain_loops(spark):
    df, rows = events(spark, 400)
    rng = random.Random(1)
    boxes = []
    for i in range(60):
        a, b = sorted(round(rng.uniform(-90, 90), 1) for _ in range(2))
        boxes.append((f"b{i}", a, b, round(rng.uniform(-180, 180), 1), round(rng.uniform(-180, 180), 1)))  # half of them cross the date line
    boxes += [("world", -90.0, 90.0, -180.0, 180.0), ("point", 3.0, 3.0, 100.0, 100.0), ("wide", -200.0, 200.0, -400.0, 400.0), ("empty", 89.5, 89.9, 0.0, 1.0),
              ("upside", 10.0, -10.0, 0.0, 50.0), ("gone", None, 5.0, 0.0, 1.0), ("nan", 0.0, float("nan"), 0.0, 1.0), (None, -90.0, 90.0, -180.0, 180.0)]
    table = spark.createDataFrame([(*b, "?", 0.0) for b in boxes], "box_id string, lat_min double, lat_max double, lon_min double, lon_max double, id string, mag double")
    got = {r["box_id"]: r for r in region_stats(df, table, cell=7.0).collect()}
    assert len(got) == len(boxes)
    for key, a, b, c, d in boxes:
        r = got[key]
        if a is None or math.isnan(b) or a > b or key is None:
            assert r["total_events"] == 0 and r["avg_magnitude"] is None
            continue
        inside = [e for e in rows if a <= e["latitude"] <= b and (c <= e["longitude"] <= d if c <= d else e["longitude"] >= c or e["longitude"] <= d)]
        mags = [e["mag"] for e in inside]
        assert r["total_events"] == len(inside)
        if not inside:
            assert r["avg_magnitude"] is None and r["std_magnitude"] is None
            continue
        assert (r["max_magnitude"], r["min_magnitude"]) == (max(mags), min(mags))
        assert math.isclose(r["avg_magnitude"], np.mean(mags), abs_tol=6e-4) and math.isclose(r["avg_depth_km"], np.mean([e["depth"] for e in inside]), abs_tol=6e-3)
        assert r["std_magnitude"] is None if len(mags) < 2 else math.isclose(r["std_magnitude"], np.std(mags, ddof=1), abs_tol=6e-4)


def test_boxes_are_not_broadcast(spark):
    """The cells' files are small (one box a run): their size says nothing of the rows."""
    df, _ = events(spark, 50)
    plan = spark._jvm.PythonSQLUtils.explainString(region_stats(df, boxes_around(df, "id", 5.0), "id")._jdf.queryExecution(), "simple")
    assert "BroadcastExchange" not in plan.split("Initial Plan")[-1]


def test_region_sums_of_large_and_fine_values(spark):
    for mags in ([300.0, 1.5], [1.0000001, 2.0], [-268.4, 268.4, 5.25], [1e10, 1e10]):
        df = catalog_rows(spark, [base_row(id=str(i), mag=m, depth=m * 40) for i, m in enumerate(mags)])
        box = spark.createDataFrame([("b", 0.5, 1.5, 1.5, 2.5)], "box_id string, lat_min double, lat_max double, lon_min double, lon_max double")
        r = region_stats(df, box).first()
        assert math.isclose(r["avg_magnitude"], np.mean(mags), abs_tol=6e-4) and math.isclose(r["avg_depth_km"], np.mean(mags) * 40, abs_tol=6e-3)
        assert math.isclose(r["std_magnitude"], np.std(mags, ddof=1), abs_tol=6e-4)


def test_region_join_is_on_cells(spark):
    df, _ = events(spark, 20)
    around = boxes_around(df.filter("id LIKE 'x%'"), "id", 5.0)
    rows = {r["id"]: r for r in around.collect()}
    assert (rows["x4"]["lon_min"], rows["x4"]["lon_max"], rows["x4"]["lat_max"]) == (175.0, -175.0, 90.0)
    plan = spark._jvm.PythonSQLUtils.explainString(region_stats(df, around, "id")._jdf.queryExecution(), "formatted")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "cell_y" in plan


# --- correlation -------------------------------------------------------------


def mean_ranks(values):
    order = sorted(values)
    return [(order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in values]


def test_ranks_and_coefficients(spark):
    df, rows = events(spark)
    got = {(r["feature"], r["value"]): r["rank2"] for r in twice_ranks(C.feature_rows(df), ["mag", "depth", "longitude"]).collect()}
    for c in ("mag", "depth", "longitude"):
        values = [r[c] + 0.0 for r in rows]
        for v, rank in zip(values, mean_ranks(values)):
            assert got[c, v] == 2 * rank
    pairs = [("depth", "mag"), ("latitude", "longitude"), ("mag", "mag")]
    for r, (x, y) in zip(correlation(df, pairs).collect(), pairs):
        a, b = ([e[c] for e in rows] for c in (x, y))
        assert r["events"] == len(rows) and math.isclose(r["pearson"], np.corrcoef(a, b)[0, 1], abs_tol=1e-9)
        assert math.isclose(r["spearman"], np.corrcoef(mean_ranks(a), mean_ranks(b))[0, 1], abs_tol=1e-9)


def test_correlation_without_spread(spark):
    same = catalog_rows(spark, [base_row(id=str(i), depth=float(i)) for i in range(5)])
    (r,) = correlation(same, [("depth", "mag")]).collect()
    assert (r["events"], r["pearson"], r["spearman"]) == (5, None, None)
    (r,) = correlation(same.limit(0), [("depth", "mag")]).collect()
    assert (r["events"], r["pearson"], r["spearman"]) == (0, None, None)


# --- smoothing ---------------------------------------------------------------


def test_smoothing_spreads_and_keeps_everything(spark):
    df, rows = events(spark, 60)
    view = df.filter(C.all_present(["latitude", "longitude", "mag", "depth"]))
    got = {(r["lat_grid"], r["lon_grid"]): r for r in smoothed_density(view, radius=1).collect()}
    assert sum(w for *_, w in kernel(1)) == 16 and max(kernel(1), key=lambda k: k[2]) == (0, 0, 4)
    want = {}
    for r in rows:
        y, x = (int(np.rint(r[c] * 10)) for c in ("latitude", "longitude"))
        for dy, dx, w in kernel(1):
            cell = (max(-900, min(900, y + dy)) / 10, ((x + dx + 1800) % 3600 - 1800) / 10)
            old = want.get(cell, (0.0, 0.0))
            want[cell] = (old[0] + w / 16, old[1] + r["mag"] * w / 16)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[c]["events"], n, abs_tol=1e-9) and math.isclose(got[c]["mag_weight"], m, abs_tol=1e-9) for c, (n, m) in want.items())
    assert math.isclose(sum(r["events"] for r in got.values()), len(rows))


# --- supervised --------------------------------------------------------------


@pytest.mark.parametrize("method, labels", [("forest", 3), ("boosted", 2)])
def test_trees_learn_a_label(spark, method, labels):
    df, rows = events(spark, 600)
    labelled = df.withColumn("zone", F.when(F.col("id") == "e3", None).otherwise(F.least(F.floor(F.col("depth") / (600 / labels)), F.lit(labels - 1))).cast("int"))
    r = S.evaluated(labelled, "zone", method, trees=5).first()
    assert r["train_rows"] + r["test_rows"] == len(rows) - 1 and r["confusion_rows"] == r["test_rows"] > 100
    assert r["labels"] == labels and r["accuracy"] > max(0.9, r["majority"])
    model = S.learn_label(labelled, "zone", method, trees=3)
    assert model.predict(df).columns == [*df.columns, "predicted"] and model.predict(df).count() == len(rows)


def test_trees_without_rows(spark):
    df, _ = events(spark, 10)
    with pytest.raises(ValueError):
        S.learn_label(df.withColumn("zone", F.lit(None).cast("int")), "zone")
    with pytest.raises(ValueError):
        S.learn_label(df.withColumn("zone", F.lit(1)), "zone", "stumps")
