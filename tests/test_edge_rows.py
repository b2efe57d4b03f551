"""Hand-made edge rows (one case per trap of the cleaning rule and the classes)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import base_row, catalog_rows
from quakescope.functions.classes import depth_class, mag_class_left, mag_class_right, mag_class_six
from quakescope.functions.grid import snap_away, snap_even
from quakescope.operators import clean as C
from quakescope.operators import reports as R


def test_class_edges_left_and_right(spark):
    mags = [2.0, 3.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([(m,) for m in mags], "mag double")
    got = {r["mag"]: (r["l"], r["r"], r["s"]) for r in df.select(
        "mag", mag_class_left("mag").alias("l"), mag_class_right("mag").alias("r"),
        mag_class_six("mag").alias("s")).collect()}
    assert got[3.0] == ("Light", "Minor", "Minor (2-3)")
    assert got[5.0] == ("Moderate", "Light", "Light (3-5)")
    assert got[6.0] == ("Strong", "Moderate", "Moderate (5-6)")
    assert got[7.0] == ("Major/Great", "Strong", "Strong (6-7)")
    assert got[2.0] == ("Minor", "Minor", "Micro (<2)")


def test_depth_edges_right_closed(spark):
    df = spark.createDataFrame([(70.0,), (300.0,), (300.1,), (None,)], "depth double")
    got = [r[0] for r in df.select(depth_class("depth")).collect()]
    assert got == ["Dangkal (<70 km)", "Menengah (70-300 km)", "Dalam (>300 km)", None]


def test_grid_ties(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (-0.3,)], "x double")
    rows = df.select(snap_away("x").alias("a"), snap_even("x").alias("e")).collect()
    assert [r["a"] for r in rows] == [1.0, 2.0, 3.0, -3.0, 0.0]
    assert [r["e"] for r in rows] == [0.0, 2.0, 2.0, -2.0, 0.0]
    # no negative zero
    assert all(math.copysign(1.0, r["e"]) > 0 for r in rows if r["e"] == 0.0)
    tenth = spark.createDataFrame([(0.05,), (0.25,)], "x double").select(snap_even("x", 1)).collect()
    assert [r[0] for r in tenth] == [0.0, 0.2]


def test_nan_null_rms_and_type_dropped(spark):
    rows = [base_row(id="nan", mag=float("nan"), latitude=5.0),
            base_row(id="rms", rms=None, latitude=6.0),
            base_row(id="typ", type=None, latitude=7.0),
            base_row(id="big-rms", rms=2.5, latitude=8.0),
            base_row(id="ok", latitude=9.0)]
    out = C.clean(catalog_rows(spark, rows)).select("id").collect()
    assert [r["id"] for r in out] == ["ok"]


def test_null_time_dedup_keeps_lowest_id(spark):
    rows = [base_row(id="b", time=None, mag=3.1), base_row(id="a", time=None, mag=1.2),
            base_row(id="c", time="not-a-time", latitude=3.0)]
    out = {r["id"]: r for r in C.clean(catalog_rows(spark, rows)).collect()}
    assert set(out) == {"a", "c"}
    assert out["a"]["mag"] == 1.2 and out["a"]["year"] is None
    assert out["c"]["year"] is None
    months = R.monthly(C.clean(catalog_rows(spark, rows))).collect()
    assert months[0]["year"] is None and months[0]["jumlah"] == 2


def test_time_parts_are_utc(spark):
    rows = [base_row(time="2026-05-31T23:30:00.000Z")]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        r = C.clean(catalog_rows(spark, rows)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r["year"], r["month"], r["hour"]) == (2026, 5, 23)


def test_reordered_header_maps_by_name(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text("depth,time,mag,latitude,longitude,type,rms,id\n"
                 "12.5,2026-05-01T00:00:00.000Z,3.3,1.0,2.0,earthquake,0.1,x\n")
    from quakescope.sources.catalog import read_csv, read_csv_positional

    r = read_csv(spark, str(p)).first()
    assert (r["depth"], r["mag"], r["time"]) == (12.5, 3.3, "2026-05-01T00:00:00.000Z")
    with pytest.raises(Exception):
        read_csv_positional(spark, str(p)).collect()


def test_folder_with_two_header_orders_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,latitude,longitude,depth,mag,type,rms,id\n"
                                    "2026-05-01T00:00:00.000Z,1.0,2.0,10.0,4.0,earthquake,0.1,a1\n")
    (tmp_path / "b.csv").write_text("time,longitude,latitude,mag,depth,type,rms,id\n"
                                    "2026-05-01T00:00:00.000Z,2.0,1.0,4.0,10.0,earthquake,0.1,b1\n")
    from quakescope.sources.catalog import read_csv, read_csv_raw

    for read in (read_csv, read_csv_raw):
        with pytest.raises(Exception):
            read(spark, str(tmp_path)).collect()
        one = read(spark, str(tmp_path / "b.csv")).first()
        assert (float(one["latitude"]), float(one["depth"])) == (1.0, 10.0)


def test_folder_with_aliases_in_some_files_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,latitude,longitude,depth,mag\n2026-05-01T00:00:00Z,1,2,3,4\n")
    (tmp_path / "b.csv").write_text("Time,Latitude,Longitude,Magnitude,Depth\n2026-05-01T00:00:00Z,1,2,4,3\n")
    from quakescope.sources.catalog import read_csv

    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("values", [
    [float("inf"), 4.0], [float("nan"), 4.0], [1.0000004, 1.0000004], [12.12345678, -3.87654321, 0.5],
    [3.5e13, 1.25], [1.5, 2.25, None], [None, None], [],
])
def test_mean_and_sum_equal_brute_force(spark, values):
    import math

    from quakescope.functions.stats import exact_mean, exact_sum, round_half_up
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(v,) for v in values], "x double").agg(
        exact_mean("x").alias("m"), exact_sum("x").alias("s"), round_half_up(F.max("x"), 3).alias("r")).first()
    own = [v for v in values if v is not None]
    if not own:
        assert got["m"] is None and got["s"] is None and got["r"] is None
    elif any(math.isnan(v) for v in own):
        assert math.isnan(got["m"]) and math.isnan(got["s"])
    else:
        assert got["m"] == pytest.approx(sum(own) / len(own), rel=1e-12)
        assert got["s"] == pytest.approx(sum(own), rel=1e-12)
        assert got["r"] == pytest.approx(max(own), abs=1e-3)


def test_one_dedup_survivor_in_any_order_and_mode(spark):
    import itertools

    keyed = [base_row(id=i, depth=d, mag=m, place=p) for i, d, m, p in [
        (None, 9.0, 6.5, "x"), (None, 11.0, 5.0, "y"), (None, 10.0, 5.0, "b"), (None, 10.0, 5.0, "a"), ("a", 1.0, 1.0, "z")]]
    repeated = [base_row(id="r", latitude=5.0, depth=d, mag=m, place=p) for d, m, p in [(4.0, 3.0, "q"), (2.0, 3.0, "p"), (2.0, 3.0, "o")]]
    seen = set()
    for order in list(itertools.permutations(range(5)))[::17]:
        rows = catalog_rows(spark, [keyed[i] for i in order] + repeated[::-1 if order[0] % 2 else 1]).repartition(3)
        for prunable in (True, False):
            got = C.dedup(rows, prunable=prunable).orderBy("latitude").collect()
            seen.add(tuple((r["id"], r["depth"], r["mag"], r["place"]) for r in got))
    assert seen == {((None, 10.0, 5.0, "a"), ("r", 2.0, 3.0, "o"))}


def test_missing_required_column_raises(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Time,Latitude,Longitude,Depth\n2026-05-01T00:00:00Z,1,2,3\n")
    from quakescope.sources.catalog import read_csv

    with pytest.raises(ValueError, match="mag"):
        read_csv(spark, str(p))


def test_capitalised_aliases(spark, tmp_path):
    p = tmp_path / "cap.csv"
    p.write_text("Time,Latitude,Longitude,Depth,Magnitude\n2026-05-01T00:00:00Z,1.5,2.5,3.5,4.5\n")
    from quakescope.sources.catalog import read_csv

    r = read_csv(spark, str(p)).first()
    assert (r["latitude"], r["longitude"], r["depth"], r["mag"]) == (1.5, 2.5, 3.5, 4.5)


def test_empty_input(spark):
    empty = catalog_rows(spark, [])
    q = R.quality_report(empty).first()
    assert (q["raw_records"], q["clean_records"], q["dropped_records"]) == (0, 0, 0)
    assert q["veracity_pct"] is None
    assert R.global_stats(C.clean(empty)).first()["total_events"] == 0
    assert R.kpis(C.display_clean(empty)).first()["max_mag"] is None
    assert C.dashboard_view(C.display_clean(empty)).count() == 0
    assert R.mag_histogram(C.display_clean(empty)).count() == 0


def test_deep_event_clean_but_outside_default_range(spark):
    rows = [base_row(id="deep", depth=701.0, latitude=1.0), base_row(id="shallow", latitude=2.0)]
    df = catalog_rows(spark, rows)
    assert C.clean(df).count() == 2
    view = C.dashboard_view(C.display_clean(df))
    assert [r["id"] for r in view.select("id").collect()] == ["shallow"]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "mag double")
    bins = {r["bin"]: r["jumlah"] for r in R.mag_histogram(df, bins=4).collect()}
    assert bins == {1: 1, 3: 1, 4: 1}  # missing magnitudes are not binned
    same = spark.createDataFrame([(2.5,), (2.5,)], "mag double")
    assert [(r["bin"], r["jumlah"]) for r in R.mag_histogram(same).collect()] == [(1, 2)]


def test_quality_counts_match_clean(spark):
    rows = [base_row(id="a"), base_row(id="b"), base_row(id="c", latitude=5.0),
            base_row(id="d", mag=-1.0, latitude=6.0)]
    df = catalog_rows(spark, rows)
    q = R.quality_report(df).first()
    assert (q["raw_records"], q["clean_records"], q["dropped_records"]) == (4, 2, 2)
    assert q["veracity_pct"] == 50.0 and q["valid_pct"] == 50.0
    assert C.clean(df).count() == 2


def test_ingestion_report_counts_unparseable(spark):
    df = spark.createDataFrame(
        [("t", "1.0", "2.0", "3", "4", None, None, None), ("t", "abc", "2.0", None, None, None, None, None)],
        "time string, latitude string, longitude string, depth string, mag string, nst string, "
        "gap string, rms string")
    r = R.ingestion_report(df).first()
    assert (r["total_records"], r["success_count"], r["fail_count"]) == (2, 1, 1)
    assert r["data_loss_pct"] == 50.0
    from quakescope.operators.payload import event_payload

    assert event_payload(df).count() == 1


def test_payload_defaults_and_fill(spark):
    from quakescope.operators.payload import decode_payload, event_payload

    df = catalog_rows(spark, [base_row(depth=None, magType=None, latitude=None)]).drop("place")
    p = decode_payload(event_payload(df)).first()
    assert p["depth"] == 0.0 and p["magType"] == "nan" and p["place"] == "unknown"
    assert p["latitude"] is None
    raw = event_payload(df).first()["value"]
    assert '"latitude":"NaN"' in raw  # Spark's JSON writer quotes NaN
    kept = decode_payload(event_payload(df, fill=None)).first()
    assert kept["depth"] is None


def test_cluster_labels_fallback(spark):
    from quakescope.functions.labels import cluster_color, cluster_label

    df = spark.createDataFrame([(0,), (5,), (7,)], "cluster int")
    got = [(r[0], r[1]) for r in df.select(cluster_label("cluster"), cluster_color("cluster")).collect()]
    assert got[0] == ("Zona Merah (Sangat Aktif)", "#e74c3c")
    assert got[1] == ("Zona Ungu (Rendah)", "#9b59b6")
    assert got[2] == ("Cluster 7", "#aaa")


def test_period_and_coord_labels(spark):
    from quakescope.functions.labels import coord_label, period_label

    df = spark.createDataFrame([(2026, 5, 1.2, -3.4), (None, None, 0.0, 0.0)],
                               "year int, month int, a double, b double")
    got = df.select(period_label("year", "month"), coord_label("a", "b")).collect()
    assert got[0][0] == "2026-05" and got[0][1] == "1.2°, -3.4°"
    assert got[1][0] == ""


def test_inline_rows(spark):
    from quakescope.sources.catalog import inline_rows

    df = inline_rows(spark, [("Sumatera", 5.2), ("Jawa", 6.1), ("Sulawesi", 4.9)],
                     ["Wilayah", "Magnitudo"])
    assert df.dtypes == [("Wilayah", "string"), ("Magnitudo", "double")]
    assert df.agg(F.max("Magnitudo")).first()[0] == 6.1


def test_conform_fills_or_rejects_missing_optional_columns(spark, tmp_path):
    from quakescope.sources.catalog import conform

    df = spark.createDataFrame([("2026-05-01T00:00:00Z", "1.5", "2.5", "3.5", "x")],
                               "time string, latitude string, longitude string, depth string, mag string")
    r = conform(df).first()
    assert r["mag"] is None and r["depth"] == 3.5 and r["rms"] is None and r["place"] is None
    with pytest.raises(ValueError, match="magType"):
        conform(df, strict=True)
