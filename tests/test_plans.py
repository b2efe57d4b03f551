"""Zone fits, dashboard feeds and the ingestion job end to end (small fixture)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.operators import clustering as Z
from quakescope.plans.dashboard import run_dashboard
from quakescope.plans.ingest import run_ingest
from quakescope.session import scratch_path
from quakescope.sources import sinks
from quakescope.sources.fixture import quakes


@pytest.fixture(scope="module")
def cleaned(spark):
    return C.clean(quakes(spark, SF_SMALL))


def _sizes(fit):
    return sorted(r["n"] for r in fit.assigned().groupBy("cluster").agg(F.count("*").alias("n")).collect())


def test_zone_fit_is_repeatable(spark, cleaned):
    a, b = Z.fit_zones(cleaned), Z.fit_zones(cleaned)
    assert _sizes(a) == _sizes(b)
    assert sum(_sizes(a)) == C.feature_rows(cleaned).count()
    ids = {r[0] for r in a.assigned().select("cluster").distinct().collect()}
    assert ids <= set(range(6))
    a.unpersist(), b.unpersist()


def test_restarts_keep_lowest_cost(spark, cleaned):
    one = Z.fit_zones(cleaned, restarts=1, max_iter=5)
    many = Z.fit_zones(cleaned, restarts=3, max_iter=5)
    assert many.cost <= one.cost + 1e-9
    one.unpersist(), many.unpersist()


def test_population_std_variant_runs(spark, cleaned):
    fit = Z.fit_zones(cleaned, ddof=0, max_iter=5)
    assert sum(_sizes(fit)) == C.feature_rows(cleaned).count()
    fit.unpersist()


def test_fixed_centres_assign_every_row(spark, cleaned):
    assigned = Z.assign_to_centres(cleaned)
    assert assigned.count() == C.feature_rows(cleaned).count()
    assert assigned.filter(F.col("cluster").isNull()).count() == 0


def test_dashboard_feeds(spark):
    out = scratch_path(spark, "dash")
    paths = run_dashboard(spark, quakes(spark, SF_SMALL), out, report_path=out + "/no-report")
    # no report yet: the metric tables are empty, the tiles still show the view
    assert spark.read.parquet(paths["metrics_volume"]).count() == 0
    assert spark.read.parquet(paths["kpi_tiles"]).count() == 1
    assert {"kpis", "daily", "monthly", "yearly", "mag_histogram", "mag_share", "hotspots",
            "density_grid", "heatmap_sample", "zones", "cluster_map_sample"} <= set(paths)
    kpis = spark.read.parquet(paths["kpis"]).first()
    assert kpis["total_record"] == spark.read.parquet(os.path.join(out, "view.parquet")).count()
    assert spark.read.parquet(paths["zones"]).count() == 6
    assert spark.read.parquet(paths["hotspots"]).count() <= 20


def test_ingest_job(spark):
    src = scratch_path(spark, "ingest-src")
    sinks.write_csv(quakes(spark, SF_SMALL), src)
    out = scratch_path(spark, "ingest-out")
    metrics = scratch_path(spark, "ingest-metrics")
    rep = run_ingest(spark, src, out_path=out, metrics_path=metrics)
    assert spark.read.json(metrics).first()["total_records"] == 1028
    assert rep["total_records"] == 1028 and rep["fail_count"] == 0
    assert spark.read.text(out).count() == rep["success_count"]
    assert rep["payload_mb"] > 0


def test_metric_tables_and_kpi_tiles(spark):
    from quakescope.plans.batch import run_batch
    from quakescope.plans.dashboard import kpi_tiles, metric_tables, view
    from quakescope.sources.report import read_report

    out = scratch_path(spark, "bundle-for-page")
    rep = run_batch(spark, quakes(spark, SF_SMALL), out)
    bundle = read_report(spark, os.path.join(out, "analytics_results.json"))
    tables = metric_tables(bundle)
    vol = [(r["Metrik"], r["Nilai"]) for r in tables["volume"].collect()]
    assert vol[0] == ("Total Data Mentah (Raw)", "1,028 records")
    assert vol[3][1] == f"{100 - rep['pipeline_metrics']['veracity_pct']:.2f}%"
    perf = [r["Nilai"] for r in tables["performance"].collect()]
    assert perf[-1] == str(rep["pipeline_metrics"]["spark_cores"]) and perf[0].endswith(" detik")
    tiles = kpi_tiles(view(quakes(spark, SF_SMALL)), bundle).first()
    assert tiles["raw_records"] == 1028
    assert tiles["total_record"] == view(quakes(spark, SF_SMALL)).count()
    assert tiles["max_mag_text"] == f"{tiles['max_mag']:.1f}"
    empty = kpi_tiles(view(quakes(spark, SF_SMALL)).limit(0), read_report(spark, out + "/absent")).first()
    assert empty["max_mag_text"] == "–" and empty["valid_pct"] == 100.0
