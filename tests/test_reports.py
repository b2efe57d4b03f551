"""The batch job's one-pass report (GROUPING SETS) equals the separate reports."""

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.operators import reports as R
from quakescope.sources.fixture import quakes


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_report_pass_equals_single_reports(spark):
    cl = C.clean(quakes(spark, SF_SMALL))
    parts = R.split_report_pass(R.report_pass(cl), 200)
    singles = {"mag_distribution": R.mag_distribution(cl), "monthly": R.monthly(cl),
               "hotspots": R.hotspots(cl, 200), "global_stats": R.global_stats(cl)}
    for name, df in singles.items():
        assert parts[name].columns == df.columns, name
        assert _rows(parts[name]) == _rows(df), name


def test_report_pass_keeps_unknown_month_group(spark):
    cl = C.clean(quakes(spark, SF_SMALL))
    monthly = R.split_report_pass(R.report_pass(cl))["monthly"].collect()
    assert monthly[0]["year"] is None
    assert sum(r["jumlah"] for r in monthly) == cl.count()


def test_prunable_and_struct_dedup_agree(spark):
    q = quakes(spark, SF_SMALL)
    assert _rows(C.clean(q, prunable=True)) == _rows(C.clean(q, prunable=False))


def test_report_pass_on_empty_input(spark):
    from conftest import catalog_rows

    empty = C.clean(catalog_rows(spark, []))
    parts = R.split_report_pass(R.report_pass(empty))
    assert _rows(parts["global_stats"]) == _rows(R.global_stats(empty))
    assert parts["global_stats"].first()["total_events"] == 0
    assert parts["monthly"].count() == 0 and parts["hotspots"].count() == 0


def test_batch_job_on_input_with_no_clean_rows(spark):
    from conftest import base_row, catalog_rows
    from quakescope.plans.batch import run_batch
    from quakescope.session import scratch_path

    raw = catalog_rows(spark, [base_row(type="quarry blast"), base_row(mag=None, latitude=3.0)])
    rep = run_batch(spark, raw, scratch_path(spark, "empty-batch"), k=2)
    m = rep["pipeline_metrics"]
    assert (m["raw_records"], m["clean_records"], m["dropped_records"]) == (2, 0, 2)
    assert rep["global_stats"]["total_events"] == 0
    assert rep["cluster_summary"] == [] and rep["hotspot_grid"] == []


def test_collect_report_pass_matches_parts(spark):
    cl = C.clean(quakes(spark, SF_SMALL))
    comb = R.report_pass(cl)
    got = R.collect_report_pass(comb, 200)
    parts = R.split_report_pass(comb, 200)
    for name, df in parts.items():
        assert got[name] == [r.asDict() for r in df.collect()], name


def test_hot_dedup_key_on_a_third_of_rows(spark):
    from pyspark.sql import functions as F

    q = quakes(spark, SF_SMALL)
    hot = (q.withColumn("_r", F.monotonically_increasing_id())
           .withColumn("time", F.when(F.col("_r") % 3 == 0, F.lit("2026-05-01T00:00:00.000Z"))
                       .otherwise(F.col("time")))
           .withColumn("latitude", F.when(F.col("_r") % 3 == 0, F.lit(1.0)).otherwise(F.col("latitude")))
           .withColumn("longitude", F.when(F.col("_r") % 3 == 0, F.lit(2.0)).otherwise(F.col("longitude")))
           .drop("_r"))
    kept = hot.filter(C.cleaning_predicate())
    hot_ids = [r["id"] for r in kept.filter((F.col("latitude") == 1.0) & (F.col("longitude") == 2.0)
                                            & (F.col("time") == "2026-05-01T00:00:00.000Z")).collect()]
    assert len(hot_ids) > 50
    cl = C.clean(hot)
    survivor = cl.filter((F.col("latitude") == 1.0) & (F.col("longitude") == 2.0)).collect()
    assert [r["id"] for r in survivor] == [min(hot_ids)]
    assert cl.count() == kept.select("time", "latitude", "longitude").distinct().count()
    q_rep = R.quality_report(hot).first()
    assert q_rep["clean_records"] == cl.count()
    plan = cl._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # folded by the aggregate, never sorted whole in one task
