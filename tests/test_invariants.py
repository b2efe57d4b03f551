"""Invariants of the published report, checked on a run of the batch job."""

import json
import os

import pytest

from conftest import SF_SMALL
from quakescope.plans.batch import run_batch
from quakescope.session import scratch_path
from quakescope.sources.fixture import quakes
from quakescope.sources.report import read_report


@pytest.fixture(scope="module")
def report(spark):
    out = scratch_path(spark, "batch-test")
    rep = run_batch(spark, quakes(spark, SF_SMALL), out)
    return rep, out


def test_counts_add_up(report):
    rep, _ = report
    m = rep["pipeline_metrics"]
    assert m["raw_records"] - m["clean_records"] == m["dropped_records"]
    assert m["veracity_pct"] == round(m["dropped_records"] / m["raw_records"] * 100, 2)
    assert (m["raw_records"], m["clean_records"]) == (1028, 578)


def test_sums_and_maxima_agree(report):
    rep, _ = report
    n = rep["global_stats"]["total_events"]
    assert sum(r["jumlah"] for r in rep["mag_distribution"]) == n
    assert sum(r["jumlah"] for r in rep["temporal_activity"]) == n
    assert sum(r["jumlah_event"] for r in rep["cluster_summary"]) == n
    if len(rep["hotspot_grid"]) < 200:
        assert sum(r["event_count"] for r in rep["hotspot_grid"]) == n
    top = rep["global_stats"]["max_magnitude"]
    assert max(r["max_mag"] for r in rep["temporal_activity"]) == top
    assert max(r["max_mag"] for r in rep["cluster_summary"]) == top


def test_order_and_ids(report):
    rep, _ = report
    counts = [r["event_count"] for r in rep["hotspot_grid"]]
    assert counts == sorted(counts, reverse=True)
    assert [r["cluster"] for r in rep["cluster_summary"]] == list(range(6))
    periods = [(r["year"], r["month"]) for r in rep["temporal_activity"]]
    assert periods == sorted(periods)
    assert all(r["year"] is not None for r in rep["temporal_activity"])  # unknown year reads 0


def test_report_file_round_trip(spark, report):
    rep, out = report
    back = read_report(spark, os.path.join(out, "analytics_results.json")).first()
    assert back["pipeline_metrics"]["clean_records"] == rep["pipeline_metrics"]["clean_records"]
    assert len(back["hotspot_grid"]) == len(rep["hotspot_grid"])
    json.dumps(rep, default=str)


def test_missing_report_is_empty(spark, tmp_path):
    assert read_report(spark, str(tmp_path / "absent.json")).count() == 0


def test_spark_bundle_equals_batch_report(spark, report):
    from quakescope.operators.clustering import assign_to_centres
    from quakescope.plans.batch import clean_table_columns, read_clean
    from quakescope.plans.bundle import report_bundle

    rep, out = report
    raw = quakes(spark, SF_SMALL)
    cleaned = read_clean(spark, os.path.join(out, "cleaned_earthquake.parquet"), clean_table_columns(raw))
    row = report_bundle(raw, cleaned, assign_to_centres(cleaned)).first()
    assert row["global_stats"].asDict() == rep["global_stats"]
    for section in ("mag_distribution", "temporal_activity", "hotspot_grid"):
        assert [r.asDict() for r in row[section]] == rep[section], section
    m = row["pipeline_metrics"]
    for key in ("raw_records", "clean_records", "dropped_records", "veracity_pct"):
        assert m[key] == rep["pipeline_metrics"][key], key
