"""Plan-shape guards: pruning and pushdown reach the scan; no cross joins or Python UDFs."""

import re

import pytest

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.operators import reports as R
from quakescope.session import scratch_path
from quakescope.sources import catalog
from quakescope.sources.fixture import quakes

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "BroadcastExchange"]


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def cat(spark):
    path = scratch_path(spark, "plan-cat")
    quakes(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return catalog.read_parquet(spark, path)


def test_hotspots_prune_and_push(spark, cat):
    text = plan(R.hotspots(C.clean(cat), 200))
    read = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")][0]
    for unused in ("place", "magType", "net", "status", "updated", "nst", "gap", "dmin"):
        assert unused not in read
    pushed = [ln for ln in text.splitlines() if ln.startswith("PushedFilters")][0]
    for pred in ("EqualTo(type,earthquake)", "GreaterThanOrEqual(mag,0.0)", "LessThanOrEqual(rms,2.0)"):
        assert pred in pushed
    assert "TakeOrderedAndProject" in text


def test_report_pass_is_one_aggregate(spark, cat):
    text = plan(R.report_pass(C.clean(cat)))
    nodes = [ln.split(" ", 1)[1].strip() for ln in text.splitlines() if re.match(r"^\(\d+\) ", ln)]
    assert nodes.count("Expand") == 1
    assert nodes.count("Exchange") == 2  # the dedup's and the report's


def test_dedup_combines_map_side(spark, cat):
    text = plan(C.dedup(cat))
    assert "partial_min" in text  # partial aggregate before the exchange


def test_no_cross_joins_or_python_in_registered_queries(spark):
    from quakescope.plans.registry import QUERIES

    for key, fn in QUERIES.items():
        text = plan(fn(spark, SF_SMALL))
        for node in FORBIDDEN:
            assert node not in text, (key, node)


def test_no_cross_joins_or_python_in_the_analyses(spark):
    """Spark broadcasts by its own size check there; nothing is hinted, and no join is without a key."""
    from quakescope.plans.analysis import QUERIES

    for key, fn in QUERIES.items():
        text = plan(fn(spark, SF_SMALL))
        for node in FORBIDDEN:
            assert node == "BroadcastExchange" or node not in text, (key, node)


def test_a_read_of_the_stream_table_shuffles_nothing(spark):
    from quakescope.operators.payload import event_payload
    from quakescope.streaming.clean_stream import apply_batch, read_stream

    out = scratch_path(spark, "stream-plan")
    apply_batch(event_payload(quakes(spark, SF_SMALL)), out)
    assert "Exchange" not in plan(read_stream(spark, out))


def test_a_view_reads_its_input_once(spark, cat):
    text = plan(C.dashboard_view(C.display_clean(cat)))
    assert len(re.findall(r"^\(\d+\) Scan", text, re.M)) == 1
    assert "Exchange" not in text


def test_queries_release_what_they_persist(spark):
    from quakescope.plans.registry import QUERIES

    for key in ("report_bundle", "kmeans_summary", "kmeans_summary_check"):
        QUERIES[key](spark, SF_SMALL).collect()
        assert not spark.sparkContext._jsc.getPersistentRDDs(), key
