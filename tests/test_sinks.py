"""Sinks by round trip, and the topic writer's options."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.session import scratch_path
from quakescope.sources import catalog as io
from quakescope.sources import sinks
from quakescope.sources.fixture import quakes


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_csv_json_parquet_round_trips(spark):
    q = quakes(spark, SF_SMALL)
    for name, write, read in [
        ("csv", sinks.write_csv, io.read_csv),
        ("json", sinks.write_json, io.read_json),
        ("parquet", sinks.write_parquet, io.read_parquet),
    ]:
        path = scratch_path(spark, name)
        write(q, path)
        assert _same(read(spark, path), q), name


def test_partitioned_parquet_prunes(spark):
    cl = C.clean(quakes(spark, SF_SMALL))
    path = scratch_path(spark, "part")
    sinks.write_parquet(cl, path, partition_by=["year", "month"])
    back = spark.read.parquet(path).filter(F.col("year") == 2024)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert back.count() == cl.filter(F.col("year") == 2024).count()


def test_projected_sink_is_repeatable_cut(spark):
    cl = C.clean(quakes(spark, SF_SMALL))
    got = sinks.projected(cl, limit=10)
    assert got.columns == ["latitude", "longitude", "depth", "mag", "mag_category",
                           "depth_category", "year", "month"]
    want = (cl.orderBy(F.md5(F.concat(F.col("id"), F.lit("#0"))), "id").limit(10)
            .select(*got.columns))
    assert _same(got, want)
    assert _same(sinks.projected(cl.repartition(3), limit=10), want)


def test_publish_to_files_and_kafka_options(spark):
    from quakescope.operators.payload import event_payload

    q = quakes(spark, SF_SMALL)
    path = scratch_path(spark, "topic")
    sinks.publish(event_payload(q), path=path)
    assert spark.read.text(path).count() == q.count()
    opts = sinks.kafka_options("broker:9092")
    assert opts["topic"] == "gempa-stream"
    assert opts["kafka.compression.type"] == "gzip"
    assert opts["kafka.batch.size"] == "65536" and opts["kafka.linger.ms"] == "10"


def test_kafka_paths_reach_the_connector(spark):
    """Without the connector jar Spark names the missing kafka source (no silent fallback)."""
    import pytest

    from quakescope.operators.payload import event_payload
    from quakescope.streaming.clean_stream import read_messages

    messages = event_payload(quakes(spark, SF_SMALL))
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.publish(messages, bootstrap_servers="localhost:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_messages(spark, bootstrap_servers="localhost:1")
