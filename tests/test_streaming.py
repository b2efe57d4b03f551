"""Structured Streaming consumer: the same table however the feed is cut, after a restart, late rows included."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quakescope.operators import clean as C
from quakescope.operators.payload import decode_payload, event_payload
from quakescope.session import scratch_path
from quakescope.sources.fixture import quakes
from quakescope.sources.sinks import publish
from quakescope.streaming import clean_stream
from quakescope.streaming.clean_stream import apply_batch, expire, fold, hourly_cells, read_messages, read_stream, start_clean_sink


@pytest.fixture(scope="module")
def topic(spark):
    path = scratch_path(spark, "topic")
    raw = quakes(spark, SF_SMALL)
    odd = raw.limit(3).withColumn("time", F.lit("not a time"))  # unreadable times are kept by the rule
    again = raw.limit(40).withColumn("mag", F.col("mag") + 1)   # later copies with other measures
    publish(event_payload(raw.unionByName(odd).unionByName(again).repartition(8)), path=path)
    return path


def drain(spark, topic, per_trigger, out, checkpoint):
    start_clean_sink(read_messages(spark, topic, max_files_per_trigger=per_trigger), out, checkpoint).awaitTermination()
    return sorted(map(str, read_stream(spark, out).collect()))


def test_result_does_not_depend_on_micro_batches(spark, topic):
    runs = []
    for per_trigger in (None, 3, 1):
        runs.append(drain(spark, topic, per_trigger, scratch_path(spark, "out"), scratch_path(spark, "ck")))
    assert runs[0] == runs[1] == runs[2]
    batch = decode_payload(spark.read.text(topic)).filter(C.cleaning_predicate())
    assert len(runs[0]) == batch.select("time", "latitude", "longitude").distinct().count()
    assert runs[0] == sorted(map(str, C.with_batch_columns(fold(batch)).collect()))


def test_restart_and_new_files(spark, topic):
    feed, out, ck = (scratch_path(spark, n) for n in ("feed", "out", "ck"))
    files = spark.read.text(topic).repartition(4)
    files.write.text(feed)
    first = drain(spark, feed, 1, out, ck)
    assert drain(spark, feed, 1, out, ck) == first
    files.limit(50).write.mode("append").text(feed)  # the same events again, later
    assert drain(spark, feed, 1, out, ck) == first


def test_batch_written_twice_is_one_batch(spark, topic):
    out = scratch_path(spark, "out")
    first = drain(spark, topic, None, out, scratch_path(spark, "ck"))
    assert drain(spark, topic, None, out, scratch_path(spark, "ck")) == first


def test_hourly_cells_hold_every_event(spark, topic):
    out = scratch_path(spark, "out")
    drain(spark, topic, 2, out, scratch_path(spark, "ck"))
    rows = read_stream(spark, out)
    cells = hourly_cells(rows)
    assert cells.agg(F.sum("event_count")).first()[0] == rows.filter(F.try_to_timestamp("time").isNotNull()).count()
    assert cells.filter(F.col("window_end") <= F.col("window_start")).count() == 0


def test_an_empty_feed_is_an_empty_table(spark):
    out = scratch_path(spark, "out")
    assert read_stream(spark, out).count() == 0 and "year" in read_stream(spark, out).columns
    assert apply_batch(spark.createDataFrame([], "value string"), out) == 0
    assert apply_batch(spark.createDataFrame([("no json",)], "value string"), out) == 0
    assert read_stream(spark, out).count() == 0


def one_event(spark, **kw):
    row = {"time": "2024-05-01T00:00:00.000Z", "latitude": 1.0, "longitude": 2.0, "depth": 3.0, "mag": 4.0, "rms": 0.5, "type": "earthquake"} | kw
    import json

    return spark.createDataFrame([(json.dumps(row),)], "value string")


def test_a_batch_rewrites_only_its_buckets(spark, topic):
    out = scratch_path(spark, "out")
    apply_batch(spark.read.text(topic), out)
    before = clean_stream._pointer(spark, out, clean_stream._newest(spark, out))
    apply_batch(one_event(spark, latitude=77.7), out)
    after = clean_stream._pointer(spark, out, clean_stream._newest(spark, out))
    changed = {b for b in after if before.get(b) != after[b]}
    assert len(changed) == 1 and next(iter(changed)).startswith("2024-05-") and before.keys() <= after.keys()
    assert read_stream(spark, out).filter("latitude = 77.7").count() == 1


def test_a_reader_sees_whole_batches_and_old_folders_expire(spark, topic):
    out = scratch_path(spark, "out")
    apply_batch(spark.read.text(topic), out)
    held = read_stream(spark, out)
    rows = held.count()
    # a batch that stops before its pointer is complete changes nothing for readers
    newest = clean_stream._newest(spark, out)
    spark.createDataFrame([("2024-05-1", "nowhere")], "bucket string, folder string").write.parquet(f"{out}/_pointers/{newest + 1:012d}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_pointers/{newest + 1:012d}/_SUCCESS")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, False)
    assert read_stream(spark, out).count() == rows
    assert apply_batch(spark.read.text(topic), out) == newest + 1  # the same batch again
    assert sorted(map(str, read_stream(spark, out).collect())) == sorted(map(str, held.collect()))
    assert expire(spark, out) and read_stream(spark, out).count() == rows
    assert expire(spark, out) == []
