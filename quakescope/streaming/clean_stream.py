"""Consumer of the event topic: payload stream → cleaning rule → dedup → Parquet.

The batch job's cleaning rule applied to the producer's feed with Structured
Streaming.  Source: the Kafka topic (connector on the classpath) or the JSON
lines the producer writes when no broker is configured.

The table is kept folded.  Its rows lie in buckets: the month of the event's
time and a hash of its key, so rows of one key share a bucket.  A micro-batch
is cleaned and deduplicated on its own (the batch ``dedup``: an aggregate that
folds a hot key map-side, no streaming state), then folded with the buckets it
touches, which are written anew to a folder of their own.  A pointer, one
small table per micro-batch, names every bucket's folder; it counts once it is
complete, so a reader sees the table before a batch or after it, and a batch
that runs again after a failure is folded again to the same rows.  The least
of the least rows is the least row, so the table does not depend on how the
feed was cut into micro-batches, how late rows came, or on restarts; no row is
dropped as late, and a read folds nothing.

A payload carries no ``id`` and, by default, measures filled with 0.0, so a
missing magnitude or rms reads as 0.0 here (produce with ``fill=None`` to keep
them missing).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakescope.functions.grid import snap_away
from quakescope.functions.stats import exact_mean
from quakescope.functions.timeparts import parse_time
from quakescope.operators.clean import cleaning_predicate, dedup, with_batch_columns
from quakescope.operators.payload import decode_payload
from quakescope.schema import DEDUP_KEY, PAYLOAD, TOPIC
from quakescope.session import stored

#: Folder and column of a bucket; parts of a month's keys; folder of the pointers.
BUCKET, PARTS, POINTERS = "bucket", 8, "_pointers"


def read_messages(spark: SparkSession, path: str | None = None,
                  bootstrap_servers: str | None = None, topic: str = TOPIC,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` column from the topic or from a folder of JSON lines."""
    if bootstrap_servers:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("subscribe", topic).option("startingOffsets", "earliest").load()
                .select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def clean_messages(messages: DataFrame) -> DataFrame:
    """Decoded payloads that pass the cleaning rule (rows without a readable time included, as in the batch job)."""
    return decode_payload(messages).filter(cleaning_predicate())


def fold(rows: DataFrame) -> DataFrame:
    """One row per (time, latitude, longitude); payloads have no id, so the measures decide."""
    return dedup(rows.withColumn("id", F.lit(None).cast("string")), prunable=False).drop("id")


def _bucket() -> Column:
    """Month of the time's text (``none`` where it has none) and part of the key's hash."""
    month = F.regexp_extract(F.coalesce("time", F.lit("")), r"^[0-9]{4}-[0-9]{2}", 0)
    part = F.pmod(F.xxhash64(*DEDUP_KEY), F.lit(PARTS)).cast("string")
    return F.concat(F.when(month == "", F.lit("none")).otherwise(month), F.lit("-"), part)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none where it is absent."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def _newest(spark: SparkSession, path: str) -> int:
    """Number of the newest complete pointer, 0 where there is none."""
    base = f"{path}/{POINTERS}"
    for name in sorted(_names(spark, base), reverse=True):
        if "_SUCCESS" in _names(spark, f"{base}/{name}"):
            return int(name)
    return 0


def _pointer(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    """Each bucket's folder: one row per month and part of the key."""
    if not number:
        return {}
    rows = spark.read.schema("bucket string, folder string").parquet(f"{path}/{POINTERS}/{number:012d}")
    return {r["bucket"]: r["folder"] for r in rows.collect()}


def _rows(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The buckets' rows; an empty table where there are none."""
    if not folders:
        return spark.createDataFrame([], PAYLOAD)
    return spark.read.schema(PAYLOAD).parquet(*[f"{path}/{f}" for f in sorted(folders)])


def apply_batch(messages: DataFrame, path: str) -> int:
    """Fold a batch of messages into the table at ``path``; the number of its new pointer (0: nothing came)."""
    spark, path = messages.sparkSession, path.rstrip("/")
    fresh = stored(fold(clean_messages(messages)).withColumn(BUCKET, _bucket()), "micro-batch")
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # months x PARTS at most
    newest = _newest(spark, path)
    if not touched:
        return newest
    held = _pointer(spark, path, newest)
    before = _rows(spark, path, [held[b] for b in touched if b in held])
    folder = f"v{newest + 1:012d}-{uuid.uuid4().hex}"
    after = fold(before.unionByName(fresh.drop(BUCKET))).withColumn(BUCKET, _bucket())
    after.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    held |= {b: f"{folder}/{BUCKET}={b}" for b in touched}
    rows = spark.createDataFrame(sorted(held.items()), "bucket string, folder string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{POINTERS}/{newest + 1:012d}")
    return newest + 1


def expire(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that the newest pointer no longer names; run it when no reader holds an older one."""
    path = path.rstrip("/")
    held = _pointer(spark, path, _newest(spark, path))
    kept = {f.split("/")[0] for f in held.values()}
    gone = sorted(n for n in _names(spark, path) if n.startswith("v") and n not in kept) if held else []
    for name in gone:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


def start_clean_sink(messages: DataFrame, path: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Clean every micro-batch and fold it into the table at ``path``; ``available_now`` drains what is there and stops."""
    out = messages.writeStream.foreachBatch(lambda batch, _: apply_batch(batch, path)).option("checkpointLocation", checkpoint)
    out = out.trigger(availableNow=True) if available_now else out.trigger(processingTime="10 seconds")
    return out.start()


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned feed so far with the batch job's derived columns: a scan of the newest buckets, empty before the first."""
    path = path.rstrip("/")
    return with_batch_columns(_rows(spark, path, list(_pointer(spark, path, _newest(spark, path)).values())))


def hourly_cells(clean: DataFrame, window: str = "1 hour") -> DataFrame:
    """Events, mean and max magnitude per event-time window and 1° cell, every window.

    Rows without a readable time are in no window.  Window bounds are given
    on the UTC clock (timestamps without zone).
    """
    timed = clean.withColumn("event_time", parse_time("time")).filter(F.col("event_time").isNotNull())
    return (timed
            .groupBy(F.window("event_time", window).alias("w"),
                     snap_away("latitude").alias("lat_grid"), snap_away("longitude").alias("lon_grid"))
            .agg(F.count(F.lit(1)).alias("event_count"), exact_mean("mag").alias("avg_mag"),
                 F.max("mag").alias("max_mag"))
            .select(F.convert_timezone(None, F.lit("UTC"), F.col("w.start")).alias("window_start"),
                    F.convert_timezone(None, F.lit("UTC"), F.col("w.end")).alias("window_end"),
                    "lat_grid", "lon_grid", "event_count", "avg_mag", "max_mag"))
