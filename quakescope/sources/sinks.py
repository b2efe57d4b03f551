"""Sinks: Parquet, CSV, JSON lines, and the event topic (Kafka or JSON lines).

All writes are distributed (one file per task); nothing passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakescope.schema import FEATURES, TOPIC

# Producer batching of the original ingestion (64 KB batches,
# 10 ms linger, gzip).
KAFKA_PRODUCER_OPTIONS = {
    "kafka.batch.size": "65536",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "gzip",
}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet, all columns; ``partition_by`` (e.g. year, month) enables pruning.

    Partitioned rows are first rebalanced by those columns, so a month is
    written by one task, or by several if it is large, and not by all.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Fixed value: seed of the repeatable cut of the projected table.
PROJECTED_SEED = 0


def projected(df: DataFrame, limit: int | None, key: str = "id") -> DataFrame:
    """Features, classes and (if present) year/month of at most ``limit`` rows (None: all).

    A file-order head has no meaning on a distributed table; the cut is the
    repeatable bottom-``limit`` by ``md5(key#0)`` (``sampling.bottom_k``),
    which never merges more than about ``limit`` rows in one task.
    """
    from quakescope.operators.sampling import bottom_k

    cols = list(FEATURES) + ["mag_category", "depth_category"]
    if "year" in df.columns:
        cols += ["year", "month"]
    if limit is None:
        return df.select(*cols)
    return bottom_k(df, limit, PROJECTED_SEED, key).select(*cols)


def write_projected_parquet(df: DataFrame, path: str, limit: int | None) -> None:
    projected(df, limit).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def kafka_options(bootstrap_servers: str, topic: str = TOPIC) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(KAFKA_PRODUCER_OPTIONS)
    return opts


def publish(messages: DataFrame, bootstrap_servers: str | None = None, path: str | None = None,
            topic: str = TOPIC) -> None:
    """Send the ``value`` column to the topic, or write it as JSON lines to ``path``.

    The Kafka connector must be on the classpath for the topic form; the
    file form is the stand-in when no broker is configured.
    """
    if bootstrap_servers:
        (messages.select(F.col("value").cast("string").alias("value"))
         .write.format("kafka").options(**kafka_options(bootstrap_servers, topic)).save())
    elif path:
        messages.select("value").write.mode("overwrite").text(path)
    else:
        raise ValueError("give bootstrap_servers or path")
