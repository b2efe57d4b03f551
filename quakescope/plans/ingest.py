"""Ingestion job: catalogue CSV → event payloads → topic (or JSON lines) + report.

One pass: payloads are built in one projection and published by a distributed
sink, and the report's figures (records, built, bytes) are observed on the rows
as they are written.  A value that does not parse counts as a failed record.
"""

from __future__ import annotations

import time
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quakescope.operators.payload import event_message, record_ok
from quakescope.operators.reports import BYTES_PER_MB, EST_BYTES_PER_RECORD
from quakescope.schema import TOPIC
from quakescope.sources.catalog import read_csv_raw
from quakescope.sources.sinks import publish


def _two_places(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def observed_payloads(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """The messages of the records that parse, and the counts of all records seen on the way."""
    seen = Observation("ingestion")
    built = raw.select(F.when(record_ok(raw), event_message(raw)).alias("value"))
    built = built.observe(seen, F.count(F.lit(1)).alias("total"), F.count("value").alias("built"),
                          F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"))
    return built.filter(F.col("value").isNotNull()), seen


def run_ingest(spark: SparkSession, csv_path: str, bootstrap_servers: str | None = None,
               out_path: str | None = None, topic: str = TOPIC,
               metrics_path: str | None = None) -> dict:
    """Publish the payloads; return (and optionally write as one JSON row) the report."""
    messages, seen = observed_payloads(read_csv_raw(spark, csv_path))
    t0 = time.time()
    publish(messages, bootstrap_servers=bootstrap_servers, path=out_path, topic=topic)
    duration = time.time() - t0
    total, built, size = (int(seen.get[k]) for k in ("total", "built", "bytes"))
    report = {
        "total_records": total, "success_count": built, "fail_count": total - built,
        "data_loss_pct": (total - built) / total * 100.0 if total else 0.0,
        "estimated_mb": _two_places(built * EST_BYTES_PER_RECORD / BYTES_PER_MB),
        "payload_mb": _two_places(size / BYTES_PER_MB),
        "duration_sec": round(duration, 4),
        "throughput_rec_per_sec": round(built / duration, 2) if duration > 0 else 0.0,
    }
    if metrics_path:
        spark.createDataFrame([report]).coalesce(1).write.mode("overwrite").json(metrics_path)
    return report
