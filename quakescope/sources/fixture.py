"""The ``quakes`` catalogue view over the driver's ``events`` table.

Deterministic, integer arithmetic before one division, so every double is the
same in Spark and in an SQL engine fed the same parquet.  It carries null and
malformed times, nulls in every filtered column, negative magnitudes and
depths, rms above 2, exact copies (id prefix ``d``) and a non-earthquake type.
One scan of ``events``: the copies come from ``explode``, not a self-union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def quakes_from_events(events: DataFrame) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    b = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.explode(F.when(eid % 37 == 0, F.array(F.lit("q"), F.lit("d")))
                  .otherwise(F.array(F.lit("q")))).alias("pfx"))
    k = b.select(
        "*",
        F.round(F.col("value") * 100).cast("bigint").alias("c"),
        (F.col("ts") + F.make_dt_interval(days=((uid % 150) * 10).cast("int"))).alias("t"))
    et = F.col("event_type")
    return k.select(
        F.when(eid % 61 == 0, F.lit(None).cast("string"))
         .when(eid % 67 == 0, F.lit("not-a-time"))
         .otherwise(F.date_format("t", ISO_FORMAT)).alias("time"),
        _null_if(eid % 53 == 0, ((uid * 7919) % 16001 - 8000 + (eid % 7) * 13).cast("double") / 100)
        .alias("latitude"),
        _null_if(eid % 59 == 0, ((uid * 104729) % 35001 - 17500 + (eid % 5) * 17).cast("double") / 100)
        .alias("longitude"),
        _null_if(eid % 47 == 0, ((eid * 31) % 7000 - 100).cast("double") / 10).alias("depth"),
        _null_if(eid % 43 == 0, (F.col("c") % 910 - 50).cast("double") / 100).alias("mag"),
        F.when(eid % 71 == 0, F.lit(None).cast("string"))
         .when(et == "click", F.lit("ml")).when(et == "view", F.lit("md"))
         .when(et == "signup", F.lit("mb")).otherwise(F.lit("mww")).alias("magType"),
        _null_if(eid % 29 == 0, (eid % 120).cast("double")).alias("nst"),
        _null_if(eid % 31 == 0, (eid % 360).cast("double")).alias("gap"),
        ((eid % 500).cast("double") / 100).alias("dmin"),
        _null_if(eid % 41 == 0, ((eid * 17) % 230).cast("double") / 100).alias("rms"),
        F.when(eid % 3 == 0, F.lit("us")).when(eid % 3 == 1, F.lit("ci"))
         .otherwise(F.lit("ak")).alias("net"),
        F.concat(F.col("pfx"), eid.cast("string")).alias("id"),
        F.date_format("ts", ISO_FORMAT).alias("updated"),
        F.concat((eid % 90).cast("string"), F.lit(" km of SITE_"), (uid % 25).cast("string"))
        .alias("place"),
        F.when(et == "error", F.lit("quarry blast")).otherwise(F.lit("earthquake")).alias("type"),
        F.when(eid % 4 == 0, F.lit("automatic")).otherwise(F.lit("reviewed")).alias("status"),
        F.lit("us").alias("locationSource"),
        F.lit("us").alias("magSource"),
    )


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18-column catalogue derived from ``{sf_dir}/events.parquet``."""
    return quakes_from_events(read_events(spark, sf_dir))


# The same view in DuckDB SQL (used by the oracle queries); ``events`` is a
# registered view there.
QUAKES_SQL = """
b AS (
  SELECT *, 'q' AS pfx FROM events
  UNION ALL
  SELECT *, 'd' AS pfx FROM events WHERE event_id % 37 = 0
), k AS (
  SELECT *, CAST(round(value * 100) AS BIGINT) AS c,
         ts + (user_id % 150) * INTERVAL '10' DAY AS t
  FROM b
), quakes AS (
SELECT
  CASE WHEN event_id % 61 = 0 THEN NULL
       WHEN event_id % 67 = 0 THEN 'not-a-time'
       ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%gZ') END AS time,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST((user_id * 7919) % 16001 - 8000 + (event_id % 7) * 13 AS DOUBLE) / 100 END AS latitude,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST((user_id * 104729) % 35001 - 17500 + (event_id % 5) * 17 AS DOUBLE) / 100 END AS longitude,
  CASE WHEN event_id % 47 = 0 THEN NULL ELSE CAST((event_id * 31) % 7000 - 100 AS DOUBLE) / 10 END AS depth,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(c % 910 - 50 AS DOUBLE) / 100 END AS mag,
  CASE WHEN event_id % 71 = 0 THEN NULL
       ELSE CASE event_type WHEN 'click' THEN 'ml' WHEN 'view' THEN 'md' WHEN 'signup' THEN 'mb' ELSE 'mww' END END AS magType,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id % 120 AS DOUBLE) END AS nst,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS gap,
  CAST(event_id % 500 AS DOUBLE) / 100 AS dmin,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST((event_id * 17) % 230 AS DOUBLE) / 100 END AS rms,
  CASE event_id % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'ci' ELSE 'ak' END AS net,
  concat(pfx, CAST(event_id AS VARCHAR)) AS id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated,
  concat(CAST(event_id % 90 AS VARCHAR), ' km of SITE_', CAST(user_id % 25 AS VARCHAR)) AS place,
  CASE event_type WHEN 'error' THEN 'quarry blast' ELSE 'earthquake' END AS type,
  CASE WHEN event_id % 4 = 0 THEN 'automatic' ELSE 'reviewed' END AS status,
  'us' AS locationSource,
  'us' AS magSource
FROM k
)"""
