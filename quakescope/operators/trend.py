"""Trend of monthly counts: a dense calendar of months and a straight line through it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "year int, month int, events long, slope double, intercept double, fitted double"


def monthly_counts(df: DataFrame) -> DataFrame:
    """month_index, year, month, events for every month from the first to the last known one, zero-filled.

    ``month_index`` counts months from year 0.  Rows without a readable time
    are in no month; without any known month there are no rows.
    """
    index = F.col("year") * 12 + F.col("month") - 1
    counts = (df.filter(F.col("year").isNotNull() & F.col("month").isNotNull())
              .groupBy(index.alias("month_index")).agg(F.count(F.lit(1)).alias("events")))
    ends = counts.agg(F.min("month_index").alias("low"), F.max("month_index").alias("high")).filter(F.col("low").isNotNull())
    calendar = ends.select(F.explode(F.sequence("low", "high")).alias("month_index"))
    dense = calendar.join(counts, "month_index", "left")
    return dense.select("month_index", F.floor(F.col("month_index") / 12).cast("int").alias("year"),
                        (F.pmod("month_index", F.lit(12)) + 1).cast("int").alias("month"),
                        F.coalesce("events", F.lit(0)).cast("long").alias("events"))


def line(dense: DataFrame) -> tuple[int, float, float] | None:
    """First month_index, slope and intercept of the least-squares line through (months since the first, events).

    From five sums in integers, so the two quotients do not depend on the
    order of rows.  One month has slope 0; no month, no line.
    """
    i, n = F.col("month_index").cast("decimal(38,0)"), F.col("events").cast("decimal(38,0)")
    row = dense.agg(F.count(F.lit(1)).alias("m"), F.min("month_index").alias("first"), F.sum(i).alias("x"), F.sum(n).alias("y"),
                    F.sum(i * i).alias("xx"), F.sum(i * n).alias("xy")).first()
    m, first = row["m"], row["first"]
    if not m:
        return None
    x, y, xx, xy = (int(row[c]) for c in ("x", "y", "xx", "xy"))
    x, xx, xy = x - m * first, xx - 2 * first * x + m * first * first, xy - first * y  # months since the first
    spread = m * xx - x * x
    slope = (m * xy - x * y) / spread if spread else 0.0
    intercept = (y * xx - x * xy) / spread if spread else float(y)
    return first, slope, intercept


def trend(df: DataFrame, ahead: int = 0) -> DataFrame:
    """Events per month with the line through them; ``ahead`` further months have no events but a fitted count.

    Columns year, month, events (null ahead), slope and intercept (of events
    over months since the first), fitted.  Months without events count as 0.
    """
    dense = monthly_counts(df)
    found = line(dense)
    if found is None:
        return df.sparkSession.createDataFrame([], SCHEMA)
    first, slope, intercept = found
    if ahead:
        last = dense.agg(F.max("month_index").alias("last"))
        future = last.select(F.explode(F.sequence(F.col("last") + 1, F.col("last") + ahead)).alias("month_index"))
        future = future.select("month_index", F.floor(F.col("month_index") / 12).cast("int").alias("year"),
                               (F.pmod("month_index", F.lit(12)) + 1).cast("int").alias("month"), F.lit(None).cast("long").alias("events"))
        dense = dense.unionByName(future)
    since = (F.col("month_index") - F.lit(first)).cast("double")
    return dense.select("year", "month", "events", F.lit(slope).alias("slope"), F.lit(intercept).alias("intercept"),
                        (F.lit(intercept) + F.lit(slope) * since).alias("fitted"))
