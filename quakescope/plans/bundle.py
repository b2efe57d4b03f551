"""Report bundle: one row of scalar groups and four bounded record lists.

Each section is a one-row aggregate (lists come from aggregates whose size is
bounded: ≤ 5 classes, one row per calendar month, top-k cells, k zones).
Numeric nulls in the lists read 0 (the unknown-time month group is year 0).  The
sections are stacked with ``unionByName`` and folded with ``first`` — no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.operators.clustering import cluster_summary
from quakescope.functions.stats import pct_of
from quakescope.operators.reports import report_pass, row_count, split_report_pass
from quakescope.schema import REPORT
from quakescope.session import scratch_path

SECTIONS = [f.name for f in REPORT.fields]


def _ordered_list(df: DataFrame, order: list[Column], fields: list[str], name: str) -> DataFrame:
    """Rows of a small aggregate as one sorted array of structs."""
    keyed = df.select(F.struct(*order).alias("k"), F.struct(*fields).alias("v"))
    return keyed.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias(name))


def _counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw, clean and dropped counts and the dropped share: two one-row counts, no join."""
    tagged = row_count(raw).select(F.col("n").alias("raw_records"), F.lit(None).cast("bigint").alias("clean_records"))
    tagged = tagged.union(row_count(clean).select(F.lit(None).cast("bigint"), F.col("n")))
    both = tagged.agg(F.max("raw_records").alias("raw_records"), F.max("clean_records").alias("clean_records"))
    dropped = F.col("raw_records") - F.col("clean_records")
    return both.select("raw_records", "clean_records", dropped.alias("dropped_records"), pct_of(dropped, "raw_records").alias("veracity_pct"))


def report_values(bundle: DataFrame) -> DataFrame:
    """The bundle's values but for timings as rows (section, item, value)."""
    def rows(section: str, source: str, name, fields: list[str]):
        each = [F.struct(F.lit(section).alias("section"), F.concat_ws(" ", name("r"), F.lit(f)).alias("item"),
                         F.col(f"r.{f}").cast("double").alias("value")) for f in fields]
        return bundle.select(F.explode(source).alias("r")).select(F.explode(F.array(*each)).alias("v")).select("v.*")

    def scalars(section: str, fields: list[str]):
        each = [F.struct(F.lit(section).alias("section"), F.lit(f).alias("item"), F.col(f"{section}.{f}").cast("double").alias("value")) for f in fields]
        return bundle.select(F.explode(F.array(*each)).alias("v")).select("v.*")

    whole = lambda c: F.col(c).cast("int").cast("string")
    parts = [
        scalars("pipeline_metrics", ["raw_records", "clean_records", "dropped_records", "veracity_pct"]),
        scalars("global_stats", ["total_events", "avg_magnitude", "max_magnitude", "min_magnitude", "std_magnitude", "avg_depth_km"]),
        rows("mag_distribution", "mag_distribution", lambda r: F.col(f"{r}.mag_category"), ["jumlah"]),
        rows("temporal_activity", "temporal_activity", lambda r: F.concat_ws("-", whole(f"{r}.year"), whole(f"{r}.month")), ["jumlah", "avg_mag", "max_mag"]),
        rows("hotspot_grid", "hotspot_grid", lambda r: F.concat_ws(",", whole(f"{r}.lat_grid"), whole(f"{r}.lon_grid")), ["event_count", "avg_mag", "max_mag"]),
        rows("cluster_summary", "cluster_summary", lambda r: whole(f"{r}.cluster"), ["jumlah_event", "center_lat", "center_lon", "avg_depth", "avg_mag", "max_mag"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_bundle(raw: DataFrame, clean: DataFrame, clustered: DataFrame | None,
                  timings: dict[str, float] | None = None, cores: int | None = None,
                  top_k: int = 200) -> DataFrame:
    """The batch job's report as a one-row DataFrame with the ``REPORT`` schema.

    ``clean`` is the deduplicated table (best: the written one), so the counts
    are two row counts.  The combined aggregate of its four reports is written
    to the shared folder once and split from there.
    """
    timings = timings or {}
    q = _counts(raw, clean)
    metric_cols = [F.col("raw_records"), F.col("clean_records"), F.col("dropped_records"),
                   F.col("veracity_pct")]
    for name in ["ingestion_time_sec", "cleaning_time_sec", "analytics_time_sec",
                 "clustering_time_sec", "total_pipeline_latency_sec"]:
        metric_cols.append(F.lit(timings.get(name)).cast("double").alias(name))
    total = timings.get("total_pipeline_latency_sec")
    metric_cols.append(
        (F.round(F.col("clean_records") / F.lit(total), 2) if total else F.lit(None).cast("double"))
        .alias("throughput_rec_per_sec"))
    metric_cols.append(F.lit(cores).cast("int").alias("spark_cores"))
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "report-pass")
    combined = report_pass(clean)
    combined.write.parquet(path)
    parts = split_report_pass(spark.read.schema(combined.schema).parquet(path), top_k)
    sections = [
        q.select(F.struct(*metric_cols).alias("pipeline_metrics")),
        parts["global_stats"].select(F.struct("*").alias("global_stats")),
        _ordered_list(parts["mag_distribution"], [-F.col("jumlah"), F.col("mag_category")],
                      ["mag_category", "jumlah"], "mag_distribution"),
        _ordered_list(parts["monthly"].fillna(0), [F.col("year"), F.col("month")],
                      ["year", "month", "jumlah", "avg_mag", "max_mag"], "temporal_activity"),
        _ordered_list(parts["hotspots"].fillna(0),
                      [-F.col("event_count"), F.col("lat_grid"), F.col("lon_grid")],
                      ["lat_grid", "lon_grid", "event_count", "avg_mag", "max_mag"], "hotspot_grid"),
    ]
    if clustered is not None:
        sections.append(_ordered_list(
            cluster_summary(clustered).fillna(0), [F.col("cluster")],
            ["cluster", "jumlah_event", "center_lat", "center_lon", "avg_depth", "avg_mag", "max_mag"],
            "cluster_summary"))
    stacked = sections[0]
    for s in sections[1:]:
        stacked = stacked.unionByName(s, allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in SECTIONS
                           if c in stacked.columns])
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in REPORT.fields
               if f.name not in folded.columns]
    out = folded.select("*", *missing) if missing else folded
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT.fields])
