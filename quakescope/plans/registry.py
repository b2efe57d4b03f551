"""Named queries over the catalogue derived from a test-data folder.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; every one reads
the whole ``events`` table through the ``quakes`` view (no subsets).  Queries
that write and read back use a fresh folder under the shared checkpoint
folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.functions.classes import depth_class, mag_class_left, mag_class_right, mag_class_six
from quakescope.functions.grid import snap_away, snap_even
from quakescope.functions.labels import coord_label, period_label
from quakescope.functions.stats import round_half_up
from quakescope.functions.timeparts import day_start, utc_wall_time
from quakescope.operators import clean as C
from quakescope.operators import clustering as Z
from quakescope.operators import reports as R
from quakescope.operators import sampling as S
from quakescope.operators.payload import decode_payload, event_payload
from quakescope.plans import dashboard as D
from quakescope.plans.batch import clean_table_columns, read_clean, write_clean
from quakescope.plans.bundle import report_bundle, report_values
from quakescope.schema import CATALOG_COLUMNS, FEATURES, HEADER_ALIASES
from quakescope.session import scratch_path, stored
from quakescope.sources import catalog as io
from quakescope.sources import sinks
from quakescope.sources.fixture import quakes
from quakescope.sources.report import read_report
from quakescope.streaming.clean_stream import hourly_cells, read_messages, read_stream, start_clean_sink

Query = Callable[[SparkSession, str], DataFrame]

# The range used by the ``range_filter`` check.
RANGE_MAG = (2.5, 6.0)
RANGE_DEPTH = (10.0, 300.0)
RANGE_YEAR = (2025, 2027)


def _raw(spark, sf):
    return quakes(spark, sf)


def _clean(spark, sf, prunable=True):
    """Cleaned rows; ``prunable=False`` where the query keeps every column."""
    return C.clean(quakes(spark, sf), prunable=prunable)


def _display(spark, sf):
    return C.display_clean(quakes(spark, sf))


def _view(spark, sf):
    return C.dashboard_view(_display(spark, sf))


# --- sources and sinks -------------------------------------------------------

def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(_raw(spark, sf), path)
    return io.read_csv(spark, path)


def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(_clean(spark, sf, prunable=False), path, partition_by=["year", "month"])
    back = spark.read.parquet(path)
    return back.select(*[F.col(c) for c in _clean_columns()])


def _clean_columns():
    return CATALOG_COLUMNS + ["year", "month", "hour", "mag_category", "depth_category"]


def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    sinks.write_json(_raw(spark, sf), path)
    return io.read_json(spark, path)


def parquet_projected(spark, sf):
    path = scratch_path(spark, "projected")
    sinks.write_projected_parquet(_clean(spark, sf), path, limit=50000)
    return spark.read.parquet(path)


def normalize_headers(spark, sf):
    renamed = _raw(spark, sf).withColumnsRenamed({v: k for k, v in HEADER_ALIASES.items()})
    return io.conform(renamed)


def event_payload_q(spark, sf):
    path = scratch_path(spark, "topic")
    sinks.publish(event_payload(_raw(spark, sf)), path=path)
    return decode_payload(spark.read.text(path))


def _clean_table(spark, sf):
    """The cleaned table written once to the shared folder and read back."""
    raw = _raw(spark, sf)
    path = scratch_path(spark, "clean")
    write_clean(raw, path)
    return read_clean(spark, path, clean_table_columns(raw))


def _from_fit(fit, shape, name):
    """``shape(fit)`` written out; the fit's persisted rows are released."""
    try:
        return stored(shape(fit), name)
    finally:
        fit.unpersist()


def report_bundle_q(spark, sf):
    cl = _clean_table(spark, sf)
    return _from_fit(Z.fit_zones(cl), lambda fit: report_bundle(
        _raw(spark, sf), cl, fit.assigned(), cores=spark.sparkContext.defaultParallelism), "bundle")


def _bundle(spark, sf, timings=None, zones=True, cores=None):
    """The report bundle (zones at the published centres) written as JSON and read back."""
    path = scratch_path(spark, "report")
    cl = _clean_table(spark, sf)
    bundle = report_bundle(_raw(spark, sf), cl, Z.assign_to_centres(cl) if zones else None, timings, cores)
    bundle.write.mode("overwrite").json(path)
    return read_report(spark, path)


def report_bundle_read(spark, sf):
    return _bundle(spark, sf)


def report_values_q(spark, sf):
    """Every value of the report bundle but the timings, read back from disk."""
    return report_values(_bundle(spark, sf))


def metric_table_volume(spark, sf):
    """The page's volume/veracity table from the report bundle read back from disk."""
    return D.metric_tables(_bundle(spark, sf, zones=False))["volume"]


# The stage times and core count of the performance table's check.
TIMINGS = {"ingestion_time_sec": 1.5, "cleaning_time_sec": 2.25, "analytics_time_sec": 0.125,
           "clustering_time_sec": 4.0, "total_pipeline_latency_sec": 8.0}
CORES = 8


def metric_table_performance(spark, sf):
    """The page's performance table from a bundle with set stage times."""
    return D.metric_tables(_bundle(spark, sf, TIMINGS, zones=False, cores=CORES))["performance"]


def kpi_tiles_q(spark, sf):
    """Header tiles: the dashboard rows with the report bundle read back from disk."""
    return D.kpi_tiles(_view(spark, sf), _bundle(spark, sf, zones=False))


def five_v_q(spark, sf):
    """Values of the volume, velocity and veracity cards from a bundle with set stage times."""
    return D.five_v(_view(spark, sf), _bundle(spark, sf, TIMINGS, zones=False))


def _cleaned_feed(spark, sf):
    """Producer feed → Structured Streaming clean → the folded table."""
    topic = scratch_path(spark, "topic")
    sinks.publish(event_payload(_raw(spark, sf)), path=topic)
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    start_clean_sink(read_messages(spark, topic), out, checkpoint).awaitTermination()
    return read_stream(spark, out)


def stream_clean(spark, sf):
    """Keys and calendar parts of the cleaned feed."""
    return _cleaned_feed(spark, sf).select("time", "latitude", "longitude", "year", "month")


def stream_hourly_cells(spark, sf):
    """Hourly 1° cells of the cleaned feed, every window."""
    return hourly_cells(_cleaned_feed(spark, sf))


# --- cleaning and filters ----------------------------------------------------

def clean_q(spark, sf):
    return _clean(spark, sf, prunable=False)


def display_clean_q(spark, sf):
    return _display(spark, sf)


def dedup_q(spark, sf):
    return C.dedup(_raw(spark, sf))


def dedup_null_ids(spark, sf):
    """Dedup on coarse keys with every third magnitude's ids missing: the measures decide."""
    raw = _raw(spark, sf)
    no_id = F.pmod(F.round(F.col("mag") * 10).cast("long"), F.lit(3)) == 0
    coarse = raw.withColumns({"id": F.when(F.coalesce(no_id, F.lit(True)), F.lit(None)).otherwise(F.col("id")),
                              "time": F.substring("time", 1, 10), "latitude": F.round(F.col("latitude")),
                              "longitude": F.round(F.col("longitude"))})
    return C.dedup(coarse).select("time", "latitude", "longitude", "id", "mag", "depth", "rms", "type")


def distinct_rows_q(spark, sf):
    return C.clean_rows(_raw(spark, sf).drop("time", "id"))


def range_filter_q(spark, sf):
    return C.range_filter(_display(spark, sf), RANGE_MAG, RANGE_DEPTH, RANGE_YEAR)


def filter_bounds_q(spark, sf):
    return C.filter_bounds(_display(spark, sf)).select(
        "mag_min", "mag_max", "depth_min", "depth_max", "year_min", "year_max",
        F.size("years").alias("n_years"))


def years_q(spark, sf):
    return C.years(_display(spark, sf))


def dashboard_view_q(spark, sf):
    return _view(spark, sf)


# --- scalar functions --------------------------------------------------------

def time_parts(spark, sf):
    t = utc_wall_time("time")
    return _raw(spark, sf).select("id", "time", F.year(t).alias("year"), F.month(t).alias("month"),
                                  F.hour(t).alias("hour"), day_start("time").alias("day"))


def _classed(fn, col):
    def q(spark, sf):
        return _raw(spark, sf).select("id", col, fn(col).alias("category"))
    return q


def _snapped(snap, decimals):
    def q(spark, sf):
        return _raw(spark, sf).select("id", "latitude", "longitude",
                                      snap("latitude", decimals).alias("lat_grid"),
                                      snap("longitude", decimals).alias("lon_grid"))
    return q


def period_label_q(spark, sf):
    m = R.monthly(_view(spark, sf), keep_unknown=False)
    return m.select("year", "month", "jumlah", period_label("year", "month").alias("period"))


def coord_label_q(spark, sf):
    h = R.hotspots(_view(spark, sf), 20, decimals=1, ties="even")
    return h.select("lat_grid", "lon_grid", coord_label("lat_grid", "lon_grid").alias("label"))


def display_table(spark, sf):
    h = R.hotspots(_view(spark, sf), 20, decimals=1, ties="even")
    return h.select(F.col("lat_grid").alias("Lat"), F.col("lon_grid").alias("Lon"),
                    F.col("event_count").alias("Event"),
                    round_half_up("avg_mag", 2).alias("Avg Mag"),
                    round_half_up("max_mag", 2).alias("Max Mag"))


# --- reports -----------------------------------------------------------------

def mag_distribution_q(spark, sf):
    return R.mag_distribution(_clean(spark, sf))


def mag_distribution_right(spark, sf):
    return R.mag_distribution(C.clean_rows(_raw(spark, sf)).withColumn(
        "mag_category", mag_class_right("mag")))


def mag_share_q(spark, sf):
    return R.mag_share(_view(spark, sf), "mag_category")


def depth_distribution_q(spark, sf):
    return R.depth_distribution(_view(spark, sf))


def monthly_q(spark, sf):
    return R.monthly(_clean(spark, sf))


def monthly_known(spark, sf):
    return R.monthly(_view(spark, sf), keep_unknown=False)


def daily_q(spark, sf):
    return R.daily(_view(spark, sf))


def yearly_q(spark, sf):
    return R.yearly(_view(spark, sf))


def hotspots_1deg(spark, sf):
    return R.hotspots(_clean(spark, sf), 200)


def hotspots_1deg_even(spark, sf):
    return R.hotspots(_clean(spark, sf), 200, ties="even")


def hotspots_tenth(spark, sf):
    return R.hotspots(_view(spark, sf), 20, decimals=1, ties="even")


def global_stats_q(spark, sf):
    return R.global_stats(_clean(spark, sf))


def kpis_q(spark, sf):
    return R.kpis(_view(spark, sf))


def row_count_q(spark, sf):
    return R.row_count(_raw(spark, sf))


def quality_report_q(spark, sf):
    return R.quality_report(_raw(spark, sf))


def ingestion_report_q(spark, sf):
    return R.ingestion_report(_raw(spark, sf))


def ingestion_report_csv(spark, sf):
    path = scratch_path(spark, "ingest")
    sinks.write_csv(_raw(spark, sf), path)
    return R.ingestion_report(io.read_csv_raw(spark, path))


def ingestion_report_failures(spark, sf):
    """Ingestion report of a CSV in which every seventh tenth of a magnitude is no number."""
    path = scratch_path(spark, "ingest")
    bad = F.pmod(F.round(F.col("mag") * 10).cast("long"), F.lit(7)) == 0
    raw = _raw(spark, sf)
    sinks.write_csv(raw.withColumn("mag", F.when(bad, F.lit("n/a")).otherwise(F.col("mag").cast("string"))), path)
    return R.ingestion_report(io.read_csv_raw(spark, path))


def mag_histogram_q(spark, sf):
    return R.mag_histogram(_view(spark, sf))


def density_grid_q(spark, sf):
    return R.density_grid(_view(spark, sf))


# --- samples -----------------------------------------------------------------

def sample_heatmap(spark, sf):
    return S.heatmap_sample(_view(spark, sf), D.HEATMAP_N)


def sample_scatter_map(spark, sf):
    return S.scatter_map_sample(_view(spark, sf), D.SCATTER_N)


def sample_depth_mag(spark, sf):
    return S.depth_mag_sample(_view(spark, sf), D.DEPTH_MAG_N)


def sample_cluster_input(spark, sf):
    return S.bottom_k(_view(spark, sf), 100000, 42).select(*FEATURES)


def _sample_of(n):
    def q(spark, sf):
        return S.bottom_k(_view(spark, sf), n, 42).select("id", *FEATURES)
    return q


def sample_small(spark, sf):
    """Bottom-1,000 of the whole display set (exercises the bucket cut)."""
    return S.bottom_k(_view(spark, sf), 1000, 7).select("id", *FEATURES)


# --- clustering --------------------------------------------------------------

def _clean_features(spark, sf):
    """The cleaned rows' features, written: scale and use read them without a second dedup."""
    return stored(C.feature_rows(_clean(spark, sf)), "features")


def standardized(spark, sf):
    z = Z.standardize(_clean_features(spark, sf))
    return z.select(*FEATURES, *[round_half_up(f + "_z", 9).alias(f + "_z") for f in FEATURES])


def assign_fixed_centroids(spark, sf):
    return Z.assign_to_centres(_clean_features(spark, sf))


def cluster_summary_fixed(spark, sf):
    return Z.cluster_summary(Z.assign_to_centres(_clean_features(spark, sf)))


def cluster_labels(spark, sf):
    return Z.zone_table(Z.cluster_summary(Z.assign_to_centres(_clean_features(spark, sf))))


def cluster_map_fixed(spark, sf):
    return S.cluster_map_sample(Z.assign_to_centres(_view(spark, sf), keep=["id"]), D.CLUSTER_MAP_N)


def _summary_of(fit):
    return Z.cluster_summary(fit.assigned())


def _fit_batch(spark, sf):
    return Z.fit_zones(_clean(spark, sf))


def _fit_population(spark, sf):
    """Zones of the single-machine twin: population std, 10 restarts, 100 iterations."""
    return Z.fit_zones(_clean(spark, sf), max_iter=100, restarts=10, ddof=0)


def _fit_view(spark, sf):
    """Zones of the dashboard's settings (50 iterations, 10 restarts), fitted on every row of its view."""
    return Z.fit_zones(_view(spark, sf), max_iter=50, restarts=10, ddof=0)


def _zones(fit, shape):
    def q(spark, sf):
        return _from_fit(fit(spark, sf), shape, "zones")
    return q


QUERIES: dict[str, Query] = {
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "json_roundtrip": json_roundtrip,
    "parquet_projected": parquet_projected,
    "normalize_headers": normalize_headers,
    "event_payload": event_payload_q,
    "stream_clean": stream_clean,
    "stream_hourly_cells": stream_hourly_cells,
    "report_bundle": report_bundle_q,
    "report_bundle_read": report_bundle_read,
    "report_values": report_values_q,
    "metric_table_volume": metric_table_volume,
    "metric_table_performance": metric_table_performance,
    "five_v": five_v_q,
    "kpi_tiles": kpi_tiles_q,
    "clean": clean_q,
    "display_clean": display_clean_q,
    "dedup": dedup_q,
    "dedup_null_ids": dedup_null_ids,
    "distinct_rows": distinct_rows_q,
    "range_filter": range_filter_q,
    "filter_bounds": filter_bounds_q,
    "years": years_q,
    "dashboard_view": dashboard_view_q,
    "time_parts": time_parts,
    "mag_class_left": _classed(mag_class_left, "mag"),
    "mag_class_right": _classed(mag_class_right, "mag"),
    "mag_class_six": _classed(mag_class_six, "mag"),
    "depth_class": _classed(depth_class, "depth"),
    "snap_1deg": _snapped(snap_away, 0),
    "snap_1deg_even": _snapped(snap_even, 0),
    "snap_tenth_even": _snapped(snap_even, 1),
    "period_label": period_label_q,
    "coord_label": coord_label_q,
    "display_table": display_table,
    "mag_distribution": mag_distribution_q,
    "mag_distribution_right": mag_distribution_right,
    "mag_share": mag_share_q,
    "depth_distribution": depth_distribution_q,
    "monthly": monthly_q,
    "monthly_known": monthly_known,
    "daily": daily_q,
    "yearly": yearly_q,
    "hotspots_1deg": hotspots_1deg,
    "hotspots_1deg_even": hotspots_1deg_even,
    "hotspots_tenth": hotspots_tenth,
    "global_stats": global_stats_q,
    "kpis": kpis_q,
    "row_count": row_count_q,
    "quality_report": quality_report_q,
    "ingestion_report": ingestion_report_q,
    "ingestion_report_csv": ingestion_report_csv,
    "ingestion_report_failures": ingestion_report_failures,
    "mag_histogram": mag_histogram_q,
    "density_grid": density_grid_q,
    "sample_heatmap": sample_heatmap,
    "sample_scatter_map": sample_scatter_map,
    "sample_depth_mag": sample_depth_mag,
    "sample_cluster_input": sample_cluster_input,
    "sample_small": sample_small,
    "sample_500": _sample_of(500),
    "sample_2000": _sample_of(2000),
    "standardized": standardized,
    "assign_fixed_centroids": assign_fixed_centroids,
    "cluster_summary_fixed": cluster_summary_fixed,
    "cluster_labels": cluster_labels,
    "cluster_map_fixed": cluster_map_fixed,
    "kmeans_summary": _zones(_fit_batch, _summary_of),
    "kmeans_population": _zones(_fit_population, _summary_of),
    "kmeans_sampled": _zones(_fit_view, lambda fit: Z.zone_table(_summary_of(fit))),
    "kmeans_summary_check": _zones(_fit_batch, Z.fit_check),
    "kmeans_population_check": _zones(_fit_population, Z.fit_check),
    "kmeans_view_check": _zones(_fit_view, Z.fit_check),
}
