"""Schemas and fixed column sets of the seismic catalogue.

The catalogue is one flat table with 18 columns, one row per event; ``time``
and ``updated`` stay ISO-8601 text at rest and are parsed by the functions in
:mod:`quakescope.functions.timeparts`.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Catalogue column order and types, as the files carry them.
CATALOG = StructType([
    StructField("time", StringType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("depth", DoubleType(), True),
    StructField("mag", DoubleType(), True),
    StructField("magType", StringType(), True),
    StructField("nst", DoubleType(), True),
    StructField("gap", DoubleType(), True),
    StructField("dmin", DoubleType(), True),
    StructField("rms", DoubleType(), True),
    StructField("net", StringType(), True),
    StructField("id", StringType(), True),
    StructField("updated", StringType(), True),
    StructField("place", StringType(), True),
    StructField("type", StringType(), True),
    StructField("status", StringType(), True),
    StructField("locationSource", StringType(), True),
    StructField("magSource", StringType(), True),
])

CATALOG_COLUMNS = [f.name for f in CATALOG.fields]

# Capitalised header aliases accepted on input, and the columns
# every catalogue file must carry.
HEADER_ALIASES = {
    "Time": "time",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Depth": "depth",
    "Magnitude": "mag",
}
REQUIRED_COLUMNS = ["time", "latitude", "longitude", "depth", "mag"]

# The clustering features and the dedup key.
FEATURES = ["latitude", "longitude", "depth", "mag"]
DEDUP_KEY = ["time", "latitude", "longitude"]

# The event payload sent to the stream topic (11 fields).
PAYLOAD = StructType([
    StructField("time", StringType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("depth", DoubleType(), True),
    StructField("mag", DoubleType(), True),
    StructField("magType", StringType(), True),
    StructField("place", StringType(), True),
    StructField("type", StringType(), True),
    StructField("nst", DoubleType(), True),
    StructField("gap", DoubleType(), True),
    StructField("rms", DoubleType(), True),
])
PAYLOAD_MEASURES = ["depth", "mag", "nst", "gap", "rms"]
# Text used when a payload string column is missing entirely.
PAYLOAD_STRING_DEFAULTS = {"magType": "unknown", "place": "unknown", "type": "earthquake"}

# Topic name of the event stream.
TOPIC = "gempa-stream"

# Report bundle written by the batch job and read by the dashboard.
# Names and types of the report's parts.
PIPELINE_METRICS = StructType([
    StructField("raw_records", LongType(), True),
    StructField("clean_records", LongType(), True),
    StructField("dropped_records", LongType(), True),
    StructField("veracity_pct", DoubleType(), True),
    StructField("ingestion_time_sec", DoubleType(), True),
    StructField("cleaning_time_sec", DoubleType(), True),
    StructField("analytics_time_sec", DoubleType(), True),
    StructField("clustering_time_sec", DoubleType(), True),
    StructField("total_pipeline_latency_sec", DoubleType(), True),
    StructField("throughput_rec_per_sec", DoubleType(), True),
    StructField("spark_cores", IntegerType(), True),
])
GLOBAL_STATS = StructType([
    StructField("total_events", LongType(), True),
    StructField("avg_magnitude", DoubleType(), True),
    StructField("max_magnitude", DoubleType(), True),
    StructField("min_magnitude", DoubleType(), True),
    StructField("std_magnitude", DoubleType(), True),
    StructField("avg_depth_km", DoubleType(), True),
])
MAG_ROW = StructType([
    StructField("mag_category", StringType(), True),
    StructField("jumlah", LongType(), True),
])
TEMPORAL_ROW = StructType([
    StructField("year", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("jumlah", LongType(), True),
    StructField("avg_mag", DoubleType(), True),
    StructField("max_mag", DoubleType(), True),
])
HOTSPOT_ROW = StructType([
    StructField("lat_grid", DoubleType(), True),
    StructField("lon_grid", DoubleType(), True),
    StructField("event_count", LongType(), True),
    StructField("avg_mag", DoubleType(), True),
    StructField("max_mag", DoubleType(), True),
])
CLUSTER_ROW = StructType([
    StructField("cluster", IntegerType(), True),
    StructField("jumlah_event", LongType(), True),
    StructField("center_lat", DoubleType(), True),
    StructField("center_lon", DoubleType(), True),
    StructField("avg_depth", DoubleType(), True),
    StructField("avg_mag", DoubleType(), True),
    StructField("max_mag", DoubleType(), True),
])
REPORT = StructType([
    StructField("pipeline_metrics", PIPELINE_METRICS, True),
    StructField("global_stats", GLOBAL_STATS, True),
    StructField("mag_distribution", ArrayType(MAG_ROW), True),
    StructField("temporal_activity", ArrayType(TEMPORAL_ROW), True),
    StructField("hotspot_grid", ArrayType(HOTSPOT_ROW), True),
    StructField("cluster_summary", ArrayType(CLUSTER_ROW), True),
])
