"""Dashboard feeds: every table the interactive page draws, as DataFrames.

The page's rows are the display rule plus the slider ranges (defaults: the
data's own limits).  ``materialize_view`` writes those rows once to the
shared folder so that the dozen feeds scan a pruned, already-filtered table
instead of re-running the rule per feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.functions.stats import round_half_up
from quakescope.operators import clean as C
from quakescope.operators import clustering as Z
from quakescope.operators import reports as R
from quakescope.operators import sampling as S
from quakescope.sources.sinks import write_parquet

# Sample sizes and seeds of the page's maps and scatter plots,
# and its clustering (10 restarts, 50 iterations; fitted on all rows).
HEATMAP_N, HEATMAP_SEED = 30000, 42
SCATTER_N, SCATTER_SEED = 20000, 1
DEPTH_MAG_N, DEPTH_MAG_SEED = 10000, 42
CLUSTER_MAP_N = 30000
ZONES_K, ZONES_RESTARTS, ZONES_ITER = 6, 10, 50
TOP_CELLS = 20


def view(raw: DataFrame, mag_range=None, depth_range=None, year_range=None) -> DataFrame:
    return C.dashboard_view(C.display_clean(raw), mag_range, depth_range, year_range)


def materialize_view(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    write_parquet(rows, path)
    return spark.read.parquet(path).select(*rows.columns)


def feeds(rows: DataFrame, with_zones: bool = True) -> dict[str, DataFrame]:
    """All feeds over the page's rows (lazy, except bounds/samples' cut points)."""
    out = {
        "kpis": R.kpis(rows),
        "daily": R.daily(rows),
        "monthly": R.monthly(rows, keep_unknown=False),
        "yearly": R.yearly(rows),
        "mag_histogram": R.mag_histogram(rows),
        "mag_share": R.mag_share(rows, "mag_category"),
        "depth_distribution": R.depth_distribution(rows),
        "hotspots": R.hotspots(rows, TOP_CELLS, decimals=1, ties="even"),
        "density_grid": R.density_grid(rows),
        "heatmap_sample": S.heatmap_sample(rows, HEATMAP_N, HEATMAP_SEED),
        "scatter_map_sample": S.scatter_map_sample(rows, SCATTER_N, SCATTER_SEED),
        "depth_mag_sample": S.depth_mag_sample(rows, DEPTH_MAG_N, DEPTH_MAG_SEED),
    }
    if with_zones and not rows.isEmpty():  # nothing to cluster in an empty view
        fit = Z.fit_zones(rows, k=ZONES_K, max_iter=ZONES_ITER, restarts=ZONES_RESTARTS, ddof=0)
        out["zones"] = Z.zone_table(Z.cluster_summary(fit.assigned()))
        out["cluster_map_sample"] = S.cluster_map_sample(
            fit.assign(rows, keep=["id"]).select("id", "latitude", "longitude", "cluster"), CLUSTER_MAP_N)
    return out


def run_dashboard(spark: SparkSession, raw: DataFrame, out_dir: str, with_zones: bool = True,
                  report_path: str | None = None, **ranges) -> dict[str, str]:
    """Write every feed as Parquet under ``out_dir``; returns feed → path.

    With ``report_path`` (the batch job's report bundle; absent → empty) the
    metric tables and header tiles are written too.
    """
    rows = materialize_view(spark, view(raw, **ranges), f"{out_dir.rstrip('/')}/view.parquet")
    paths = {}
    all_feeds = feeds(rows, with_zones)
    if report_path is not None:
        from quakescope.sources.report import read_report

        bundle = read_report(spark, report_path)
        all_feeds["kpi_tiles"] = kpi_tiles(rows, bundle)
        for name, table in metric_tables(bundle).items():
            all_feeds[f"metrics_{name}"] = table
    for name, df in all_feeds.items():
        path = f"{out_dir.rstrip('/')}/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


# --- tables built from the report bundle --------------------------------------

# Row labels and units of the page's two metric tables.
VOLUME_ROWS = [
    ("Total Data Mentah (Raw)", "raw_records", "count", "records"),
    ("Data Bersih (Lolos Filter)", "clean_records", "count", "records"),
    ("Anomali Dibuang (Veracity)", "dropped_records", "count", "records"),
    ("Persentase Data Valid", "veracity_pct", "valid_pct", "%"),
]
PERFORMANCE_ROWS = [
    ("Waktu Ingestion", "ingestion_time_sec", "sec4", "detik"),
    ("Waktu Cleaning / Veracity", "cleaning_time_sec", "sec4", "detik"),
    ("Waktu Analytics (Spark)", "analytics_time_sec", "sec4", "detik"),
    ("Waktu Clustering (MLlib)", "clustering_time_sec", "sec4", "detik"),
    ("TOTAL LATENCY PIPELINE", "total_pipeline_latency_sec", "sec4", "detik"),
    ("THROUGHPUT SISTEM", "throughput_rec_per_sec", "grouped2", "rec/detik"),
    ("Spark Parallelism (Cores)", "spark_cores", "text", ""),
]


def _metric_text(col, kind: str, unit: str):
    if kind == "count":
        txt = F.format_number(col.cast("double"), 0)
    elif kind == "valid_pct":
        return F.format_string("%.2f%%", F.lit(100.0) - F.coalesce(col, F.lit(0.0)))
    elif kind == "sec4":
        txt = F.when(col.isNotNull(), F.format_string("%.4f", col))
    elif kind == "grouped2":
        txt = F.format_number(col, 2)
    else:
        return F.coalesce(col.cast("string"), F.lit("-"))
    return F.concat_ws(" ", F.coalesce(txt, F.lit("-")), F.lit(unit))


def metric_tables(bundle: DataFrame) -> dict[str, DataFrame]:
    """The page's two (Metrik, Nilai) tables from the report bundle (one row in)."""
    out = {}
    for name, spec in (("volume", VOLUME_ROWS), ("performance", PERFORMANCE_ROWS)):
        rows = [F.struct(F.lit(i).alias("i"), F.lit(label).alias("Metrik"),
                         _metric_text(F.col(f"pipeline_metrics.{field}"), kind, unit).alias("Nilai"))
                for i, (label, field, kind, unit) in enumerate(spec)]
        out[name] = (bundle.select(F.explode(F.array(*rows)).alias("r"))
                     .select("r.*").orderBy("i").drop("i"))
    return out


def kpi_tiles(rows: DataFrame, bundle: DataFrame) -> DataFrame:
    """Header tiles: rows in view and their largest magnitude, with the bundle's
    throughput, latency, valid share and raw volume (one row; no join)."""
    view_part = rows.agg(F.count(F.lit(1)).alias("total_record"), F.max("mag").alias("max_mag"))
    m = "pipeline_metrics"
    report_part = bundle.select(
        F.col(f"{m}.throughput_rec_per_sec").alias("throughput_rec_per_sec"),
        F.col(f"{m}.total_pipeline_latency_sec").alias("latency_sec"),
        (F.lit(100.0) - F.coalesce(F.col(f"{m}.veracity_pct"), F.lit(0.0))).alias("valid_pct"),
        F.col(f"{m}.raw_records").alias("raw_records"))
    stacked = view_part.unionByName(report_part, allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    return folded.select(
        "total_record", F.coalesce("throughput_rec_per_sec", F.lit(0.0)).alias("throughput_rec_per_sec"),
        F.coalesce("latency_sec", F.lit(0.0)).alias("latency_sec"),
        F.when(F.col("max_mag").isNull(), F.lit("–"))
        .otherwise(F.format_string("%.1f", round_half_up("max_mag", 1))).alias("max_mag_text"),
        "max_mag", F.coalesce("valid_pct", F.lit(100.0)).alias("valid_pct"),
        F.coalesce("raw_records", "total_record").alias("raw_records"))


def five_v(rows: DataFrame, bundle: DataFrame) -> DataFrame:
    """Values of the page's volume, velocity and veracity cards (Dimensi, Nilai); absent metrics read 0."""
    tiles = kpi_tiles(rows, bundle)
    dropped = bundle.select(F.lit("dropped").alias("k"), F.col("pipeline_metrics.dropped_records").cast("bigint").alias("v"))
    count = lambda c: F.format_number(F.col(c).cast("double"), 0)
    cards = [("VOLUME", F.concat(count("total_record"), F.lit(" records"))), ("RAW", count("raw_records")),
             ("VELOCITY", F.concat(count("throughput_rec_per_sec"), F.lit(" rec/detik"))),
             ("VERACITY", F.format_string("%.1f%% valid", round_half_up("valid_pct", 1)))]
    shown = tiles.select(F.explode(F.array(*[F.struct(F.lit(k).alias("Dimensi"), v.alias("Nilai")) for k, v in cards])).alias("r")).select("r.*")
    lost = dropped.agg(F.coalesce(F.max("v"), F.lit(0)).alias("v"))
    return shown.unionByName(lost.select(F.lit("ANOMALI").alias("Dimensi"), F.concat(count("v"), F.lit(" anomali dibuang")).alias("Nilai")))
