"""Independent SQL forms of the registered queries (DuckDB dialect).

Each string is self-contained: it rebuilds the ``quakes`` catalogue from the
``events`` view, then applies the rule in plain SQL.  Means are written as
``CAST(SUM(CAST(x AS DECIMAL(18,6))) AS DOUBLE) / COUNT(x)`` and display
rounding goes through ``DECIMAL(38,12)``, the same exact forms the library
uses, so both engines give bit-equal doubles.
"""

from __future__ import annotations

from quakescope.functions.classes import (
    DEPTH_EDGES,
    DEPTH_LABELS,
    MAG5_EDGES,
    MAG5_LABELS,
    MAG6_EDGES,
    MAG6_LABELS,
)
from quakescope.functions.labels import CLUSTER_COLOR_FALLBACK, CLUSTER_COLORS, CLUSTER_LABELS
from quakescope.operators.clustering import PUBLISHED_CENTRES
from quakescope.plans.registry import RANGE_DEPTH, RANGE_MAG, RANGE_YEAR
from quakescope.sources.fixture import QUAKES_SQL

CAT = ["time", "latitude", "longitude", "depth", "mag", "magType", "nst", "gap", "dmin", "rms",
       "net", "id", "updated", "place", "type", "status", "locationSource", "magSource"]


def _case(col: str, edges, labels, right: bool) -> str:
    op = "<=" if right else "<"
    parts = [f"WHEN {col} {op} {e} THEN '{lab}'" for e, lab in zip(edges, labels)]
    return f"CASE {' '.join(parts)} WHEN {col} IS NOT NULL THEN '{labels[-1]}' END"


def mean(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({x})"


def rnd(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}))"


TS = "TRY_CAST(time AS TIMESTAMP)"
MAG5_LEFT = _case("mag", MAG5_EDGES, MAG5_LABELS, right=False)
MAG5_RIGHT = _case("mag", MAG5_EDGES, MAG5_LABELS, right=True)
MAG6 = _case("mag", MAG6_EDGES, MAG6_LABELS, right=True)
DEPTH = _case("depth", DEPTH_EDGES, DEPTH_LABELS, right=True)

RULE = (f"type = 'earthquake' AND {present('mag')} AND {present('latitude')} AND "
        f"{present('longitude')} AND {present('depth')} AND mag >= 0 AND depth >= 0 AND rms <= 2.0")

CTES = QUAKES_SQL + f""",
clean_rows AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY time, latitude, longitude ORDER BY id NULLS FIRST) AS _rn
    FROM quakes WHERE {RULE}) WHERE _rn = 1
), clean AS (
  SELECT *, CAST(year({TS}) AS INTEGER) AS year, CAST(month({TS}) AS INTEGER) AS month,
         CAST(hour({TS}) AS INTEGER) AS hour, {MAG5_LEFT} AS mag_category, {DEPTH} AS depth_category
  FROM clean_rows
), display AS (
  SELECT *, CAST(year({TS}) AS INTEGER) AS year, CAST(month({TS}) AS INTEGER) AS month,
         CAST(CAST({TS} AS DATE) AS TIMESTAMP) AS day, {MAG6} AS mag_category, {DEPTH} AS depth_category
  FROM quakes
  WHERE {present('latitude')} AND {present('longitude')} AND {present('mag')} AND {present('depth')}
    AND mag >= 0
), bounds AS (
  SELECT min(mag) AS mag_lo, max(mag) AS mag_hi, min(depth) AS depth_lo,
         least(max(depth), 700.0) AS depth_hi, min(year) AS year_lo, max(year) AS year_hi
  FROM display
), dview AS (
  SELECT display.* FROM display, bounds
  WHERE mag BETWEEN mag_lo AND mag_hi AND depth BETWEEN depth_lo AND depth_hi
    AND (year_lo IS NULL OR year BETWEEN year_lo AND year_hi)
)"""


def _with(body: str) -> str:
    """The shared CTEs, then a query."""
    return f"WITH {CTES}\n{body}"


def _with_more(ctes_and_body: str) -> str:
    """The shared CTEs, more CTEs of this query (``name AS (...)``), then its query."""
    return f"WITH {CTES},\n{ctes_and_body}"


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _assign_sql(source: str, keep: str = "") -> str:
    feats = ["latitude", "longitude", "depth", "mag"]
    sd = ", ".join(f"stddev_samp({f}) AS sd_{f}" for f in feats)
    dists = []
    for i, centre in enumerate(PUBLISHED_CENTRES):
        terms = []
        for f, c in zip(feats, centre):
            t = f"(({f} - {_dbl(c)}) / sd_{f})"
            terms.append(f"{t} * {t}")
        dists.append(f"{' + '.join(terms)} AS d{i}")
    n = len(PUBLISHED_CENTRES)
    best = "least(" + ", ".join(f"d{i}" for i in range(n)) + ")"
    case = "CASE " + " ".join(f"WHEN d{i} = {best} THEN {i}" for i in range(n)) + " END"
    keep_sel = f"{keep}, " if keep else ""
    return f"""feats AS (
  SELECT {keep_sel}latitude, longitude, depth, mag FROM {source}
  WHERE {present('latitude')} AND {present('longitude')} AND {present('depth')} AND {present('mag')}
), sds AS (SELECT {sd} FROM feats),
dist AS (SELECT feats.*, {', '.join(dists)} FROM feats, sds),
assigned AS (SELECT {keep_sel}latitude, longitude, depth, mag, CAST({case} AS INTEGER) AS cluster FROM dist)"""


def _summary(src: str) -> str:
    return f"""SELECT cluster, count(*) AS jumlah_event, {mean('latitude')} AS center_lat,
  {mean('longitude')} AS center_lon, {mean('depth')} AS avg_depth, {mean('mag')} AS avg_mag,
  max(mag) AS max_mag FROM {src} GROUP BY cluster"""


def _label_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} = {i} THEN '{lab}'" for i, lab in enumerate(CLUSTER_LABELS))
    return f"CASE {parts} ELSE concat('Cluster ', CAST({col} AS VARCHAR)) END"


def _color_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} = {i} THEN '{c}'" for i, c in enumerate(CLUSTER_COLORS))
    return f"CASE {parts} ELSE '{CLUSTER_COLOR_FALLBACK}' END"


def _bottom_k(src: str, n: int, seed: int, cols: str) -> str:
    return (f"SELECT {cols} FROM {src} "
            f"ORDER BY md5(concat(coalesce(CAST(id AS VARCHAR), ''), '#{seed}')), id NULLS FIRST LIMIT {n}")


def _hot(src: str, snap_lat: str, snap_lon: str, k: int) -> str:
    return f"""cells AS (
  SELECT {snap_lat} AS lat_grid, {snap_lon} AS lon_grid, count(*) AS event_count,
         {mean('mag')} AS avg_mag, max(mag) AS max_mag
  FROM {src} GROUP BY 1, 2
), top AS (SELECT * FROM cells ORDER BY event_count DESC, lat_grid, lon_grid LIMIT {k})"""


AWAY = "round({c}, 0) + 0.0"
EVEN0 = "round_even({c}, 0) + 0.0"
EVEN1 = "round_even({c} * 10.0, 0) / 10.0 + 0.0"

ALL = ", ".join(CAT)
CLEAN_ALL = ALL + ", year, month, hour, mag_category, depth_category"

HIST = f"""SELECT bin, lo + (bin - 1) * (hi - lo) / 50 AS bin_lo, lo + bin * (hi - lo) / 50 AS bin_hi,
  count(*) AS jumlah FROM (
  SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((mag - lo) * 50 / (hi - lo)) + 1, 50) END AS INTEGER) AS bin,
         lo, hi
  FROM (SELECT * FROM dview WHERE mag IS NOT NULL AND NOT isnan(mag)) v,
       (SELECT min(mag) AS lo, max(mag) AS hi FROM dview WHERE mag IS NOT NULL AND NOT isnan(mag)) b
) GROUP BY bin, lo, hi"""


ORACLE: dict[str, str] = {
    "csv_roundtrip": _with(f"SELECT {ALL} FROM quakes"),
    "parquet_roundtrip": _with(f"SELECT {CLEAN_ALL} FROM clean"),
    "json_roundtrip": _with(f"SELECT {ALL} FROM quakes"),
    "parquet_projected": _with(_bottom_k(
        "clean", 50000, 0, "latitude, longitude, depth, mag, mag_category, depth_category, year, month")),
    "normalize_headers": _with(f"SELECT {ALL} FROM quakes"),
    "event_payload": _with(
        "SELECT coalesce(time, 'nan') AS time, latitude, longitude, coalesce(depth, 0.0) AS depth, "
        "coalesce(mag, 0.0) AS mag, coalesce(magType, 'nan') AS magType, "
        "coalesce(place, 'nan') AS place, coalesce(type, 'nan') AS type, "
        "coalesce(nst, 0.0) AS nst, coalesce(gap, 0.0) AS gap, coalesce(rms, 0.0) AS rms FROM quakes"),
    "metric_table_volume": _with_more(f"""counts AS (
  SELECT (SELECT count(*) FROM quakes) AS raw_n, (SELECT count(*) FROM clean_rows) AS clean_n
), pct AS (
  SELECT raw_n, clean_n, raw_n - clean_n AS drop_n,
         {rnd('CAST(raw_n - clean_n AS DOUBLE) / CAST(raw_n AS DOUBLE) * 100.0', 2)} AS veracity
  FROM counts
)
SELECT 'Total Data Mentah (Raw)' AS "Metrik", format('{{:,}} records', raw_n) AS "Nilai" FROM pct
UNION ALL SELECT 'Data Bersih (Lolos Filter)', format('{{:,}} records', clean_n) FROM pct
UNION ALL SELECT 'Anomali Dibuang (Veracity)', format('{{:,}} records', drop_n) FROM pct
UNION ALL SELECT 'Persentase Data Valid', printf('%.2f%%', 100.0 - veracity) FROM pct"""),
    "kpi_tiles": _with(f"""SELECT v.total_record, CAST(0.0 AS DOUBLE) AS throughput_rec_per_sec,
  CAST(0.0 AS DOUBLE) AS latency_sec,
  CASE WHEN v.max_mag IS NULL THEN '–' ELSE printf('%.1f', {rnd('v.max_mag', 1)}) END AS max_mag_text,
  v.max_mag, 100.0 - {rnd('CAST(c.raw_n - c.clean_n AS DOUBLE) / CAST(c.raw_n AS DOUBLE) * 100.0', 2)} AS valid_pct,
  c.raw_n AS raw_records
FROM (SELECT count(*) AS total_record, max(mag) AS max_mag FROM dview) v,
     (SELECT (SELECT count(*) FROM quakes) AS raw_n, (SELECT count(*) FROM clean_rows) AS clean_n) c"""),
    "stream_clean": _with(f"""SELECT DISTINCT time, latitude, longitude,
  CAST(year({TS}) AS INTEGER) AS year, CAST(month({TS}) AS INTEGER) AS month
FROM (SELECT coalesce(time, 'nan') AS time, latitude, longitude, coalesce(depth, 0.0) AS depth,
             coalesce(mag, 0.0) AS mag, coalesce(rms, 0.0) AS rms, coalesce(type, 'nan') AS type
      FROM quakes)
WHERE {RULE}"""),
    "stream_hourly_cells": _with_more(f"""feed AS (
  SELECT DISTINCT time, latitude, longitude, mag, {TS} AS et
  FROM (SELECT coalesce(time, 'nan') AS time, latitude, longitude, coalesce(depth, 0.0) AS depth,
               coalesce(mag, 0.0) AS mag, coalesce(rms, 0.0) AS rms, coalesce(type, 'nan') AS type
        FROM quakes)
  WHERE {RULE} AND {TS} IS NOT NULL
), w AS (
  SELECT date_trunc('hour', et) AS window_start, date_trunc('hour', et) + INTERVAL 1 HOUR AS window_end,
         round(latitude, 0) + 0.0 AS lat_grid, round(longitude, 0) + 0.0 AS lon_grid, mag
  FROM feed
)
SELECT window_start, window_end, lat_grid, lon_grid, count(*) AS event_count,
       {mean('mag')} AS avg_mag, max(mag) AS max_mag
FROM w
GROUP BY window_start, window_end, lat_grid, lon_grid"""),
    "clean": _with(f"SELECT {CLEAN_ALL} FROM clean"),
    "display_clean": _with(f"SELECT {ALL}, year, month, day, mag_category, depth_category FROM display"),
    "dedup": _with(f"""SELECT {ALL} FROM (
  SELECT *, row_number() OVER (PARTITION BY time, latitude, longitude ORDER BY id NULLS FIRST) AS _rn
  FROM quakes) WHERE _rn = 1"""),
    "dedup_null_ids": _with("""SELECT time, latitude, longitude, id, mag, depth, rms, type FROM (
  SELECT *, row_number() OVER (PARTITION BY time, latitude, longitude
    ORDER BY id NULLS FIRST, mag NULLS FIRST, depth NULLS FIRST, rms NULLS FIRST, type NULLS FIRST) AS _rn
  FROM (SELECT substr(time, 1, 10) AS time, round(latitude, 0) + 0.0 AS latitude, round(longitude, 0) + 0.0 AS longitude,
    CASE WHEN coalesce(CAST(round(mag * 10, 0) AS BIGINT) % 3 = 0, TRUE) THEN NULL ELSE id END AS id, mag, depth, rms, type
    FROM quakes)) WHERE _rn = 1"""),
    "distinct_rows": _with(
        "SELECT DISTINCT latitude, longitude, depth, mag, magType, nst, gap, dmin, rms, net, updated, "
        f"place, type, status, locationSource, magSource FROM quakes WHERE {RULE}"),
    "range_filter": _with(
        f"SELECT {ALL}, year, month, day, mag_category, depth_category FROM display "
        f"WHERE mag BETWEEN {RANGE_MAG[0]} AND {RANGE_MAG[1]} "
        f"AND depth BETWEEN {RANGE_DEPTH[0]} AND {RANGE_DEPTH[1]} "
        f"AND year BETWEEN {RANGE_YEAR[0]} AND {RANGE_YEAR[1]}"),
    "filter_bounds": _with(
        "SELECT min(mag) AS mag_min, max(mag) AS mag_max, min(depth) AS depth_min, "
        "least(max(depth), 700.0) AS depth_max, min(year) AS year_min, max(year) AS year_max, "
        "CAST(count(DISTINCT year) AS INTEGER) AS n_years FROM display"),
    "years": _with("SELECT DISTINCT year FROM display WHERE year IS NOT NULL"),
    "dashboard_view": _with(f"SELECT {ALL}, year, month, day, mag_category, depth_category FROM dview"),
    "time_parts": _with(
        f"SELECT id, time, CAST(year({TS}) AS INTEGER) AS year, CAST(month({TS}) AS INTEGER) AS month, "
        f"CAST(hour({TS}) AS INTEGER) AS hour, CAST(CAST({TS} AS DATE) AS TIMESTAMP) AS day FROM quakes"),
    "mag_class_left": _with(f"SELECT id, mag, {MAG5_LEFT} AS category FROM quakes"),
    "mag_class_right": _with(f"SELECT id, mag, {MAG5_RIGHT} AS category FROM quakes"),
    "mag_class_six": _with(f"SELECT id, mag, {MAG6} AS category FROM quakes"),
    "depth_class": _with(f"SELECT id, depth, {DEPTH} AS category FROM quakes"),
    "snap_1deg": _with(
        f"SELECT id, latitude, longitude, {AWAY.format(c='latitude')} AS lat_grid, "
        f"{AWAY.format(c='longitude')} AS lon_grid FROM quakes"),
    "snap_1deg_even": _with(
        f"SELECT id, latitude, longitude, {EVEN0.format(c='latitude')} AS lat_grid, "
        f"{EVEN0.format(c='longitude')} AS lon_grid FROM quakes"),
    "snap_tenth_even": _with(
        f"SELECT id, latitude, longitude, {EVEN1.format(c='latitude')} AS lat_grid, "
        f"{EVEN1.format(c='longitude')} AS lon_grid FROM quakes"),
    "period_label": _with(
        "SELECT year, month, count(*) AS jumlah, "
        "CASE WHEN year IS NULL THEN '' ELSE printf('%d-%02d', year, month) END AS period "
        "FROM dview WHERE year IS NOT NULL GROUP BY year, month"),
    "mag_distribution": _with("SELECT mag_category, count(*) AS jumlah FROM clean GROUP BY mag_category"),
    "mag_distribution_right": _with(
        f"SELECT {MAG5_RIGHT} AS mag_category, count(*) AS jumlah FROM clean_rows GROUP BY 1"),
    "mag_share": _with(
        "SELECT mag_category, jumlah, CAST(jumlah AS DOUBLE) / CAST(sum(jumlah) OVER () AS DOUBLE) AS share "
        "FROM (SELECT mag_category, count(*) AS jumlah FROM dview GROUP BY mag_category)"),
    "depth_distribution": _with(
        "SELECT depth_category, count(*) AS jumlah FROM dview GROUP BY depth_category"),
    "monthly": _with(
        f"SELECT year, month, count(*) AS jumlah, {mean('mag')} AS avg_mag, max(mag) AS max_mag "
        "FROM clean GROUP BY year, month"),
    "monthly_known": _with(
        f"SELECT year, month, count(*) AS jumlah, {mean('mag')} AS avg_mag, max(mag) AS max_mag "
        "FROM dview WHERE year IS NOT NULL GROUP BY year, month"),
    "daily": _with(
        f"SELECT day, count(*) AS jumlah, {mean('mag')} AS avg_mag FROM dview "
        "WHERE day IS NOT NULL GROUP BY day"),
    "yearly": _with(
        f"SELECT year, count(*) AS jumlah, {mean('mag')} AS avg_mag, max(mag) AS max_mag "
        "FROM dview WHERE year IS NOT NULL GROUP BY year"),
    "global_stats": _with(
        f"SELECT count(*) AS total_events, {rnd(mean('mag'), 3)} AS avg_magnitude, "
        f"{rnd('max(mag)', 3)} AS max_magnitude, {rnd('min(mag)', 3)} AS min_magnitude, "
        f"{rnd('stddev_samp(mag)', 3)} AS std_magnitude, {rnd(mean('depth'), 2)} AS avg_depth_km "
        "FROM clean"),
    "kpis": _with("SELECT count(*) AS total_record, max(mag) AS max_mag FROM dview"),
    "row_count": _with("SELECT count(*) AS n FROM quakes"),
    "quality_report": _with(f"""SELECT raw_records, clean_records, raw_records - clean_records AS dropped_records,
  {rnd('CAST(raw_records - clean_records AS DOUBLE) / CAST(raw_records AS DOUBLE) * 100.0', 2)} AS veracity_pct,
  100.0 - {rnd('CAST(raw_records - clean_records AS DOUBLE) / CAST(raw_records AS DOUBLE) * 100.0', 2)} AS valid_pct
FROM (SELECT (SELECT count(*) FROM quakes) AS raw_records, (SELECT count(*) FROM clean_rows) AS clean_records)"""),
    "ingestion_report": _with(
        "SELECT count(*) AS total_records, count(*) AS success_count, CAST(0 AS BIGINT) AS fail_count, "
        f"CAST(0.0 AS DOUBLE) AS data_loss_pct, {rnd('CAST(count(*) AS DOUBLE) * 200.0 / 1048576.0', 2)} AS estimated_mb "
        "FROM quakes"),
    "ingestion_report_csv": _with(
        "SELECT count(*) AS total_records, count(*) AS success_count, CAST(0 AS BIGINT) AS fail_count, "
        f"CAST(0.0 AS DOUBLE) AS data_loss_pct, {rnd('CAST(count(*) AS DOUBLE) * 200.0 / 1048576.0', 2)} AS estimated_mb "
        "FROM quakes"),
    "mag_histogram": _with(HIST),
    "density_grid": _with(
        f"SELECT {EVEN1.format(c='latitude')} AS lat_grid, {EVEN1.format(c='longitude')} AS lon_grid, "
        "count(*) AS event_count, CAST(sum(CAST(mag AS DECIMAL(18,6))) AS DOUBLE) AS mag_weight "
        "FROM dview GROUP BY 1, 2"),
    "sample_heatmap": _with(_bottom_k("dview", 30000, 42, "latitude, longitude, mag")),
    "sample_scatter_map": _with(_bottom_k("dview", 20000, 1, "latitude, longitude, mag, depth, place")),
    "sample_depth_mag": _with(_bottom_k("dview", 10000, 42, "depth, mag, mag_category")),
    "sample_cluster_input": _with(_bottom_k("dview", 100000, 42, "latitude, longitude, depth, mag")),
    "sample_500": _with(_bottom_k("dview", 500, 42, "id, latitude, longitude, depth, mag")),
    "sample_2000": _with(_bottom_k("dview", 2000, 42, "id, latitude, longitude, depth, mag")),
    "sample_small": _with(_bottom_k("dview", 1000, 7, "id, latitude, longitude, depth, mag")),
    "standardized": _with(
        "SELECT latitude, longitude, depth, mag, "
        + ", ".join(
            f"{rnd(f'({f} - m_{f}) / s_{f}', 9)} AS {f}_z" for f in ["latitude", "longitude", "depth", "mag"])
        + " FROM (SELECT latitude, longitude, depth, mag FROM clean) r, (SELECT "
        + ", ".join(f"{mean(f)} AS m_{f}, stddev_samp({f}) AS s_{f}"
                    for f in ["latitude", "longitude", "depth", "mag"])
        + " FROM clean) s"),
}

ORACLE["hotspots_1deg"] = _with_more(_hot(
    "clean", AWAY.format(c="latitude"), AWAY.format(c="longitude"), 200) + "\nSELECT * FROM top")
ORACLE["hotspots_1deg_even"] = _with_more(_hot(
    "clean", EVEN0.format(c="latitude"), EVEN0.format(c="longitude"), 200) + "\nSELECT * FROM top")
ORACLE["hotspots_tenth"] = _with_more(_hot(
    "dview", EVEN1.format(c="latitude"), EVEN1.format(c="longitude"), 20) + "\nSELECT * FROM top")
ORACLE["coord_label"] = _with_more(_hot(
    "dview", EVEN1.format(c="latitude"), EVEN1.format(c="longitude"), 20)
    + "\nSELECT lat_grid, lon_grid, printf('%.1f°, %.1f°', lat_grid, lon_grid) AS label FROM top")
ORACLE["display_table"] = _with_more(_hot(
    "dview", EVEN1.format(c="latitude"), EVEN1.format(c="longitude"), 20)
    + f"\nSELECT lat_grid AS \"Lat\", lon_grid AS \"Lon\", event_count AS \"Event\", "
    f"{rnd('avg_mag', 2)} AS \"Avg Mag\", {rnd('max_mag', 2)} AS \"Max Mag\" FROM top")
ORACLE["assign_fixed_centroids"] = _with_more(
    _assign_sql("clean") + "\nSELECT latitude, longitude, depth, mag, cluster FROM assigned")
ORACLE["cluster_summary_fixed"] = _with_more(_assign_sql("clean") + "\n" + _summary("assigned"))
ORACLE["cluster_labels"] = _with_more(_assign_sql("clean") + f""",
summ AS ({_summary('assigned')})
SELECT {_label_case('cluster')} AS "Zona", jumlah_event AS "Jumlah Event",
  printf('%.1f°, %.1f°', {rnd('center_lat', 1)}, {rnd('center_lon', 1)}) AS "Pusat (Lat, Lon)",
  {rnd('avg_depth', 1)} AS "Avg Kedalaman (km)", {rnd('avg_mag', 2)} AS "Avg Mag",
  {rnd('max_mag', 2)} AS "Max Mag" FROM summ""")
ORACLE["cluster_map_fixed"] = _with_more(
    _assign_sql("dview", keep="id")
    + f"\nSELECT latitude, longitude, {_label_case('cluster')} AS cluster_label, "
    f"{_color_case('cluster')} AS color FROM ("
    + _bottom_k("assigned", 30000, 42, "latitude, longitude, cluster") + ")")

_COUNTS = f"""counts AS (
  SELECT (SELECT count(*) FROM quakes) AS raw_n, (SELECT count(*) FROM clean_rows) AS clean_n
), pct AS (
  SELECT *, raw_n - clean_n AS drop_n, {rnd('CAST(raw_n - clean_n AS DOUBLE) / CAST(raw_n AS DOUBLE) * 100.0', 2)} AS veracity
  FROM counts
)"""
ORACLE["metric_table_performance"] = _with_more(f"""{_COUNTS}, t AS (SELECT round(clean_n / 8.0, 2) AS rate FROM pct)
SELECT 'Waktu Ingestion' AS "Metrik", '1.5000 detik' AS "Nilai" UNION ALL SELECT 'Waktu Cleaning / Veracity', '2.2500 detik'
UNION ALL SELECT 'Waktu Analytics (Spark)', '0.1250 detik' UNION ALL SELECT 'Waktu Clustering (MLlib)', '4.0000 detik'
UNION ALL SELECT 'TOTAL LATENCY PIPELINE', '8.0000 detik'
UNION ALL SELECT 'THROUGHPUT SISTEM', format('{{:,.2f}} rec/detik', rate::DOUBLE) FROM t
UNION ALL SELECT 'Spark Parallelism (Cores)', '8'""")
ORACLE["five_v"] = _with_more(f"""{_COUNTS}
SELECT 'VOLUME' AS "Dimensi", format('{{:,}} records', (SELECT count(*) FROM dview)) AS "Nilai"
UNION ALL SELECT 'RAW', format('{{:,}}', raw_n) FROM pct
UNION ALL SELECT 'VELOCITY', format('{{:,}} rec/detik', CAST(round_even(clean_n / 8.0, 0) AS BIGINT)) FROM pct
UNION ALL SELECT 'VERACITY', printf('%.1f%% valid', {rnd('100.0 - veracity', 1)}) FROM pct
UNION ALL SELECT 'ANOMALI', format('{{:,}} anomali dibuang', drop_n) FROM pct""")


def _fields(section: str, item: str, source: str, fields: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{section}', concat({item}, ' {f}'), CAST(coalesce({f}, 0) AS DOUBLE) FROM {source}" for f in fields)


def _scalars(section: str, source: str, fields: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{section}', '{f}', CAST({x} AS DOUBLE) FROM {source}" for f, x in fields.items())


ORACLE["report_values"] = _with_more(
    f"""{_COUNTS}, mags AS (SELECT mag_category, count(*) AS jumlah FROM clean GROUP BY mag_category),
months AS (SELECT coalesce(year, 0) AS y, coalesce(month, 0) AS m, count(*) AS jumlah, {mean('mag')} AS avg_mag, max(mag) AS max_mag
  FROM clean GROUP BY year, month),
stats AS (SELECT count(*) AS total_events, {rnd(mean('mag'), 3)} AS avg_magnitude, {rnd('max(mag)', 3)} AS max_magnitude,
  {rnd('min(mag)', 3)} AS min_magnitude, {rnd('stddev_samp(mag)', 3)} AS std_magnitude, {rnd(mean('depth'), 2)} AS avg_depth_km FROM clean),
"""
    + _hot("clean", AWAY.format(c="latitude"), AWAY.format(c="longitude"), 200) + ",\n" + _assign_sql("clean")
    + f", summ AS ({_summary('assigned')}), out(section, item, value) AS (\n"
    + _scalars("pipeline_metrics", "pct", {"raw_records": "raw_n", "clean_records": "clean_n", "dropped_records": "drop_n", "veracity_pct": "veracity"})
    + "\nUNION ALL " + _scalars("global_stats", "stats", {f: f for f in ("total_events", "avg_magnitude", "max_magnitude", "min_magnitude", "std_magnitude", "avg_depth_km")})
    + "\nUNION ALL " + _fields("mag_distribution", "mag_category", "mags", ["jumlah"])
    + "\nUNION ALL " + _fields("temporal_activity", "concat(y, '-', m)", "months", ["jumlah", "avg_mag", "max_mag"])
    + "\nUNION ALL " + _fields("hotspot_grid", "concat(CAST(lat_grid AS INTEGER), ',', CAST(lon_grid AS INTEGER))", "top", ["event_count", "avg_mag", "max_mag"])
    + "\nUNION ALL " + _fields("cluster_summary", "cluster", "summ", ["jumlah_event", "center_lat", "center_lon", "avg_depth", "avg_mag", "max_mag"])
    + ")\nSELECT * FROM out")


def _fit_facts(source: str) -> str:
    """What any six-zone fit over the rows must give (see ``fit_check``)."""
    sums = ", ".join(f"CAST(sum(CAST({f} AS DECIMAL(18,6))) AS DOUBLE) AS sum_{f}" for f in ["latitude", "longitude", "depth", "mag"])
    return _with(f"SELECT CAST(6 AS BIGINT) AS zones, count(*) AS events, {sums}, CAST(0 AS BIGINT) AS not_nearest, TRUE AS cost_ok FROM {source}")


ORACLE["kmeans_summary_check"] = _fit_facts("clean")
ORACLE["kmeans_population_check"] = _fit_facts("clean")
ORACLE["kmeans_view_check"] = _fit_facts("dview")

ORACLE["ingestion_report_failures"] = _with_more(f"""bad AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE CAST(round(mag * 10, 0) AS BIGINT) % 7 = 0) AS f FROM quakes
)
SELECT n AS total_records, n - f AS success_count, f AS fail_count,
  CAST(f AS DOUBLE) / CAST(n AS DOUBLE) * 100.0 AS data_loss_pct,
  {rnd('CAST(n - f AS DOUBLE) * 200.0 / 1048576.0', 2)} AS estimated_mb FROM bad""")
