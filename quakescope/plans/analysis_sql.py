"""SQL forms (DuckDB dialect) of the queries in ``analysis``."""

from __future__ import annotations

from itertools import combinations

from quakescope.operators.smoothing import kernel
from quakescope.plans.analysis import BOX_LAT, BOX_LON, CENTRE_SETS, FITTED_K, HALF_SIDE, MONTHS_AHEAD, NAMED_BOXES, STRONG_MAG
from quakescope.plans.oracle import ALL, _assign_sql, _dbl, _with, _with_more, mean, present, rnd
from quakescope.schema import FEATURES


def _silhouettes() -> str:
    """One row per set of centres, from the rows' distances to every zone's mean."""
    stats = ", ".join(f"{mean(f)} AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)
    ctes = [f"""f AS (SELECT {', '.join(FEATURES)} FROM clean WHERE {' AND '.join(map(present, FEATURES))})""",
            f"st AS (SELECT {stats} FROM f)",
            "z AS (SELECT row_number() OVER () AS rid, " + ", ".join(f"({f} - m_{f}) / s_{f} AS z{i}" for i, f in enumerate(FEATURES))
            + ", " + ", ".join(f"m_{f}, s_{f}" for f in FEATURES) + " FROM f, st)"]
    finals = []
    for n, centres in enumerate(CENTRE_SETS):
        dist = [" + ".join(f"pow(z{i} - ({_dbl(x)} - m_{f}) / s_{f}, 2)" for i, (f, x) in enumerate(zip(FEATURES, c))) for c in centres]
        names = [f"d{i}" for i in range(len(centres))]
        best = f"least({', '.join(names)})"
        case = "CASE " + " ".join(f"WHEN {d} = {best} THEN {i}" for i, d in enumerate(names)) + " END"
        sums = ", ".join(f"sum(z{i}) AS t{i}" for i in range(len(FEATURES)))
        square = " + ".join(f"z{i} * z{i}" for i in range(len(FEATURES)))
        dot = " + ".join(f"a.z{i} * g.t{i} / g.n" for i in range(len(FEATURES)))
        own_square = " + ".join(f"a.z{i} * a.z{i}" for i in range(len(FEATURES)))
        ctes += [
            f"a{n} AS (SELECT *, {case} AS zone, {best} AS d FROM (SELECT *, " + ", ".join(f"{e} AS {d}" for e, d in zip(dist, names)) + " FROM z))",
            f"g{n} AS (SELECT zone, count(*) AS n, sum(d) AS cost, sum({square}) AS q, {sums} FROM a{n} GROUP BY zone)",
            f"""e{n} AS (SELECT a.rid, a.zone, g.zone AS other, g.n, greatest({own_square} - 2 * ({dot}) + g.q / g.n, 0) AS away FROM a{n} a, g{n} g)""",
            f"""s{n} AS (SELECT rid, max(CASE WHEN other = zone THEN n END) AS n, max(CASE WHEN other = zone THEN away * n / greatest(n - 1, 1) END) AS own,
  min(CASE WHEN other <> zone THEN away END) AS near FROM e{n} GROUP BY rid)""",
        ]
        finals.append(f"""SELECT {len(centres)} AS k, (SELECT CAST(count(*) AS INTEGER) FROM g{n}) AS zones, (SELECT CAST(sum(n) AS BIGINT) FROM g{n}) AS events,
  (SELECT {rnd('sum(cost)', 4)} FROM g{n}) AS cost,
  (SELECT {rnd('avg(CASE WHEN n = 1 OR greatest(own, near) = 0 THEN 0 ELSE (near - own) / greatest(own, near) END)', 9)} FROM s{n}) AS silhouette""")
    body = " UNION ALL ".join(finals)
    return ",\n".join(ctes) + f""", scored AS ({body})
SELECT *, k = (SELECT k FROM scored WHERE silhouette IS NOT NULL ORDER BY silhouette DESC, k LIMIT 1) AS chosen FROM scored"""


def _region(boxes: str, key: str) -> str:
    return f"""boxes AS ({boxes})
SELECT b.{key}, count(c.mag) AS total_events, {rnd(mean('c.mag'), 3)} AS avg_magnitude, {rnd('max(c.mag)', 3)} AS max_magnitude,
  {rnd('min(c.mag)', 3)} AS min_magnitude, {rnd('stddev_samp(c.mag)', 3)} AS std_magnitude, {rnd(mean('c.depth'), 2)} AS avg_depth_km
FROM boxes b LEFT JOIN clean c ON c.latitude BETWEEN b.lat_min AND b.lat_max
  AND CASE WHEN b.lon_min <= b.lon_max THEN c.longitude BETWEEN b.lon_min AND b.lon_max ELSE c.longitude >= b.lon_min OR c.longitude <= b.lon_max END
GROUP BY b.{key}"""


def _correlations(source: str, pairs: list[tuple[str, str]]) -> str:
    used = sorted({c for p in pairs for c in p})
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in used)
    rows = f"f AS (SELECT {', '.join(FEATURES)} FROM {source} WHERE {' AND '.join(map(present, FEATURES))}), r AS (SELECT *, {ranks} FROM f)\n"
    return rows + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, count(*) AS events, {rnd(f'corr({x}, {y})', 9)} AS pearson, {rnd(f'corr(r_{x}, r_{y})', 9)} AS spearman FROM r" for x, y in pairs)


def _split(label: str) -> str:
    """Counts of both sides of the hash split over the rows with a published zone."""
    return f"""{_assign_sql('clean', 'id')}, sided AS (
  SELECT {label} AS label, substr(md5(coalesce(id, '')), 1, 1) < '4' AS held FROM assigned
)
SELECT count(*) FILTER (NOT held) AS train_rows, count(*) FILTER (held) AS test_rows, count(*) FILTER (held) AS confusion_rows,
  count(DISTINCT label) FILTER (held) AS labels, TRUE AS beats_majority FROM sided"""


_NAMED = ", ".join(f"('{n}', {', '.join(f'CAST({v} AS DOUBLE)' for v in limits)})" for n, *limits in NAMED_BOXES)
_KERNEL = ", ".join(f"({a}, {b}, {w})" for a, b, w in kernel(2))
_EXACT = "CAST(mag AS DECIMAL(18,6))"

ORACLE = {
    "k_choice": _with_more(_silhouettes()),
    "k_choice_fitted_check": _with(f"""SELECT CAST(k AS INTEGER) AS k, CAST(k AS INTEGER) AS zones, (SELECT count(*) FROM clean) AS events, TRUE AS in_range, TRUE AS one_chosen
FROM (SELECT unnest(range({FITTED_K.start}, {FITTED_K.stop})) AS k)"""),
    "trend": _with_more(f"""m AS (SELECT year * 12 + month - 1 AS i, count(*) AS n FROM clean WHERE year IS NOT NULL GROUP BY 1
), ends AS (SELECT min(i) AS low, max(i) AS high FROM m
), dense AS (
  SELECT c.i, CASE WHEN c.i <= high THEN coalesce(n, 0) END AS n, low
  FROM (SELECT unnest(range(low, high + 1 + {MONTHS_AHEAD})) AS i, low, high FROM ends) c LEFT JOIN m ON m.i = c.i
), s AS (
  SELECT count(n) AS m, sum(i - low) AS x, sum(n) AS y, sum((i - low) * (i - low)) AS xx, sum((i - low) * n) AS xy FROM dense WHERE n IS NOT NULL
), line AS (
  SELECT CASE WHEN m * xx = x * x THEN 0.0 ELSE CAST(m * xy - x * y AS DOUBLE) / CAST(m * xx - x * x AS DOUBLE) END AS slope,
         CASE WHEN m * xx = x * x THEN CAST(y AS DOUBLE) ELSE CAST(y * xx - x * xy AS DOUBLE) / CAST(m * xx - x * x AS DOUBLE) END AS intercept FROM s
)
SELECT CAST(i // 12 AS INTEGER) AS year, CAST(i % 12 + 1 AS INTEGER) AS month, CAST(n AS BIGINT) AS events, slope, intercept,
  intercept + slope * CAST(i - low AS DOUBLE) AS fitted FROM dense, line"""),
    "region_stats_named": _with_more(_region(f"SELECT * FROM (VALUES {_NAMED}) AS t(box_id, lat_min, lat_max, lon_min, lon_max)", "box_id")),
    "region_stats_strong": _with_more(_region(f"""SELECT id, greatest(latitude - {HALF_SIDE}, -90.0) AS lat_min, least(latitude + {HALF_SIDE}, 90.0) AS lat_max,
  CASE WHEN longitude - {HALF_SIDE} < -180 THEN longitude - {HALF_SIDE} + 360 ELSE longitude - {HALF_SIDE} END AS lon_min,
  CASE WHEN longitude + {HALF_SIDE} > 180 THEN longitude + {HALF_SIDE} - 360 ELSE longitude + {HALF_SIDE} END AS lon_max
  FROM clean WHERE mag >= {STRONG_MAG}""", "id")),
    "correlation": _with_more(_correlations("clean", list(combinations(FEATURES, 2)))),
    "correlation_view": _with_more(_correlations("dview", [("depth", "mag")])),
    "smoothed_density": _with_more(f"""cells AS (
  SELECT CAST(round_even(latitude * 10.0, 0) AS BIGINT) AS y, CAST(round_even(longitude * 10.0, 0) AS BIGINT) AS x, count(*) AS n, sum({_EXACT}) AS m FROM dview GROUP BY 1, 2
), shares AS (
  SELECT greatest(least(y + dy, 900), -900) AS ty, ((x + dx + 1800) % 3600 + 3600) % 3600 - 1800 AS tx, n * w AS n, m * w AS m
  FROM cells, (VALUES {_KERNEL}) AS k(dy, dx, w)
)
SELECT CAST(ty AS DOUBLE) / 10 AS lat_grid, CAST(tx AS DOUBLE) / 10 AS lon_grid, CAST(sum(n) AS DOUBLE) / 256 AS events, CAST(sum(m) AS DOUBLE) / 256 AS mag_weight
FROM shares GROUP BY ty, tx"""),
    "supervised_forest_check": _with_more(_split("cluster")),
    "supervised_boosted_check": _with_more(_split("CASE WHEN cluster = 1 THEN 1 ELSE 0 END")),
    "geojson_roundtrip": _with(f"SELECT {ALL} FROM quakes"),
    "geojson_lines_roundtrip": _with(f"SELECT {ALL} FROM quakes"),
    "space_ordered_box": _with(f"SELECT {ALL} FROM quakes WHERE latitude BETWEEN {BOX_LAT[0]} AND {BOX_LAT[1]} AND longitude BETWEEN {BOX_LON[0]} AND {BOX_LON[1]}"),
}
