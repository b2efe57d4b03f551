"""Named queries of the further analyses: choice of k, trend, regions, correlation, smoothing, learning, layouts.

Each takes ``(spark, sf_dir)`` and reads the whole ``events`` table through
the ``quakes`` view, as those of ``registry`` do.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.functions.stats import round_half_up
from quakescope.operators import choice_of_k as K
from quakescope.operators import clean as C
from quakescope.operators import clustering as Z
from quakescope.operators.correlation import correlation
from quakescope.operators.regions import boxes_around, region_stats
from quakescope.operators.smoothing import smoothed_density
from quakescope.operators.supervised import evaluated
from quakescope.operators.trend import trend
from quakescope.plans.batch import clean_table_columns, read_clean, write_clean
from quakescope.schema import CATALOG_COLUMNS, FEATURES
from quakescope.session import scratch_path, stored
from quakescope.sources import geojson, layout
from quakescope.sources.fixture import quakes

# Sets of the first 2 to 6 published centres, and the range of k that is fitted.
CENTRE_SETS = [Z.PUBLISHED_CENTRES[:k] for k in range(2, 7)]
FITTED_K = range(2, 9)
# Months ahead of the trend; least magnitude and half side of the boxes around strong events.
MONTHS_AHEAD = 12
STRONG_MAG, HALF_SIDE = 8.0, 5.0
# Named boxes (latitude from, to, longitude from, to); two of them cross the date line.
NAMED_BOXES = [
    ("Indonesia", -11.0, 6.0, 95.0, 141.0),
    ("Sumatra", -6.0, 6.0, 95.0, 106.5),
    ("Japan", 24.0, 46.0, 122.0, 146.0),
    ("California", 32.0, 42.0, -125.0, -114.0),
    ("Andes", -56.0, 13.0, -82.0, -63.0),
    ("Mediterranean", 30.0, 46.0, -6.0, 36.5),
    ("Fiji-Tonga", -25.0, -12.0, 172.0, -170.0),
    ("Aleutians", 50.0, 57.0, 165.0, -155.0),
    ("South Pole", -90.0, -85.0, -180.0, 180.0),
]
# The box read from the space-ordered layout, and its files.
BOX_LAT, BOX_LON, LAYOUT_FILES = (-11.0, 6.0), (95.0, 141.0), 16


def _clean_table(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table written once: the analyses below read it more than once."""
    raw, path = quakes(spark, sf), scratch_path(spark, "clean")
    write_clean(raw, path)
    return read_clean(spark, path, clean_table_columns(raw))


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return C.dashboard_view(C.display_clean(quakes(spark, sf)))


def k_choice(spark, sf):
    """Cost and silhouette of the published centres' first 2 to 6, and which k the silhouette chooses."""
    scored = K.silhouettes(_clean_table(spark, sf), CENTRE_SETS)
    return scored.select("k", "zones", "events", round_half_up("cost", 4).alias("cost"), round_half_up("silhouette", 9).alias("silhouette"),
                         (F.col("k") == F.lit(K.best_k(scored))).alias("chosen"))


def k_choice_fitted_check(spark, sf):
    """What holds of any fit for each k: its zones, events, a silhouette in range, and one chosen k."""
    rows = _clean_table(spark, sf)
    scored = K.silhouettes(rows, K.fitted_sets(rows, FITTED_K))
    best = K.best_k(scored)
    return scored.select("k", "zones", "events", F.col("silhouette").between(-1.0, 1.0).alias("in_range"), F.lit(best in FITTED_K).alias("one_chosen"))


def trend_q(spark, sf):
    """Monthly counts with their straight line, a year ahead."""
    return trend(C.clean(quakes(spark, sf)), MONTHS_AHEAD)


def region_stats_named(spark, sf):
    boxes = spark.createDataFrame(NAMED_BOXES, "box_id string, lat_min double, lat_max double, lon_min double, lon_max double")
    return region_stats(_clean_table(spark, sf), boxes)


def region_stats_strong(spark, sf):
    """Statistics of a box around every strong event."""
    rows = _clean_table(spark, sf)
    return region_stats(rows, boxes_around(rows.filter(F.col("mag") >= STRONG_MAG), "id", HALF_SIDE), key="id")


def correlation_q(spark, sf):
    """Pearson's and Spearman's coefficient of every pair of features."""
    found = correlation(_clean_table(spark, sf), list(combinations(FEATURES, 2)))
    return found.select("x", "y", "events", round_half_up("pearson", 9).alias("pearson"), round_half_up("spearman", 9).alias("spearman"))


def correlation_view(spark, sf):
    """The page's depth against magnitude, over all rows of its view."""
    found = correlation(stored(_view(spark, sf).select(*FEATURES), "view"), [("depth", "mag")])
    return found.select("x", "y", "events", round_half_up("pearson", 9).alias("pearson"), round_half_up("spearman", 9).alias("spearman"))


def smoothed_density_q(spark, sf):
    return smoothed_density(_view(spark, sf))


def _zoned(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rows with the published zone they are nearest to."""
    rows = _clean_table(spark, sf).select("id", *FEATURES)
    return stored(Z.assign_to_centres(rows, keep=["id"]), "zoned")


def _held(result: DataFrame) -> DataFrame:
    """What holds of any useful model: the split's counts, and that it beats the most frequent label (or is always right: none beats the only label)."""
    beats = (F.col("accuracy") > F.col("majority")) | (F.col("accuracy") == 1.0)
    return result.select("train_rows", "test_rows", "confusion_rows", "labels", beats.alias("beats_majority"))


def supervised_forest_check(spark, sf):
    """A random forest learns the published zones from the features."""
    return _held(evaluated(_zoned(spark, sf), "cluster"))


def supervised_boosted_check(spark, sf):
    """Boosted trees learn whether the published zone is the second."""
    rows = _zoned(spark, sf).withColumn("second", (F.col("cluster") == 1).cast("int"))
    return _held(evaluated(rows, "second", method="boosted"))


def geojson_roundtrip(spark, sf):
    path = scratch_path(spark, "geojson")
    geojson.write_geojson(quakes(spark, sf), path)
    return geojson.read_geojson(spark, path)


def geojson_lines_roundtrip(spark, sf):
    path = scratch_path(spark, "geojson-lines")
    geojson.write_geojson(quakes(spark, sf), path, lines=True)
    return geojson.read_geojson(spark, path, lines=True)


def space_ordered_box(spark, sf):
    path = scratch_path(spark, "ordered")
    layout.write_space_ordered(quakes(spark, sf), path, LAYOUT_FILES)
    return layout.read_box(spark, path, BOX_LAT, BOX_LON).select(*CATALOG_COLUMNS)


QUERIES = {
    "k_choice": k_choice,
    "k_choice_fitted_check": k_choice_fitted_check,
    "trend": trend_q,
    "region_stats_named": region_stats_named,
    "region_stats_strong": region_stats_strong,
    "correlation": correlation_q,
    "correlation_view": correlation_view,
    "smoothed_density": smoothed_density_q,
    "supervised_forest_check": supervised_forest_check,
    "supervised_boosted_check": supervised_boosted_check,
    "geojson_roundtrip": geojson_roundtrip,
    "geojson_lines_roundtrip": geojson_lines_roundtrip,
    "space_ordered_box": space_ordered_box,
}
