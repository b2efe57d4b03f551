"""Seismic zones: standardised KMeans over (latitude, longitude, depth, mag).

* ``fit_zones`` — MLlib ``Pipeline(VectorAssembler, StandardScaler, KMeans)``;
  ``restarts`` > 1 moves the centres of all starts together (``restarts``) and
  keeps the one with the lowest cost (the restart count of the single-machine
  variants), ``ddof=0`` scales by the population standard deviation.  Each
  pass is a distributed aggregate; the four feature columns are persisted
  (memory, then disk) for the fit.
* ``standardize`` / ``assign_to_centres`` — the same maths in plain column
  expressions, for given centres (no fit), so it can be checked in SQL.
* ``cluster_summary`` — per-zone count, mean position/depth/magnitude, max.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.functions.labels import cluster_color, cluster_label, coord_label
from quakescope.functions.stats import exact_mean, exact_sum, round_half_up
from quakescope.operators.clean import all_present, feature_rows
from quakescope.operators.restarts import refine, sampled_rows, spread_starts, wide
from quakescope.schema import FEATURES

# Zone centres (latitude, longitude, depth km, magnitude) of the
# published six-zone run, cluster ids 0..5 in order.
PUBLISHED_CENTRES = [
    (-21.689780000000003, -85.55452, 67.2644, 4.42),
    (37.87992073588051, -119.41759251098632, 5.951298894451995, 0.953),
    (59.207952, -152.658212, 31.289839999999998, 2.2548),
    (-7.3627, 119.5484, 444.62, 4.1),
    (8.219620833333375, 142.00200833333375, 16.13175, 4.25375),
    (29.492111855933956, -118.99674535494295, 12.2172353893104, 2.1344615384615384),
]


def feature_stats(df: DataFrame, features: Sequence[str] = FEATURES, ddof: int = 1) -> dict:
    """Mean and standard deviation per feature: one bounded aggregate row."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = []
    for f in features:
        aggs += [exact_mean(f).alias(f"{f}__mean"), std(f).alias(f"{f}__std")]
    row = df.agg(*aggs).first()
    return {f: (row[f"{f}__mean"], row[f"{f}__std"]) for f in features}


def standardize(df: DataFrame, features: Sequence[str] = FEATURES, ddof: int = 1,
                suffix: str = "_z") -> DataFrame:
    """Feature rows plus ``(x - mean) / std`` per feature (zero std → 0)."""
    rows = feature_rows(df, features)
    stats = feature_stats(rows, features, ddof)
    cols = []
    for f in features:
        mean, sd = stats[f]
        z = F.lit(0.0) if not sd else (F.col(f) - F.lit(mean)) / F.lit(sd)
        cols.append(z.alias(f + suffix))
    return rows.select(*features, *cols)


def nearest(dists: Sequence[Column]) -> Column:
    """Number of the least distance, the lowest on a tie; each distance is computed once."""
    numbered = [F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(dists)]
    return (F.least(*numbered) if len(numbered) > 1 else numbered[0])["i"].cast("int")


def assign_to_centres(df: DataFrame, centres: Sequence[Sequence[float]] = PUBLISHED_CENTRES,
                      features: Sequence[str] = FEATURES, ddof: int = 1,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Nearest centre in standardised space (lowest id on a tie) → ``cluster``.

    The scale of each feature comes from one aggregate over the rows; the
    mean cancels in the distance.  Centres are given in raw units.  ``keep``
    names extra columns carried through.
    """
    rows = df.select(*keep, *features).filter(all_present(list(features)))
    stats = feature_stats(rows, features, ddof)
    dists: list[Column] = []
    for centre in centres:
        d = None
        for f, c in zip(features, centre):
            sd = stats[f][1] or 1.0
            term = (F.col(f) - F.lit(float(c))) / F.lit(sd)
            term = term * term
            d = term if d is None else d + term
        dists.append(d)
    return rows.withColumn("cluster", nearest(dists))


@dataclass
class ZoneFit:
    """Fitted zones: centres in units of ``unit`` around ``mean``, and the persisted training rows (the four features)."""

    zones: np.ndarray
    mean: list[float]
    unit: list[float]
    training: DataFrame
    cost: float
    features: tuple[str, ...] = tuple(FEATURES)
    model: PipelineModel | None = None

    def centres(self) -> list[list[float]]:
        """The centres in raw units."""
        return [[float(c * u + m) for c, u, m in zip(zone, self.unit, self.mean)] for zone in self.zones]

    def squares(self, centres: Sequence[Sequence[float]]) -> list[Column]:
        """Squared distances to centres given in raw units."""
        found = []
        for centre in centres:
            terms = [((F.col(f) - F.lit(float(c))) / F.lit(u)) ** 2 for f, c, u in zip(self.features, centre, self.unit)]
            found.append(sum(terms[1:], terms[0]))
        return found

    def assign(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Zone id of every row with all features present (a map-only pass); ``keep`` names further columns."""
        rows = df.select(*keep, *[f for f in self.features if f not in keep]).filter(all_present(list(self.features)))
        return rows.withColumn("cluster", nearest(self.squares(self.centres())))

    def assigned(self) -> DataFrame:
        """Training rows with their zone id (a map-only pass over the persisted rows)."""
        return self.assign(self.training)

    def unpersist(self) -> None:
        self.training.unpersist()


def _mllib_start(rows: DataFrame, features: Sequence[str], k: int, seed: int, max_iter: int):
    """MLlib's pipeline on the rows: (scaler and KMeans models, cost)."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True).fit(vectors.transform(rows))
    scaled = scaler.transform(vectors.transform(rows)).select("features")
    km = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter).fit(scaled)
    return PipelineModel(stages=[vectors, scaler, km]), scaler, km


def _scale(scaler: StandardScalerModel) -> tuple[list[float], list[float]]:
    std = scaler.std.toArray()
    return [float(m) for m in scaler.mean.toArray()], [float(s) if s > 0 else 1.0 for s in std]


def fit_zones(df: DataFrame, k: int = 6, seed: int = 42, max_iter: int = 20,
              restarts: int = 1, ddof: int = 1,
              features: Sequence[str] = FEATURES) -> ZoneFit:
    """Fit the zone model on the rows with all features present.

    The four feature columns are persisted (memory, then disk) once; MLlib's
    pipeline scales them and fits KMeans.  With ``restarts`` its first step is
    the first start and the others are spread over a bounded sample of rows;
    all starts are then moved together, one pass over the rows an iteration,
    and the lowest cost wins, ties to the earliest start.  The rows are
    released if the fit raises.
    """
    rows = feature_rows(df, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()  # also fills the cache
        if not n:
            raise ValueError("no rows with all features present: nothing to cluster")
        many = max(1, restarts)
        model, scaler, km = _mllib_start(rows, features, k, seed, max_iter if many == 1 else 1)
        mean, unit = _scale(scaler)
        first = np.array([c for c in km.clusterCenters()], float)
        if many == 1:
            zones, cost = first, km.summary.trainingCost
        else:
            sample = (sampled_rows(rows, n, seed) - mean) / unit
            starts = spread_starts(sample, len(first), range(seed + 1, seed + many))
            zones, costs = refine(wide(rows, n), np.concatenate([first[None], starts]), mean, unit, max_iter - 1)
            best = int(np.argmin(costs))
            zones, cost, model = zones[best], float(costs[best]), None
        if ddof == 0 and n > 1:  # the same zones in units of the population's deviation
            factor = math.sqrt(n / (n - 1))
            zones, unit, cost = zones * factor, [u / factor for u in unit], cost * factor * factor
        return ZoneFit(zones, mean, unit, rows, cost, tuple(features), model)
    except BaseException:
        rows.unpersist()
        raise


def fit_check(fit: ZoneFit, centres: Sequence[Sequence[float]] = PUBLISHED_CENTRES) -> DataFrame:
    """What holds of any fit, as one row: zones, events, feature sums over the
    zones, events not at their nearest fitted centre, and whether the fit costs
    no more than the published centres."""
    features = list(fit.features)
    own, given = fit.squares(fit.centres()), fit.squares(centres)
    each = fit.assigned().withColumns({"_own": F.array(*own), "_given": F.least(*given)})
    here = F.element_at("_own", F.col("cluster") + 1)
    return each.agg(
        F.count_distinct("cluster").alias("zones"), F.count(F.lit(1)).alias("events"),
        *[exact_sum(f).alias(f"sum_{f}") for f in features],
        F.count_if(here > F.array_min("_own") + F.lit(1e-6)).alias("not_nearest"),
        (F.sum(here) <= F.sum("_given")).alias("cost_ok"))


def assign_zones(model: PipelineModel, df: DataFrame,
                 features: Sequence[str] = FEATURES) -> DataFrame:
    """Zone id of every row with all features present (a map-only pass)."""
    out = model.transform(feature_rows(df, features))
    return out.select(*features, F.col("cluster").cast("int").alias("cluster"))


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Per-zone event count, mean latitude/longitude/depth/magnitude, max magnitude."""
    return (clustered.groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("jumlah_event"),
                 exact_mean("latitude").alias("center_lat"),
                 exact_mean("longitude").alias("center_lon"),
                 exact_mean("depth").alias("avg_depth"),
                 exact_mean("mag").alias("avg_mag"),
                 F.max("mag").alias("max_mag"))
            .orderBy("cluster"))


def with_zone_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({"cluster_label": cluster_label("cluster"),
                           "color": cluster_color("cluster")})


def zone_table(summary: DataFrame) -> DataFrame:
    """Display table of the zones: label, count, centre text, rounded means."""
    # The page's headings.
    return summary.select(
        cluster_label("cluster").alias("Zona"),
        F.col("jumlah_event").alias("Jumlah Event"),
        coord_label(round_half_up("center_lat", 1), round_half_up("center_lon", 1))
        .alias("Pusat (Lat, Lon)"),
        round_half_up("avg_depth", 1).alias("Avg Kedalaman (km)"),
        round_half_up("avg_mag", 2).alias("Avg Mag"),
        round_half_up("max_mag", 2).alias("Max Mag"),
    )
