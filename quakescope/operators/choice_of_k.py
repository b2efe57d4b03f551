"""Choice of the number of zones: silhouette and cost of several sets of centres at once.

With squared Euclidean distances the mean distance from a row x to a zone of n
rows needs only the zone's n, sum S and square sum Q:
|x|^2 - 2 x.S/n + Q/n.  So for each set one aggregate over its zones and one
over the rows give the exact silhouette of every row against all others; no
pair of rows is ever formed.  The input is read once for the scale and twice
for each set: give a written table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.operators.clean import feature_rows
from quakescope.operators.clustering import feature_stats, fit_zones, nearest
from quakescope.schema import FEATURES

Centres = Sequence[Sequence[float]]

SCHEMA = "k int, zones int, events long, cost double, silhouette double"


def _total(terms: list[Column]) -> Column:
    return sum(terms[1:], terms[0])


def _united(frames: list[DataFrame]) -> DataFrame:
    """The few rows of each frame with the frame's number as ``set``."""
    return reduce(DataFrame.unionByName, [f.withColumn("set", F.lit(i)) for i, f in enumerate(frames)])


def silhouettes(df: DataFrame, centre_sets: Sequence[Centres], features: Sequence[str] = FEATURES,
                ddof: int = 1) -> DataFrame:
    """k, zones, events, cost and mean silhouette for each set of centres (raw units).

    Rows with all features present go to their nearest centre in standardised
    space (lowest id on a tie).  ``zones`` counts the centres that got rows,
    ``cost`` sums the rows' squared distances to their centre, ``silhouette``
    averages (b - a) / max(a, b) with a the mean squared distance to the other
    rows of the row's zone and b the least to another zone; a zone's only row
    counts 0, as does a row for which both are 0.  It is null where fewer than
    two zones have rows.
    """
    spark = df.sparkSession
    rows = feature_rows(df, features)
    stats = feature_stats(rows, features, ddof)
    shift = [stats[f][0] or 0.0 for f in features]
    unit = [stats[f][1] or 1.0 for f in features]
    z = [f"_z{i}" for i in range(len(features))]
    rows = rows.select(*[((F.col(f) - F.lit(m)) / F.lit(u)).alias(c) for f, m, u, c in zip(features, shift, unit, z)])

    def zoned(centres: Centres) -> DataFrame:
        gaps = [f"_s{j}" for j in range(len(centres))]
        squares = [_total([(F.col(c) - F.lit((float(x) - m) / u)) ** 2 for c, x, m, u in zip(z, centre, shift, unit)]) for centre in centres]
        away = rows.select(*z, *[s.alias(g) for s, g in zip(squares, gaps)])
        return away.select(*z, nearest([F.col(g) for g in gaps]).alias("zone"), F.least(*gaps, F.lit(float("inf"))).alias("d"))

    # a plan for each set: the code of all sets in one row's pass is too long for the JVM to compile
    sets = [zoned(centres) for centres in centre_sets]
    size = _total([F.col(c) ** 2 for c in z])
    sums = [F.count(F.lit(1)).alias("n"), F.sum("d").alias("cost"), F.sum(size).alias("square"), *[F.sum(c).alias(c) for c in z]]
    # one row per set and zone: as many as there are centres
    found = _united([s.groupBy("zone").agg(*sums) for s in sets]).orderBy("set", "zone").collect()

    def mean_score(s: DataFrame, zones: list) -> DataFrame:
        if len(zones) < 2:
            return s.sparkSession.createDataFrame([(None,)], "score double")
        at = {r["zone"]: f"_away{r['zone']}" for r in zones}
        # rounding may leave a mean squared distance just below 0
        away = [F.greatest(size - 2 * _total([F.col(c) * F.lit(r[c] / r["n"]) for c in z]) + F.lit(r["square"] / r["n"]), F.lit(0.0)).alias(at[r["zone"]])
                for r in zones]
        own, rest = F.lit(0.0), []
        for r in zones:
            here, gap = F.col("zone") == r["zone"], F.col(at[r["zone"]])
            own = F.when(here, gap * F.lit(r["n"] / max(1, r["n"] - 1))).otherwise(own)
            rest.append(F.when(here, F.lit(float("inf"))).otherwise(gap))
        pairs = s.select("zone", *away).select("zone", own.alias("own"), F.least(*rest).alias("other"))
        alone = F.col("zone").isin([r["zone"] for r in zones if r["n"] == 1])
        score = F.coalesce(F.try_divide(F.col("other") - F.col("own"), F.greatest("other", "own")), F.lit(0.0))
        return pairs.agg(F.avg(F.when(alone, F.lit(0.0)).otherwise(score)).alias("score"))

    by_set = [[r for r in found if r["set"] == i] for i in range(len(sets))]
    scores = {r["set"]: r["score"] for r in _united([mean_score(s, zones) for s, zones in zip(sets, by_set)]).collect()}
    result = []
    for i, centres in enumerate(centre_sets):
        zones = by_set[i]
        result.append((len(centres), len(zones), sum(r["n"] for r in zones), float(sum(r["cost"] for r in zones)), scores[i]))
    return spark.createDataFrame(result, SCHEMA)


def best_k(scored: DataFrame) -> int | None:
    """The k of largest silhouette, ties to the smaller k; None where none is defined."""
    row = (scored.filter(F.col("silhouette").isNotNull())
           .orderBy(F.desc("silhouette"), "k").select("k").first())
    return row["k"] if row else None


def fitted_sets(df: DataFrame, ks: Sequence[int], features: Sequence[str] = FEATURES, **options) -> list[list[list[float]]]:
    """Zone centres (raw units) fitted for every k, for ``silhouettes``; ``options`` are those of ``fit_zones``."""
    fits = []
    try:
        for k in ks:  # the feature rows of all fits are one plan, which Spark persists once
            fits.append(fit_zones(df, k=k, features=features, **options))
        return [fit.centres() for fit in fits]
    finally:
        for fit in fits:
            fit.unpersist()
