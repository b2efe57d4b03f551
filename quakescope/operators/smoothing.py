"""Kernel-smoothed density: a stencil over grid cells.

Events are folded per cell; each cell then adds weighted shares to its
neighbours, and one aggregate sums them.  The weights are binomial (the
discrete bell), integers over a power of two, so sums stay exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.functions.stats import merged_sum, sum_parts


def kernel(radius: int) -> list[tuple[int, int, int]]:
    """(step in latitude, step in longitude, weight) of a square stencil; the weights sum to 16 ** radius."""
    side = [math.comb(2 * radius, i) for i in range(2 * radius + 1)]
    return [(i - radius, j - radius, a * b) for i, a in enumerate(side) for j, b in enumerate(side)]


def _steps(col: str, decimals: int) -> Column:
    return F.rint(F.col(col) * F.lit(float(10**decimals))).cast("long")


def smoothed_density(df: DataFrame, radius: int = 2, decimals: int = 1) -> DataFrame:
    """lat_grid, lon_grid, events, mag_weight: smoothed counts and magnitude sums of every cell with a share.

    Cells have a side of 10 ** -decimals degrees, ties to even, as in the
    density grid.  Longitudes run round the date line (180 is -180); shares
    past a pole stay in the pole's row, so nothing is lost and the columns sum
    to those of the density grid.
    """
    scale = 10**decimals
    cells = (df.groupBy(_steps("latitude", decimals).alias("y"), _steps("longitude", decimals).alias("x"))
             .agg(F.count(F.lit(1)).alias("n"), *sum_parts("mag", "mag")))
    stencil = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx"), F.lit(w).alias("w")) for a, b, w in kernel(radius)])
    shares = cells.withColumn("k", F.explode(stencil))
    y = F.greatest(F.least(F.col("y") + F.col("k.dy"), F.lit(90 * scale)), F.lit(-90 * scale))
    x = F.pmod(F.col("x") + F.col("k.dx") + 180 * scale, F.lit(360 * scale)) - 180 * scale
    whole = F.lit(float(16**radius))
    summed = (shares.withColumns({"ty": y, "tx": x}).groupBy("ty", "tx")
              .agg(F.sum(F.col("n") * F.col("k.w")).alias("n"), merged_sum("mag", F.col("k.w")).alias("mag")))
    return summed.select((F.col("ty").cast("double") / scale).alias("lat_grid"), (F.col("tx").cast("double") / scale).alias("lon_grid"),
                         (F.col("n").cast("double") / whole).alias("events"), (F.col("mag") / whole).alias("mag_weight"))
