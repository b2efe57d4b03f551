"""Statistics of many boxes at once: a range join through covering cells.

A box is covered by square cells.  Events are folded per cell first, and cells
that lie whole in a box give it these folded rows; only the cells on a box's
edge are joined with their events, which are then held against the box.  Both
joins are on equal cells, and what they yield is folded by box map-side, so an
event costs a row only for the boxes whose edge runs through its cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.functions.stats import millionths, round_half_up
from quakescope.operators.clean import all_present
from quakescope.session import stored

#: Side of a covering cell in degrees.
CELL = 2.0

_NAMES = ["lat_min", "lat_max", "lon_min", "lon_max"]


def _parts(boxes: DataFrame, key: str) -> DataFrame:
    """Boxes that do not cross the date line: one that does (lon_min > lon_max) becomes two."""
    low, high = F.col("lon_min"), F.col("lon_max")
    span = lambda a, b: F.struct(a.alias("lon_min"), b.alias("lon_max"))
    spans = F.when(low > high, F.array(span(low, F.lit(180.0)), span(F.lit(-180.0), high))).otherwise(F.array(span(low, high)))
    whole = boxes.filter(all_present(_NAMES) & (F.col("lat_min") <= F.col("lat_max")))
    return whole.select(F.col(key).alias("box"), "lat_min", "lat_max", F.explode(spans).alias("s")).select("box", "lat_min", "lat_max", "s.*")


def _cell(x: str | Column, cell: float) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x / F.lit(cell)).cast("int")


def cover(boxes: DataFrame, key: str, cell: float = CELL) -> DataFrame:
    """box, its limits, cell_y, cell_x and whether the cell lies whole inside, for all cells that meet the box."""
    at = lambda c, top: _cell(F.least(F.greatest(F.col(c), F.lit(-top)), F.lit(top)), cell)
    rows = _parts(boxes, key)
    cells = rows.withColumn("cell_y", F.explode(F.sequence(at("lat_min", 90.0), at("lat_max", 90.0))))
    cells = cells.withColumn("cell_x", F.explode(F.sequence(at("lon_min", 180.0), at("lon_max", 180.0))))
    y, x = F.col("cell_y") * F.lit(cell), F.col("cell_x") * F.lit(cell)
    inside = (y >= F.col("lat_min")) & (y + cell <= F.col("lat_max")) & (x >= F.col("lon_min")) & (x + cell <= F.col("lon_max"))
    return cells.withColumn("inside", inside)


#: Magnitudes (up to 268) and depths (up to 8,589 km) whose millionths are summed as longs, and the low bits of a square kept apart.
_MOST_MAG, _MOST_DEPTH, _LOW_BITS = 1 << 28, 1 << 33, 26


def _counted(rows: DataFrame) -> DataFrame:
    """What each event adds to a fold, longs where they are exact: worked out once, before a row meets the boxes."""
    small = lambda c, most: F.when(F.abs(millionths(c)) < F.lit(most), millionths(c))
    return rows.withColumns({"_m": small("mag", _MOST_MAG), "_d": small("depth", _MOST_DEPTH)})


def _added() -> list[Column]:
    mag, depth, square = F.col("mag"), F.col("depth"), F.col("_m") * F.col("_m")
    return [F.count(F.lit(1)).alias("n"), F.sum("_m").alias("mag_exact"), F.sum(mag).alias("mag_plain"), F.count_if(F.col("_m").isNull()).alias("mag_left"),
            F.sum("_d").alias("depth_exact"), F.sum(depth).alias("depth_plain"), F.count_if(F.col("_d").isNull()).alias("depth_left"),
            F.sum(F.shiftright(square, _LOW_BITS)).alias("square_high"), F.sum(square.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).alias("square_low"),
            F.sum(mag * mag).alias("square_plain"), F.max("mag").alias("high"), F.min("mag").alias("low")]


def _total(name: str) -> Column:
    exact = F.sum(f"{name}_exact").cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(7,6)")
    return F.when(F.sum(f"{name}_left") == 0, exact.cast("double")).otherwise(F.sum(f"{name}_plain"))


def _total_square() -> Column:
    whole = F.sum("square_high").cast("decimal(19,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + F.sum("square_low").cast("decimal(19,0)")
    exact = (whole.try_cast("decimal(24,0)") * F.lit("0.000000000001").cast("decimal(13,12)")).cast("double")
    return F.when(F.sum("mag_left") == 0, F.coalesce(exact, whole.cast("double") / F.lit(1e12))).otherwise(F.sum("square_plain"))


def region_stats(df: DataFrame, boxes: DataFrame, key: str = "box_id", cell: float = CELL) -> DataFrame:
    """The global statistics (count, mean/max/min/sample-std magnitude, mean depth; report-rounded) of every box.

    ``boxes`` has ``key``, lat_min, lat_max, lon_min, lon_max in degrees;
    edges belong to the box, and lon_min > lon_max runs across the date line.
    A box without events has count 0 and nulls; so has one with a null or NaN
    limit or lat_min > lat_max.  Events count once in each box that holds
    them; those without coordinates, magnitude or depth are in none.  Boxes of
    one key are one region (an event in two of them counts twice).
    """
    # latitudes past the poles or longitudes past the date line lie in no box that keeps to them
    rows = df.filter(all_present(["latitude", "longitude", "mag", "depth"])).select("latitude", "longitude", "mag", "depth")
    rows = rows.withColumns({"cell_y": _cell("latitude", cell), "cell_x": _cell("longitude", cell)})
    rows, cells = _counted(rows), stored(cover(boxes, key, cell), "cover")
    per_cell = rows.groupBy("cell_y", "cell_x").agg(*_added())
    # boxes are never broadcast: their cells take little room as files (runs of one box), but many times that as a hash table
    held = cells.filter("inside").hint("merge").join(per_cell, ["cell_y", "cell_x"]).drop("cell_y", "cell_x", *_NAMES, "inside")
    within = (F.col("latitude") >= F.col("lat_min")) & (F.col("latitude") <= F.col("lat_max")) & (F.col("longitude") >= F.col("lon_min")) & (F.col("longitude") <= F.col("lon_max"))
    edge = cells.filter("NOT inside").hint("merge").join(rows, ["cell_y", "cell_x"]).filter(within).groupBy("box").agg(*_added())
    totals = held.unionByName(edge).groupBy("box").agg(
        F.sum("n").alias("n"), _total("mag").alias("mag"), _total("depth").alias("depth"), _total_square().alias("square"),
        F.max("high").alias("high"), F.min("low").alias("low"))
    n = F.col("n")
    std = F.sqrt(F.greatest(F.try_divide(F.col("square") - F.col("mag") * F.col("mag") / n, n - 1), F.lit(0.0)))
    named = boxes.select(F.col(key).alias("box")).distinct().join(totals, "box", "left")
    return named.select(
        F.col("box").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("total_events"), round_half_up(F.col("mag") / n, 3).alias("avg_magnitude"),
        round_half_up("high", 3).alias("max_magnitude"), round_half_up("low", 3).alias("min_magnitude"),
        F.when(n > 1, round_half_up(std, 3)).alias("std_magnitude"), round_half_up(F.col("depth") / n, 2).alias("avg_depth_km"))


def boxes_around(df: DataFrame, key: str, half_side: float) -> DataFrame:
    """A box of ``half_side`` degrees around every row's place: cut at the poles, running across the date line."""
    lon = lambda x: F.when(x < -180, x + 360).when(x > 180, x - 360).otherwise(x)
    return df.filter(all_present(["latitude", "longitude"])).select(
        F.col(key), F.greatest(F.col("latitude") - half_side, F.lit(-90.0)).alias("lat_min"), F.least(F.col("latitude") + half_side, F.lit(90.0)).alias("lat_max"),
        lon(F.col("longitude") - half_side).alias("lon_min"), lon(F.col("longitude") + half_side).alias("lon_max"))
