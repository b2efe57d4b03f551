"""Space-ordered Parquet: files of neighbouring events, and reads that skip files.

Rows are range-partitioned and sorted by a key that interleaves the bits of
latitude and longitude, so a file holds a compact patch of the map.  The
files' limits are kept beside them; a box is read from the files whose limits
meet it, and Parquet's own footers skip row groups within those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hidden folder of the files' limits.
LIMITS = "_limits"


def _cell(col: str, low: float, span: float) -> Column:
    """The coordinate's place in 65,536 equal steps; missing ones are at 0."""
    step = F.floor((F.col(col) - F.lit(low)) / F.lit(span) * F.lit(65536.0))
    return F.coalesce(F.greatest(F.least(F.nanvl(step.cast("double"), F.lit(0.0)), F.lit(65535.0)), F.lit(0.0)), F.lit(0.0)).cast("long")


def _spread(v: Column) -> Column:
    """The 16 bits of v with a zero bit between neighbours."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def space_key(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Interleaved bits of both coordinates: near places mostly have near keys."""
    return _spread(_cell(longitude, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_cell(latitude, -90.0, 180.0)), 1))


def write_space_ordered(df: DataFrame, path: str, files: int) -> None:
    """Write ``df`` in about ``files`` files by ``space_key``, and the limits of each file."""
    spark = df.sparkSession
    # a key that many rows share would fill one file: rows of one key may be dealt on by a hash of the row
    keyed = df.withColumn("_key", space_key()).withColumn("_rest", F.xxhash64(*df.columns))
    ordered = keyed.repartitionByRange(files, "_key", "_rest").sortWithinPartitions("_key", "_rest").drop("_key", "_rest")
    ordered.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    ends = [f(F.when(~F.isnan(c), F.col(c))).alias(f"{c}_{n}") for c in ("latitude", "longitude") for f, n in ((F.min, "low"), (F.max, "high"))]
    limits = back.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends, F.count(F.lit(1)).alias("rows"))
    limits.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LIMITS}")


def files_of_box(spark: SparkSession, path: str, lat_range: tuple[float, float], lon_range: tuple[float, float]) -> list[str]:
    """The files whose limits meet the closed ranges."""
    limits = spark.read.parquet(f"{path.rstrip('/')}/{LIMITS}")
    meets = lambda c, r: (F.col(f"{c}_low") <= float(r[1])) & (F.col(f"{c}_high") >= float(r[0]))
    return [r["file"] for r in limits.filter(meets("latitude", lat_range) & meets("longitude", lon_range)).select("file").orderBy("file").collect()]


def read_box(spark: SparkSession, path: str, lat_range: tuple[float, float], lon_range: tuple[float, float]) -> DataFrame:
    """The rows in the closed ranges, from the files that can hold any; rows without coordinates are in no box."""
    schema = spark.read.parquet(path).schema
    files = files_of_box(spark, path, lat_range, lon_range)
    if not files:
        return spark.createDataFrame([], schema)
    inside = F.col("latitude").between(*map(float, lat_range)) & F.col("longitude").between(*map(float, lon_range))
    return spark.read.schema(schema).parquet(*files).filter(inside)
