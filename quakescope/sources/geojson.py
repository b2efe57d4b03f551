"""GeoJSON feature collections: the nested form in which catalogues are published.

A feature is ``{"type": "Feature", "id": ..., "properties": {mag, place, time,
...}, "geometry": {"type": "Point", "coordinates": [longitude, latitude,
depth]}}``.  The reader takes a collection's features as raw texts first and
parses each by itself, so one bad feature costs one row, not its file.  The
writer makes collections of a bounded number of features, one file each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.schema import CATALOG, CATALOG_COLUMNS

#: Features of a written collection.
PER_FILE = 10_000

# What a feature keeps outside its properties.
_PLACE = ["longitude", "latitude", "depth"]
_OUTSIDE = ["id", *_PLACE]
_PROPERTIES = [f for f in CATALOG.fields if f.name not in _OUTSIDE]

_BAD = "_bad"

# Ends no record, since raw control characters stand in no JSON text: a file is read as one line, whose features are cut
# out of the line's bytes.  The multi-line reader goes back to the file for each feature and reads it about 20 times.
_NO_LINE_END = "\x00\x1e\x00"


def _feature_schema() -> str:
    properties = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in _PROPERTIES)
    return f"type string, id string, properties struct<{properties}>, geometry struct<type: string, coordinates: array<double>>, {_BAD} string"


def _instant(c: Column) -> Column:
    """ISO text of a time given in milliseconds since 1970; other texts as they are."""
    stamp = F.convert_timezone(None, F.lit("UTC"), F.timestamp_millis(c.try_cast("long")))
    return F.when(c.rlike("^-?[0-9]+$"), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(c)


def parse_features(features: DataFrame) -> DataFrame:
    """The 18 catalogue columns and ``bad`` (the feature's text, else null) of a column ``feature`` of JSON texts.

    Bad is what is no JSON object, no feature, has a value of another type, or
    a geometry other than a point or null; its columns are null.
    """
    parsed = features.select("feature", F.from_json("feature", _feature_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}).alias("f"))
    kind, place = F.col("f.type"), F.col("f.geometry")
    good = F.col("f").isNotNull() & F.col(f"f.{_BAD}").isNull() & kind.eqNullSafe("Feature") & (place.isNull() | F.col("f.geometry.type").eqNullSafe("Point"))
    at = {c: F.get(F.col("f.geometry.coordinates"), F.lit(i)) for i, c in enumerate(_PLACE)}
    cols = []
    for field in CATALOG.fields:
        c = at[field.name] if field.name in at else F.col("f.id") if field.name == "id" else F.col(f"f.properties.{field.name}")
        if field.name in ("time", "updated"):
            c = _instant(c)
        cols.append(F.when(good, c).cast(field.dataType).alias(field.name))
    return parsed.select(*cols, F.when(~good, F.col("feature")).alias("bad"))


def read_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``parse_features`` of the collections under ``path`` (``lines``: one feature a line, which splits at any size).

    A file that is no JSON at all is one bad row with its text; a collection
    without features has no rows.  A collection is read by one task.
    """
    if lines:
        return parse_features(spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("feature")))
    files = (spark.read.schema(f"features array<string>, {_BAD} string").option("lineSep", _NO_LINE_END)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).json(path))
    texts = F.when(F.col(_BAD).isNotNull(), F.array(_BAD)).otherwise(F.col("features"))
    return parse_features(files.select(F.explode(texts).alias("feature")))


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The catalogue rows of all good features."""
    return read_features(spark, path, lines).filter(F.col("bad").isNull()).select(*CATALOG_COLUMNS)


def feature_text() -> Column:
    """The JSON feature of a catalogue row; null properties are left out, missing coordinates are null."""
    properties = F.struct(*[F.col(f.name) for f in _PROPERTIES])
    point = F.struct(F.lit("Point").alias("type"), F.array(*[F.col(c) for c in _PLACE]).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("id").alias("id"), properties.alias("properties"), point.alias("geometry")))


def write_geojson(df: DataFrame, path: str, per_file: int = PER_FILE, lines: bool = False) -> None:
    """Write the catalogue rows as collections of at most ``per_file`` features, one file each; or one feature a line."""
    features = df.select(feature_text().alias("feature"))
    if lines:
        features.write.mode("overwrite").text(path)
        return
    # a task numbers its rows from its own multiple of 2^33, so a collection holds rows of one task
    numbered = features.withColumn("collection", F.floor(F.monotonically_increasing_id() / per_file))
    texts = F.concat(F.lit('{"type": "FeatureCollection", "features": [\n'), F.array_join(F.collect_list("feature"), ",\n"), F.lit("\n]}"))
    collections = numbered.groupBy("collection").agg(texts.alias("value"))
    collections.write.mode("overwrite").partitionBy("collection").text(path)
