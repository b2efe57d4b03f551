"""Catalogue readers: CSV (declared schema, bound by header name), Parquet, JSON.

A CSV whose header is reordered must not shift values between columns.  The
reader therefore takes every column as text by its header name, renames
capitalised aliases, checks the required columns, and casts with
``try_cast`` to the catalogue types, which is one projection over the scan.
The names come from one file's header; a folder with a file whose header
differs (other order, other names) raises instead of swapping its values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.schema import CATALOG, HEADER_ALIASES, REQUIRED_COLUMNS


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename ``Time, Latitude, Longitude, Depth, Magnitude`` when the target is absent."""
    present = set(df.columns)
    renames = {src: dst for src, dst in HEADER_ALIASES.items() if src in present and dst not in present}
    return df.withColumnsRenamed(renames) if renames else df


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Raise before any job runs when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"column '{missing[0]}' not found; available columns: {list(df.columns)}")
    return df


def conform(df: DataFrame, strict: bool = False) -> DataFrame:
    """Aliases, required check, then cast to the 18 catalogue columns by name.

    Optional columns absent from the input come back null; text that is not a
    number becomes null.  ``strict`` raises instead when any catalogue column
    is absent.
    """
    df = require_columns(normalize_headers(df))
    cols = []
    for field in CATALOG.fields:
        if field.name in df.columns:
            src = F.col(field.name)
            c = src.try_cast(field.dataType) if dict(df.dtypes)[field.name] == "string" else src.cast(field.dataType)
        elif strict:
            raise ValueError(f"column '{field.name}' not found; available columns: {list(df.columns)}")
        else:
            c = F.lit(None).cast(field.dataType)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """CSV with a header: values bound by header name, typed to the catalogue schema."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    return conform(raw, strict)


def read_csv_positional(spark: SparkSession, path: str) -> DataFrame:
    """CSV read with the declared schema checked against the header (raises on a mismatch)."""
    return (spark.read.option("header", True).option("enforceSchema", False)
            .schema(CATALOG).csv(path))


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text columns with header aliases applied (for the ingestion report)."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    return require_columns(normalize_headers(raw))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the catalogue schema (no inference pass)."""
    return spark.read.schema(CATALOG).json(path)


def inline_rows(spark: SparkSession, rows, names) -> DataFrame:
    """Small in-line rows to a DataFrame (environment smoke check)."""
    return spark.createDataFrame(rows, list(names))
