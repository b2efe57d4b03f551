"""ISO-8601 event time → timestamp and calendar parts.

Bad text gives null (``try_to_timestamp``), never an exception, and the parts
are taken on the UTC wall clock whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(col: str | Column = "time") -> Column:
    """Instant of the ISO text, null when the text does not parse."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def utc_wall_time(col: str | Column = "time") -> Column:
    """UTC wall-clock time (timestamp without zone) of the ISO text."""
    return F.convert_timezone(None, F.lit("UTC"), parse_time(col))


def day_start(col: str | Column = "time") -> Column:
    """Calendar day of the event as its UTC midnight (timestamp without zone)."""
    return F.to_date(utc_wall_time(col)).cast("timestamp_ntz")


def time_part_columns(col: str | Column = "time") -> dict[str, Column]:
    """``year``, ``month``, ``hour`` and ``day`` of the event time (UTC)."""
    t = utc_wall_time(col)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "hour": F.hour(t),
        "day": day_start(col),
    }
