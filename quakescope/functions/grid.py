"""Spatial grid snapping.

``+ 0.0`` turns a negative zero into zero so that cells near the equator or
the prime meridian print and group as ``0.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def snap_away(col: str | Column, decimals: int = 0) -> Column:
    """Round to ``decimals`` places, ties away from zero (1° cells by default)."""
    return F.round(_c(col), decimals) + F.lit(0.0)


def snap_even(col: str | Column, decimals: int = 0) -> Column:
    """Round to ``decimals`` places, ties to even on ``x * 10**decimals``."""
    if decimals == 0:
        return F.rint(_c(col)) + F.lit(0.0)
    scale = float(10 ** decimals)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)
