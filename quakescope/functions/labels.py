"""Display labels: cluster zones, month periods, coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone label and colour per cluster id 0..5.
CLUSTER_LABELS = [
    "Zona Merah (Sangat Aktif)",
    "Zona Oranye (Aktif)",
    "Zona Kuning (Moderat-Tinggi)",
    "Zona Hijau (Moderat)",
    "Zona Biru (Rendah-Moderat)",
    "Zona Ungu (Rendah)",
]
CLUSTER_COLORS = ["#e74c3c", "#e67e22", "#f1c40f", "#2ecc71", "#3498db", "#9b59b6"]
# Fallbacks for ids without an entry.
CLUSTER_LABEL_FALLBACK_PREFIX = "Cluster "
CLUSTER_COLOR_FALLBACK = "#aaa"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cluster_label(col: str | Column = "cluster") -> Column:
    c = _c(col)
    table = F.array(*[F.lit(x) for x in CLUSTER_LABELS])
    known = (c >= 0) & (c < len(CLUSTER_LABELS))
    return F.when(known, F.try_element_at(table, c.cast("int") + 1)).otherwise(
        F.concat(F.lit(CLUSTER_LABEL_FALLBACK_PREFIX), c.cast("string")))


def cluster_color(col: str | Column = "cluster") -> Column:
    c = _c(col)
    table = F.array(*[F.lit(x) for x in CLUSTER_COLORS])
    known = (c >= 0) & (c < len(CLUSTER_COLORS))
    return F.when(known, F.try_element_at(table, c.cast("int") + 1)).otherwise(
        F.lit(CLUSTER_COLOR_FALLBACK))


def period_label(year: str | Column = "year", month: str | Column = "month") -> Column:
    """``YYYY-MM``; empty text when the year is unknown."""
    y, m = _c(year), _c(month)
    return F.when(y.isNull(), F.lit("")).otherwise(
        F.format_string("%d-%02d", y.cast("int"), m.cast("int")))


def coord_label(lat: str | Column, lon: str | Column) -> Column:
    """``lat°, lon°`` with one decimal each (inputs already on 0.1° cells)."""
    return F.format_string("%.1f°, %.1f°", _c(lat), _c(lon))
