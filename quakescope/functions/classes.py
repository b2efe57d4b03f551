"""Magnitude and depth classes as CASE chains (stay inside codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class edges and labels.
# Five magnitude classes (batch job; left-closed there, right-closed in the
# pandas twin).
MAG5_EDGES = [3.0, 5.0, 6.0, 7.0]
MAG5_LABELS = ["Minor", "Light", "Moderate", "Strong", "Major/Great"]
# Six magnitude classes of the dashboard, right-closed.
MAG6_EDGES = [2.0, 3.0, 5.0, 6.0, 7.0]
MAG6_LABELS = ["Micro (<2)", "Minor (2-3)", "Light (3-5)", "Moderate (5-6)",
               "Strong (6-7)", "Major+ (7+)"]
# Three depth classes in km, right-closed everywhere.
DEPTH_EDGES = [70.0, 300.0]
DEPTH_LABELS = ["Dangkal (<70 km)", "Menengah (70-300 km)", "Dalam (>300 km)"]


def bucketize(col: str | Column, edges: Sequence[float], labels: Sequence[str],
              right: bool) -> Column:
    """Label of the bin a value falls in; ``len(labels) == len(edges) + 1``.

    ``right=True`` closes bins on the right (``x <= edge``), else on the left
    (``x < edge``).  Null input gives null.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for edge, label in zip(edges, labels):
        cond = (c <= F.lit(edge)) if right else (c < F.lit(edge))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(c.isNotNull(), F.lit(labels[-1]))


def mag_class_left(col: str | Column = "mag") -> Column:
    return bucketize(col, MAG5_EDGES, MAG5_LABELS, right=False)


def mag_class_right(col: str | Column = "mag") -> Column:
    return bucketize(col, MAG5_EDGES, MAG5_LABELS, right=True)


def mag_class_six(col: str | Column = "mag") -> Column:
    return bucketize(col, MAG6_EDGES, MAG6_LABELS, right=True)


def depth_class(col: str | Column = "depth") -> Column:
    return bucketize(col, DEPTH_EDGES, DEPTH_LABELS, right=True)
