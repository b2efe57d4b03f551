"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from quakescope.functions.classes import (
    DEPTH_EDGES,
    DEPTH_LABELS,
    MAG5_EDGES,
    MAG5_LABELS,
    MAG6_EDGES,
    MAG6_LABELS,
    bucketize,
    depth_class,
    mag_class_left,
    mag_class_right,
    mag_class_six,
)
from quakescope.functions.grid import snap_away, snap_even
from quakescope.functions.labels import (
    CLUSTER_COLORS,
    CLUSTER_LABELS,
    cluster_color,
    cluster_label,
    coord_label,
    period_label,
)
from quakescope.functions.stats import exact_mean, pct_of, round_half_up
from quakescope.functions.timeparts import day_start, parse_time, utc_wall_time

__all__ = [
    "DEPTH_EDGES", "DEPTH_LABELS", "MAG5_EDGES", "MAG5_LABELS", "MAG6_EDGES", "MAG6_LABELS",
    "bucketize", "depth_class", "mag_class_left", "mag_class_right", "mag_class_six",
    "snap_away", "snap_even", "CLUSTER_COLORS", "CLUSTER_LABELS", "cluster_color",
    "cluster_label", "coord_label", "period_label", "exact_mean", "pct_of", "round_half_up",
    "day_start", "parse_time", "utc_wall_time",
]
