"""Correlation of measures: Pearson's coefficient and Spearman's, with tied ranks.

Ranks come from the distinct values' counts: these are dealt into ranges, a
running sum within each range and the ranges' totals before it give every
value's mean rank.  No window spans the table, and a value that a third of the
rows share is one counted row.  Pairs of values are counted before they meet
their ranks, and the sums behind the coefficient are integers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakescope.operators.clean import feature_rows
from quakescope.schema import FEATURES
from quakescope.session import stored

SCHEMA = "x string, y string, events long, pearson double, spearman double"


def twice_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, value, n, rank2: every distinct value of each column with twice its mean rank (an integer)."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(c) + F.lit(0.0)).alias("value")) for c in columns]))
    counts = df.select(each.alias("v")).select("v.*").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = stored(counts.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ahead = ranged.groupBy("feature", "part").agg(F.sum("n").alias("all")).select("feature", "part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("feature", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(ahead, ["feature", "part"])
    return placed.select("feature", "value", "n", (2 * (F.col("ahead") + F.col("within")) + F.col("n") + 1).alias("rank2"))


def _coefficient(n: int, x: int, y: int, xx: int, yy: int, xy: int) -> float | None:
    a, b = n * xx - x * x, n * yy - y * y
    return (n * xy - x * y) / math.sqrt(a * b) if a > 0 and b > 0 else None


def correlation(df: DataFrame, pairs: Sequence[tuple[str, str]], columns: Sequence[str] = FEATURES) -> DataFrame:
    """x, y, events, pearson, spearman for each pair of columns.

    Rows with all ``columns`` present count.  A coefficient is null where a
    column has no spread.  The input is read once for the ranks and once for
    each pair.
    """
    spark = df.sparkSession
    rows = feature_rows(df, columns)
    used = sorted({c for pair in pairs for c in pair})
    ranks = stored(twice_ranks(rows, used), "ranks")
    plain = rows.agg(*[F.covar_pop(x, y).alias(f"p{i}") for i, (x, y) in enumerate(pairs)], *[F.stddev_pop(c).alias(c) for c in used]).first()
    result = []
    big = "decimal(38,0)"
    for i, (x, y) in enumerate(pairs):
        joint = rows.groupBy((F.col(x) + F.lit(0.0)).alias("a"), (F.col(y) + F.lit(0.0)).alias("b")).agg(F.count(F.lit(1)).alias("w"))
        of = lambda c, value, name: ranks.filter(F.col("feature") == c).select(F.col("value").alias(value), F.col("rank2").cast("decimal(19,0)").alias(name))
        ranked = joint.join(of(x, "a", "r"), "a").join(of(y, "b", "s"), "b").withColumn("w", F.col("w").cast("decimal(19,0)"))
        r, s, w = F.col("r"), F.col("s"), F.col("w")
        sums = ranked.agg(*[F.coalesce(F.sum((w * t).cast(big)), F.lit(0)).cast(big).alias(n) for n, t in
                            (("n", F.lit(1)), ("x", r), ("y", s), ("xx", (r * r).cast(big)), ("yy", (s * s).cast(big)), ("xy", (r * s).cast(big)))]).first()
        n, *rest = (int(v) for v in sums)
        spread = (plain[x] or 0.0) * (plain[y] or 0.0)
        result.append((x, y, n, plain[f"p{i}"] / spread if spread > 0 else None, _coefficient(n, *rest)))
    return spark.createDataFrame(result, SCHEMA)
