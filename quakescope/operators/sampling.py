"""Repeatable fixed-size samples (bottom-k by hash) and the map / scatter feeds.

A row's rank is ``(md5(key || '#' || seed), key)``, so the sample is exact in
size (``min(rows, n)``), the same on every run and cluster size, and
reproducible in any SQL engine with ``md5``.

A plain ``orderBy(h).limit(n)`` keeps ``n`` rows per input partition and
merges all of them in one task, which grows with the partition count.  Here:

1. One aggregate counts rows per bucket (the first 3 hex digits: 4,096, so
   the counts fold map-side).  The bucket in which the running count reaches
   ``n`` is the *boundary*; fewer than ``n`` rows lie below it.
2. The rows up to the boundary bucket (about ``n`` plus a 4,096th of the
   table) are written to the shared folder; what follows reads only these.
3. The boundary bucket is refined by 3 more digits at a time, always the same
   way, until it holds exactly the rows still needed or the rank has no more
   digits.  Rows of one key tie on the first 32 digits; the next 32 are the
   md5 of the whole row, so they are told apart by content, not by position.
4. Rows below the boundary are kept by a filter; what is left in the boundary
   are then identical rows (or exactly the rows needed), of which a limit
   takes the missing number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.functions.labels import cluster_color, cluster_label
from quakescope.session import scratch_path

STEP = 3             # hex digits per refinement: 4,096 buckets
KEY_DIGITS = 32      # of the key's hash; as many of the row's follow


def sample_hash(key: str | Column, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(k.cast("string"), F.lit("")), F.lit(f"#{seed}")))


def _prefix(df: DataFrame, key: str, seed: int, digits: int) -> Column:
    """The first ``digits`` hex digits of a row's rank."""
    head = sample_hash(key, seed)
    if digits <= KEY_DIGITS:
        return F.substring(head, 1, digits)
    whole = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])))
    return F.concat(head, F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.substring(whole, 1, digits - KEY_DIGITS))


def _boundary(rows: DataFrame, prefix: Column, need: int) -> tuple[str, int, int] | None:
    """(bucket in which the running count reaches ``need``, rows below it, rows in it)."""
    counts = rows.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # 4,096 at most
    below = 0
    for r in counts:
        if below + r["n"] >= need:
            return r["p"], below, r["n"]
        below += r["n"]
    return None


def bottom_k(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """The ``n`` rows with the smallest ``(hash, key)`` (all rows when fewer).

    Two passes over the input: one counts, one writes the candidates.
    """
    if n <= 0:
        return df.limit(0)
    cut = _boundary(df, _prefix(df, key, seed, STEP), n)
    if cut is None:                      # fewer than n rows: all of them
        return df
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "sample")
    bucket, below, size = cut
    df.filter(_prefix(df, key, seed, STEP) <= F.lit(bucket)).write.parquet(path)
    near = spark.read.schema(df.schema).parquet(path)
    sure, edge, digits = near.filter(_prefix(df, key, seed, STEP) < F.lit(bucket)), near, STEP
    edge = near.filter(_prefix(df, key, seed, STEP) == F.lit(bucket))
    need = n - below
    while size > need and digits < 2 * KEY_DIGITS:
        digits = min(digits + STEP, 2 * KEY_DIGITS) if digits >= KEY_DIGITS else min(digits + STEP, KEY_DIGITS)
        prefix = _prefix(df, key, seed, digits)
        bucket, below, size = _boundary(edge, prefix, need)
        sure = sure.unionByName(edge.filter(prefix < F.lit(bucket)))
        edge = edge.filter(prefix == F.lit(bucket))
        need -= below
    return sure.unionByName(edge.limit(need) if size > need else edge)


def heatmap_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return bottom_k(df, n, seed).select("latitude", "longitude", "mag")


def scatter_map_sample(df: DataFrame, n: int, seed: int = 1) -> DataFrame:
    cols = ["latitude", "longitude", "mag", "depth"] + (["place"] if "place" in df.columns else [])
    return bottom_k(df, n, seed).select(*cols)


def depth_mag_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return bottom_k(df, n, seed).select("depth", "mag", "mag_category")


def cluster_map_sample(clustered: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Sampled points of the zone map with their zone label and colour."""
    return (bottom_k(clustered, n, seed)
            .select("latitude", "longitude", cluster_label("cluster").alias("cluster_label"),
                    cluster_color("cluster").alias("color")))
