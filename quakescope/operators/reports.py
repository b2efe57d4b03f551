"""Group-by reports over a cleaned catalogue.

Every report is one hash/sort aggregate with a partial (map-side) stage, so a
class, month or cell holding a third of all rows is folded per input
partition before the shuffle.  Results are small by construction (bounded
label sets, calendar periods, grid cells); top-k reports end in
``TakeOrderedAndProject``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakescope.functions.classes import mag_class_six
from quakescope.functions.grid import snap_away, snap_even
from quakescope.functions.stats import exact_mean, exact_sum, pct_of, round_half_up
from quakescope.operators.clean import cleaning_predicate, present
from quakescope.operators.payload import record_ok

# Payload size assumed per record by the ingestion report.
EST_BYTES_PER_RECORD = 200
BYTES_PER_MB = 1024 * 1024


def _class_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("jumlah"))


def mag_distribution(df: DataFrame, col: str = "mag_category") -> DataFrame:
    """Events per magnitude class, most frequent first."""
    return _class_counts(df, col).orderBy(F.desc("jumlah"), F.asc(col))


def mag_share(df: DataFrame, col: str | None = None) -> DataFrame:
    """Events per 6-way class and share of all events (pie feed).

    The share's window runs over the already-aggregated classes (at most six
    rows), never over the events.
    """
    if col is None:
        df = df.withColumn("mag_category", mag_class_six("mag"))
        col = "mag_category"
    counts = _class_counts(df, col)
    total = F.sum("jumlah").over(Window.partitionBy())
    return counts.withColumn("share", F.col("jumlah").cast("double") / total.cast("double"))


def depth_distribution(df: DataFrame, col: str = "depth_category") -> DataFrame:
    return _class_counts(df, col).orderBy(F.asc(col))


def _activity(df: DataFrame, keys: list[str], with_max: bool = True) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("jumlah"), exact_mean("mag").alias("avg_mag")]
    if with_max:
        aggs.append(F.max("mag").alias("max_mag"))
    return df.groupBy(*keys).agg(*aggs)


def monthly(df: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """Events, mean and max magnitude per (year, month); ascending, unknown first.

    ``keep_unknown=False`` drops the group of unparseable times (dashboard).
    """
    if not keep_unknown:
        df = df.filter(F.col("year").isNotNull())
    return _activity(df, ["year", "month"]).orderBy("year", "month")


def daily(df: DataFrame) -> DataFrame:
    """Events and mean magnitude per calendar day (unknown days dropped)."""
    return _activity(df.filter(F.col("day").isNotNull()), ["day"], with_max=False).orderBy("day")


def yearly(df: DataFrame) -> DataFrame:
    """Events, mean and max magnitude per known year."""
    return _activity(df.filter(F.col("year").isNotNull()), ["year"]).orderBy("year")


def hotspots(df: DataFrame, k: int, decimals: int = 0, ties: str = "away") -> DataFrame:
    """Top-k grid cells by event count, with mean and max magnitude.

    ``ties='away'`` snaps with half-away-from-zero (batch job), ``'even'``
    with half-to-even (pandas twin and dashboard).  Ties in the count are
    broken by the cell coordinates so the cut is repeatable.
    """
    snap = snap_away if ties == "away" else snap_even
    cells = (df.select(snap("latitude", decimals).alias("lat_grid"),
                       snap("longitude", decimals).alias("lon_grid"), "mag")
             .groupBy("lat_grid", "lon_grid")
             .agg(F.count(F.lit(1)).alias("event_count"),
                  exact_mean("mag").alias("avg_mag"),
                  F.max("mag").alias("max_mag")))
    return cells.orderBy(F.desc("event_count"), "lat_grid", "lon_grid").limit(k)


def density_grid(df: DataFrame, decimals: int = 1) -> DataFrame:
    """Magnitude-weighted density per 0.1° cell (heatmap feed), every cell."""
    return (df.select(snap_even("latitude", decimals).alias("lat_grid"),
                      snap_even("longitude", decimals).alias("lon_grid"),
                      "mag")
            .groupBy("lat_grid", "lon_grid")
            .agg(F.count(F.lit(1)).alias("event_count"), exact_sum("mag").alias("mag_weight")))


def global_stats(df: DataFrame) -> DataFrame:
    """Count, mean/max/min/sample-std magnitude and mean depth, report-rounded."""
    return df.agg(
        F.count(F.lit(1)).alias("total_events"),
        round_half_up(exact_mean("mag"), 3).alias("avg_magnitude"),
        round_half_up(F.max("mag"), 3).alias("max_magnitude"),
        round_half_up(F.min("mag"), 3).alias("min_magnitude"),
        round_half_up(F.stddev_samp("mag"), 3).alias("std_magnitude"),
        round_half_up(exact_mean("depth"), 2).alias("avg_depth_km"),
    )


def kpis(df: DataFrame) -> DataFrame:
    """Header KPIs: rows in view and the largest magnitude (null when empty)."""
    return df.agg(F.count(F.lit(1)).alias("total_record"), F.max("mag").alias("max_mag"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def quality_report(raw: DataFrame) -> DataFrame:
    """Raw, clean and dropped counts and the dropped share, in one pass.

    Rows that pass the rule are grouped by their dedup key (a struct, so a
    key with null parts is still a key); rows that fail all share the null
    group, which partial aggregation folds to one row per input partition.
    The exchange therefore carries only the distinct keys of passing rows.
    """
    ok = F.coalesce(cleaning_predicate(), F.lit(False))
    key = F.when(ok, F.struct(F.col("time"), F.col("latitude"), F.col("longitude")))
    per_key = raw.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("raw_records"),
        F.count("_k").cast("bigint").alias("clean_records"))
    dropped = F.col("raw_records") - F.col("clean_records")
    return totals.select(
        "raw_records", "clean_records", dropped.alias("dropped_records"),
        pct_of(dropped, "raw_records").alias("veracity_pct"),
        (F.lit(100.0) - pct_of(dropped, "raw_records")).alias("valid_pct"),
    )


def ingestion_report(df: DataFrame) -> DataFrame:
    """Records, payloads built, failures, loss % and estimated volume in MB.

    A record fails when a numeric payload field carries text that is not a
    number; a null number is fine (it is sent as 0.0 or NaN).
    """
    counts = df.agg(F.count(F.lit(1)).alias("total_records"),
                    F.count_if(record_ok(df)).alias("success_count"))
    fail = F.col("total_records") - F.col("success_count")
    return counts.select(
        "total_records", "success_count", fail.alias("fail_count"),
        F.coalesce(F.try_divide(fail.cast("double"), F.col("total_records").cast("double"))
                   * F.lit(100.0), F.lit(0.0)).alias("data_loss_pct"),
        round_half_up(F.col("success_count").cast("double") * F.lit(float(EST_BYTES_PER_RECORD))
                      / F.lit(float(BYTES_PER_MB)), 2).alias("estimated_mb"),
    )


def mag_histogram(df: DataFrame, bins: int = 50, bounds: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width magnitude histogram over [min, max]; the max falls in the last bin.

    The two bounds come from one bounded aggregate row, or are given (then the
    rows are read once; magnitudes outside are left out); bin edges are
    derived from them, so every non-empty bin is listed with its edges.  Missing
    magnitudes (null, NaN) are not binned; when all magnitudes are equal,
    everything falls in bin 1.
    """
    df = df.filter(present("mag"))
    if bounds is None:
        lo, hi = df.agg(F.min("mag").alias("lo"), F.max("mag").alias("hi")).first()
    else:
        lo, hi = bounds
        df = df.filter(F.col("mag").between(float(lo), float(hi)))
    if lo is None:
        return df.select(F.lit(1).alias("bin"), F.lit(0.0).alias("bin_lo"),
                         F.lit(0.0).alias("bin_hi"), F.lit(0).cast("bigint").alias("jumlah")).limit(0)
    lo_c, hi_c, n = F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)
    width = hi_c - lo_c
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("mag") - lo_c) * n / width) + 1, n)).cast("int")
    counts = df.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("jumlah"))
    return counts.select(
        "bin",
        (lo_c + (F.col("bin") - 1) * width / n).alias("bin_lo"),
        (lo_c + F.col("bin") * width / n).alias("bin_hi"),
        "jumlah",
    ).orderBy("bin")


# --- the batch job's four reports in one pass --------------------------------

_SETS = {  # grouping-set name → its keys
    "mag": ["mag_category"],
    "month": ["year", "month"],
    "cell": ["lat_grid", "lon_grid"],
    "all": [],
}


def report_pass(clean_df: DataFrame) -> DataFrame:
    """Class, month, 1° cell and global aggregates of one scan (``GROUPING SETS``).

    One Expand feeds one partial + final aggregate around one exchange, so the
    cleaned table is read once for all four reports.  ``_set`` names the
    grouping set of each row; a null key inside its own set is a real null
    (the unknown-time month group).
    """
    keyed = clean_df.select("mag_category", "year", "month",
                            snap_away("latitude", 0).alias("lat_grid"),
                            snap_away("longitude", 0).alias("lon_grid"), "mag", "depth")
    keys = ["mag_category", "year", "month", "lat_grid", "lon_grid"]
    gid = F.grouping_id(*keys)
    sets = [[F.col(k) for k in ks] for ks in _SETS.values()]
    grouped = keyed.groupingSets(sets, *keys).agg(
        gid.alias("_gid"),
        F.count(F.lit(1)).alias("n"),
        exact_mean("mag").alias("avg_mag"),
        F.max("mag").alias("max_mag"),
        F.min("mag").alias("min_mag"),
        F.stddev_samp("mag").alias("std_mag"),
        exact_mean("depth").alias("avg_depth"))
    names = F.lit(None).cast("string")
    for name, ks in _SETS.items():
        bits = sum(1 << (len(keys) - 1 - keys.index(k)) for k in keys if k not in ks)
        names = F.when(F.col("_gid") == bits, F.lit(name)).otherwise(names)
    return grouped.withColumn("_set", names).drop("_gid")


def split_report_pass(combined: DataFrame, top_k: int = 200,
                      ordered: bool = True) -> dict[str, DataFrame]:
    """The four reports, shaped exactly like their single-pass counterparts.

    ``ordered=False`` leaves the class and month parts unsorted (the caller
    sorts the bounded rows itself); the cell part always keeps its top-k cut.
    """
    def part(name):
        return combined.filter(F.col("_set") == name)

    mags = part("mag").select("mag_category", F.col("n").alias("jumlah"))
    months = part("month").select("year", "month", F.col("n").alias("jumlah"), "avg_mag", "max_mag")
    if ordered:
        mags = mags.orderBy(F.desc("jumlah"), F.asc("mag_category"))
        months = months.orderBy("year", "month")
    return {
        "mag_distribution": mags,
        "monthly": months,
        "hotspots": part("cell").select("lat_grid", "lon_grid", F.col("n").alias("event_count"),
                                        "avg_mag", "max_mag")
        .orderBy(F.desc("event_count"), "lat_grid", "lon_grid").limit(top_k),
        # grouping sets give no row at all on an empty input; a global
        # aggregate over the (at most one) "all" row always gives exactly one
        "global_stats": part("all").agg(
            F.coalesce(F.max("n"), F.lit(0)).alias("total_events"),
            round_half_up(F.max("avg_mag"), 3).alias("avg_magnitude"),
            round_half_up(F.max("max_mag"), 3).alias("max_magnitude"),
            round_half_up(F.max("min_mag"), 3).alias("min_magnitude"),
            round_half_up(F.max("std_mag"), 3).alias("std_magnitude"),
            round_half_up(F.max("avg_depth"), 2).alias("avg_depth_km")),
    }


def collect_report_pass(combined: DataFrame, top_k: int = 200) -> dict[str, list[dict]]:
    """The four reports' rows from one job (a tagged union of bounded parts).

    Every part is small (≤ 5 classes, months, ``top_k`` cells, one row), so
    the union is collected once instead of running four jobs; each part keeps
    its own columns and order.
    """
    parts = split_report_pass(combined, top_k, ordered=False)
    packed = None
    for name, df in parts.items():
        tagged = df.select(F.lit(name).alias("_part"), F.monotonically_increasing_id().alias("_i"),
                           *df.columns)
        packed = tagged if packed is None else packed.unionByName(tagged, allowMissingColumns=True)
    out: dict[str, list[dict]] = {name: [] for name in parts}
    for r in sorted(packed.collect(), key=lambda r: (r["_part"], r["_i"])):
        out[r["_part"]].append({c: r[c] for c in parts[r["_part"]].columns})
    # the same orders as the single reports (nulls first, as Spark sorts them)
    out["mag_distribution"].sort(key=lambda r: (-r["jumlah"], r["mag_category"] is not None,
                                                r["mag_category"] or ""))
    out["monthly"].sort(key=lambda r: (r["year"] is not None, r["year"] or 0,
                                       r["month"] is not None, r["month"] or 0))
    return out
