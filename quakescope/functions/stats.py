"""Aggregate helpers with order-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal type of sums that are merged later: 6 places, 12 integer digits.
MEAN_DECIMAL = "decimal(18,6)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: Millionths that a double holds exactly, and the low bits of their sum that are kept apart.
_MOST, _LOW_BITS = 1 << 53, 20


def millionths(col: str | Column) -> Column:
    """The value in whole millionths; null where it is finer, past 9 * 10^9, infinite or NaN."""
    c = _c(col)
    whole = F.rint(c * F.lit(1e6)).try_cast("bigint")
    return F.when((F.abs(whole) < F.lit(_MOST)) & (whole.cast("double") / F.lit(1e6) == c), whole)


def exact_sum(col: str | Column) -> Column:
    """Sum over whole millionths where these hold every value of the group, else the plain sum.

    The sum of integers does not depend on partitioning or row order; a double
    sum may change in its last bits between runs on a cluster.  High and low
    bits are summed apart, in longs, so that no number of rows overflows them.
    """
    c = _c(col)
    m = millionths(c)
    high, low = F.sum(F.shiftright(m, _LOW_BITS)), F.sum(m.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    whole = high.cast("decimal(19,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(19,0)")
    exact = whole.cast("decimal(30,0)") * F.lit("0.000001").cast("decimal(7,6)")
    return F.when(F.count(m) == F.count(c), exact.cast("double")).otherwise(F.sum(c))


def exact_mean(col: str | Column) -> Column:
    """``exact_sum`` by the count of the same rows."""
    c = _c(col)
    return F.try_divide(exact_sum(c), F.count(c).cast("double"))


def _inexact(c: Column) -> Column:
    """Values the decimal does not hold: more than 6 places, past 10^12, infinite or NaN."""
    return F.count_if(c.isNotNull() & ~F.coalesce(c.try_cast(MEAN_DECIMAL).cast("double") == c, F.lit(False)))


def sum_parts(col: str | Column, name: str) -> list[Column]:
    """Aggregates from which ``merged_sum`` makes the sum of a larger group: exact, plain, and what the first leaves out."""
    c = _c(col)
    return [F.sum(c.try_cast(MEAN_DECIMAL)).alias(f"{name}_exact"), F.sum(c).alias(f"{name}_plain"),
            _inexact(c).alias(f"{name}_left")]


def merged_sum(name: str, times: Column | None = None) -> Column:
    """Sum over groups kept as ``sum_parts``, each ``times`` an integer column if given; as ``exact_sum`` of all rows."""
    exact, plain = F.col(f"{name}_exact"), F.col(f"{name}_plain")
    if times is not None:
        exact, plain = exact * times, plain * times
    return F.when(F.sum(f"{name}_left") == 0, F.sum(exact).cast("double")).otherwise(F.sum(plain))


def pct_of(part: str | Column, whole: str | Column, places: int = 2) -> Column:
    """``round(part / whole * 100, places)``; null when ``whole`` is 0."""
    return round_half_up(
        F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0), places)


def round_half_up(col: str | Column, places: int) -> Column:
    """Display rounding over the decimal value (so 1.005 → 1.01 at 2 places).

    What the decimal does not hold (infinite, NaN, past 10^26) is shown as it is.
    """
    c = _c(col)
    return F.coalesce(F.round(c.try_cast("decimal(38,12)"), places).cast("double"), c)
