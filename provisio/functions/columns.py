"""Column-expression helpers (all JVM-side, codegen-friendly; no Python UDFs).

The reference computes on pandas, where division by zero gives +-inf or NaN
and NaN is the missing value.  Spark 4 runs in ANSI mode, so the helpers
below spell those rules out explicitly instead of relying on ``/``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(n, d) -> Column:
    """pandas-style ``n / d``: x/0 -> +-inf, 0/0 -> NULL (NaN), NULL in -> NULL."""
    n, d = col(n), col(d)
    return (F.when(d == 0,
                   F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF)))
             .otherwise(F.try_divide(n.cast("double"), d.cast("double"))))


def ratio0(n, d) -> Column:
    """``ratio`` followed by pandas ``fillna(0)`` (NaN -> 0, inf kept)."""
    return F.coalesce(ratio(n, d), F.lit(0.0))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def finite0(c) -> Column:
    """inf/-inf/NaN/NULL -> 0 (the ML-feature cleaning rule)."""
    c = col(c).cast("double")
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(0.0)).otherwise(c)


def r4(c) -> Column:
    """Round half-even to 4 decimals, as the reference's ``.round(4)``."""
    return F.bround(col(c).cast("double"), 4)


def clip(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col(c), F.lit(float(lo))), F.lit(float(hi)))


def mean_flag(cond: Column) -> Column:
    """Share of rows where ``cond`` holds (NULL rows count as not holding)."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def sqrt_nan(c) -> Column:
    """``numpy.sqrt``: negative -> NaN (mapped to NULL), inf -> inf."""
    c = col(c)
    return F.when(c < 0, F.lit(None).cast("double")).otherwise(F.sqrt(c))


def weekday_mon0(d) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(col(d))


def in_months(month, months) -> Column:
    return col(month).isin(list(months)).cast("int")


_DECIMALS = 9


def exact_parts(c) -> tuple[Column, Column]:
    """Aggregates: the two longs whose sums are the exact sum of a column; they can be added up again over groups.

    Each row is split into its whole part and its fraction in 10^-9 units (what lies below is binary
    noise of a double), and both are summed as longs: fast, independent of the order, and far from
    overflow (which would raise under ANSI mode, not wrap)."""
    x = col(c).cast("double")
    whole = F.floor(x)
    fraction = F.floor((x - whole) * F.lit(float(10 ** _DECIMALS)) + F.lit(0.5)).cast("long")
    return F.sum(whole.cast("long")), F.sum(fraction)


def _units(whole: Column, fraction: Column) -> Column:
    """The exact sum of two summed parts in units of 10^-9, as decimal(38,0)."""
    return (whole.cast("decimal(38,0)") * F.lit(10 ** _DECIMALS).cast("decimal(10,0)") + fraction.cast("decimal(38,0)")).cast("decimal(38,0)")


def sum_of_parts(whole: Column, fraction: Column) -> Column:
    """Aggregate: the exact sum from its summed parts, as a double."""
    return (_units(whole, fraction).cast("decimal(38,9)") / F.lit(10 ** _DECIMALS).cast("decimal(10,0)")).cast("double")


def exact_sum(c) -> Column:
    """Aggregate: exact sum of a column, as a double; rows are not rounded before they are added."""
    return sum_of_parts(*exact_parts(c))


def mean_of_parts_r4(whole: Column, fraction: Column, n: Column) -> Column:
    """Aggregate: mean rounded half-even to 4 decimals, computed exactly from the summed parts and the count.

    The exact sum is divided once per group with an integer half-even rule in
    decimal(38,0), so the result does not depend on summation order or on
    binary representation (a mean such as 54403.03625 sits exactly on a tie).
    """
    # The rule names its inputs several times; as fields of one struct they are computed once per group.
    once = F.array(F.struct((_units(whole, fraction) * F.lit(10000)).alias("m"), n.alias("n")))
    return F.element_at(F.transform(once, lambda s: _half_even(s["m"], s["n"])), 1)


def mean_r4(c) -> Column:
    """Aggregate: mean of a column rounded half-even to 4 decimals, computed exactly."""
    return mean_of_parts_r4(*exact_parts(c), F.count(col(c)))


def _half_even(m: Column, n: Column) -> Column:
    """``m`` / (``n`` x 10^9) rounded half-even to an integer, in units of 10^-4; NULL for ``n`` = 0."""
    d = n.cast("decimal(19,0)") * F.lit(10 ** _DECIMALS).cast("decimal(10,0)")
    a = F.abs(m)
    r = a % d
    q = ((a - r) / d).cast("long")
    rounded = q + F.when(r * 2 > d, 1).when(r * 2 == d, q % 2).otherwise(0)
    signed = F.when(m < 0, -rounded).otherwise(rounded)
    return F.when(n == 0, F.lit(None).cast("double")).otherwise(signed.cast("double") / F.lit(10000.0))
