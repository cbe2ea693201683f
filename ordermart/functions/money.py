"""Money arithmetic that gives the same answer on any engine and any partitioning.

* amounts are summed as DECIMAL(28,6) (exact, order independent), rounded once to cents, and leave
  as double;
* ratios are rounded HALF_UP on a DECIMAL(28,10) image of the double, which is what
  Spark's ``round`` intends and is reproducible in SQL engines;
* every division is ``try_divide`` (NULL on a zero divisor, as the non-ANSI reference got).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def in_cents(total: Column) -> Column:
    """An exact total, rounded HALF_UP to cents, as double."""
    return F.round(total, 2).cast("double")


def money_sum(c: Column | str) -> Column:
    """Exact sum of an amount column, rounded once to cents, as double."""
    return in_cents(F.sum(money(c)))


def money_avg(c: Column | str, scale: int = 2) -> Column:
    """round(sum/count) of the exact, unrounded sum; NULL for an empty group."""
    c = F.col(c) if isinstance(c, str) else c
    return round_half_up(F.try_divide(F.sum(money(c)).cast("double"), F.count(c).cast("double")), scale)


def round_half_up(c: Column, scale: int) -> Column:
    return F.round(c.cast("decimal(28,10)"), scale).cast("double")


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))
