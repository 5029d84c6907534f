"""Numeric helpers.

Money totals are summed as DECIMAL so that they do not depend on the order in
which partitions are merged (a double sum does), then turned back into DOUBLE
at the surface. ``round`` on a DOUBLE rounds half-up on its shortest decimal
text (0.285 -> 0.29), which is what the marts report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Type of exact sums: values below MONEY_LIMIT in size with up to six decimals.
# Wider than the data's two decimals, so the cast never moves a value across a
# rounding boundary. A value beyond the limit or not finite counts as missing
# in totals and averages alike; coerce_types() turns such values into NULL.
SUM_TYPE = DecimalType(24, 6)
MONEY_LIMIT = 1e18


def money(c: Column) -> Column:
    """The value as it enters exact sums; NULL where no exact sum can hold it."""
    return c.try_cast(SUM_TYPE)


def round_money_sum(c: Column, scale: int = 2) -> Column:
    """round(sum(c), scale), computed exactly."""
    return F.round(F.sum(money(c)), scale).cast("double")


def exact_avg(c: Column) -> Column:
    """avg(c) over the values that enter exact sums; NULL for no values."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(money(c)).cast("double"))


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den * 100, scale); NULL when den is 0 or NULL."""
    return F.round(F.try_divide(num, den) * F.lit(100), scale)


def clamp(c: Column, lo: float, hi: float) -> Column:
    """least(greatest(c, lo), hi); greatest/least skip NULL, so NULL -> lo."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
