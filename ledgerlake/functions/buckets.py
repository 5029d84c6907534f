"""Discount bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.config import DISCOUNT_BUCKET_OVERFLOW, DISCOUNT_BUCKETS


def discount_bucket(discount: Column) -> Column:
    """First matching label: == 0, then <= each bound (inclusive), else overflow.

    A NULL discount falls through to the overflow label, as a CASE chain does.
    """
    (zero, zero_label), *rest = DISCOUNT_BUCKETS
    expr = F.when(discount == F.lit(zero), F.lit(zero_label))
    for bound, label in rest:
        expr = expr.when(discount <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(DISCOUNT_BUCKET_OVERFLOW))
