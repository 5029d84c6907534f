"""Filters and predicates (FI1-FI8). All are pushed down by Catalyst where the
column comes straight from a scan; NULL never satisfies a comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import col


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` IS NULL (FI1)."""
    return df.filter(col(column).isNull())


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count per listed column, one pass, one row (FI1 + count)."""
    return df.agg(*[F.count_if(col(c).isNull()).alias(f"null_{c}") for c in columns])


def flag_rows(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose boolean flag is true; NULL flags are excluded (FI2)."""
    return df.filter(col(flag))


def threshold_rows(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """Rows where ``column op value`` for op in > >= < <= = != (FI3)."""
    c = col(column)
    ops = {">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value, "=": c == value, "!=": c != value}
    return df.filter(ops[op])


def out_of_range_rows(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows with ``column < lo OR column > hi`` (FI4)."""
    return df.filter((col(column) < lo) | (col(column) > hi))


def inconsistent_flag_rows(df: DataFrame, value: str = "Profit", flag: str = "Is_Loss") -> DataFrame:
    """Rows whose flag disagrees with the value's sign (FI5)."""
    v, f = col(value), col(flag)
    return df.filter(((v < 0) & (f == F.lit(False))) | ((v >= 0) & (f == F.lit(True))))


def null_state_rows(df: DataFrame, key: str, first, value: str) -> DataFrame:
    """Rows violating 'first key has NULL value, later keys have a value' (FI6)."""
    k, v = col(key), col(value)
    return df.filter(((k == first) & v.isNotNull()) | ((k > first) & v.isNull()))


def miscased_rows(df: DataFrame, column: str = "Region") -> DataFrame:
    """Rows where the text differs from its title-cased form; NULL is not flagged (FI7)."""
    return df.filter(col(column) != F.initcap(col(column)))


def tolerance_violations(df: DataFrame, actual: str, expected, tol: float = 0.01) -> DataFrame:
    """Rows where |actual - expected| > tol (FI8); ``expected`` is a Column."""
    return df.filter(F.abs(col(actual) - expected) > tol)
