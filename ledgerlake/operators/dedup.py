"""Deduplication (DD1-DD5).

``keep_first`` keeps, per key, the row that sorts first over all data columns
(rows whose ``complete`` columns are all filled before others, then ascending
with NULLs last), so a good copy is never lost to one with a gap. It asks for
the first row number of a window, which Spark also limits before a shuffle:
every map task reduces a hot key to one row, so a key holding a third of all
rows never lands whole in one task. Rows are sorted once and never copied into
aggregation buffers. The result is the same on every run and every partitioning.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.text import col
from ledgerlake.operators.skew import SLICE


def keep_first(df: DataFrame, key: list[str], order_cols: list[str] | None = None,
               complete: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the smallest by ``order_cols`` (default all non-'_' columns).

    Columns not in ``order_cols`` (metadata) are carried along from the chosen row.
    """
    order_cols = order_cols or [c for c in df.columns if not c.startswith("_")]
    gap = reduce(or_, [col(c).isNull() for c in complete or [] if c in df.columns], F.lit(False))
    order = [gap.asc(), *[col(c).asc_nulls_last() for c in order_cols if c not in key]]
    first = F.row_number().over(Window.partitionBy(*[col(k) for k in key]).orderBy(*order))
    return df.withColumn("__first", first).filter(F.col("__first") == 1).drop("__first")


def keep_first_sliced(df: DataFrame, key: list[str], **options) -> DataFrame:
    """``keep_first`` of a table stored by key and slice (skew.with_slices).

    Ordinary rows (slice 0) are reduced within their buckets, where a table stored so needs no
    shuffle. The rows of a heavy key are reduced in each slice's task before they meet.
    """
    if SLICE not in df.columns:
        return keep_first(df, key, **options)
    plain = keep_first(df.filter(F.col(SLICE) == 0), [key[0], SLICE, *key[1:]], **options)
    return plain.unionByName(keep_first(df.filter(F.col(SLICE) > 0), key, **options))


def dedup_report(df: DataFrame, key: list[str]) -> DataFrame:
    """before / after / removed / removed_pct in one pass (DD2, DD4).

    ``count(DISTINCT struct(key))`` keeps keys with a NULL part (a multi-column
    ``count(DISTINCT a, b)`` would skip them).
    """
    agg = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(F.struct(*[col(k) for k in key])).alias("rows_after"),
    )
    return agg.withColumns(
        {
            "rows_removed": F.col("rows_before") - F.col("rows_after"),
            "removed_pct": F.round(F.try_divide(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")) * 100, 2),
        }
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (DD5)."""
    return df.select(col(column)).distinct()
