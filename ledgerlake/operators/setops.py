"""Set operations (SO1-SO4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions.text import col
from ledgerlake.sources.files import missing_columns, union_by_name

__all__ = ["append_rows", "coverage_gap", "expected_values", "missing_columns", "union_by_name"]


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """df UNION ALL extra, by name (SO2)."""
    return df.unionByName(extra, allowMissingColumns=True)


def expected_values(spark: SparkSession, column: str, values: list, ddl_type: str) -> DataFrame:
    """A literal one-column frame of expected values (bounded by the list)."""
    return spark.createDataFrame([(v,) for v in values], f"`{column}` {ddl_type}")


def coverage_gap(expected: DataFrame, actual: DataFrame, column: str) -> DataFrame:
    """Expected values absent from ``actual`` (SO3): expected LEFT ANTI JOIN actual.

    Extras in ``actual`` are ignored. The expected side is tiny and literal,
    the actual side is reduced to distinct values before the join.
    """
    return expected.join(actual.select(col(column)).distinct(), on=column, how="left_anti")
