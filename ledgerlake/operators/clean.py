"""Null handling and cleaning (CL1-CL12, FI9).

Every parse or cast of user data goes through a ``try_*`` function: under ANSI
mode a bad value becomes NULL instead of failing the job, while genuine
program errors still raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, NumericType, StringType

from ledgerlake.config import (
    DATE_COLS,
    DOUBLE_COLS,
    FILL_DEFAULTS,
    INT_COLS,
    MANDATORY_COLS,
    TEXT_COLS,
)
from ledgerlake.functions.dates import parse_date
from ledgerlake.functions.numeric import MONEY_LIMIT, clamp
from ledgerlake.functions.text import col, title_case


def present(df: DataFrame, cols) -> list[str]:
    """The listed columns that exist in ``df`` (driver-side, no job)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def drop_mandatory_nulls(df: DataFrame, cols=MANDATORY_COLS) -> DataFrame:
    """Drop rows with a NULL in any (present) mandatory column (CL1)."""
    subset = present(df, cols)
    return df.dropna(how="any", subset=subset) if subset else df


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Replace NULLs by per-column defaults (CL2).

    The default is converted to the column's type with ``try_cast`` (a default
    that does not fit becomes NULL rather than raising); absent columns are
    skipped.
    """
    defaults = FILL_DEFAULTS if defaults is None else defaults
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    changes = {
        c: F.coalesce(col(c), F.lit(v).try_cast(types[c]))
        for c, v in defaults.items()
        if c in types
    }
    return df.withColumns(changes) if changes else df


def standardize_text(df: DataFrame, cols=TEXT_COLS) -> DataFrame:
    """Trim + title-case text columns in one projection (CL4)."""
    changes = {c: title_case(col(c)) for c in present(df, cols)}
    return df.withColumns(changes) if changes else df


def parse_dates(df: DataFrame, cols=DATE_COLS, formats: list[str] | None = None) -> DataFrame:
    """Text/timestamp date columns -> DATE; unparseable text -> NULL (CL6)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    changes = {c: parse_date(col(c), types[c], formats) for c in present(df, cols)}
    return df.withColumns(changes) if changes else df


def coerce_types(df: DataFrame, doubles=DOUBLE_COLS, ints=INT_COLS) -> DataFrame:
    """Cast by map with ``try_cast`` (CL8); NaN, infinities and sizes from MONEY_LIMIT on become NULL on doubles.

    Text such as 'abc' in a number column becomes NULL. Integer columns take
    any finite number in range ('3.0', ' 3 ', '3.7') and drop its fraction;
    other text, and numbers out of range ('1e20'), become NULL.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    changes = {}
    for c in present(df, doubles):
        src = types[c]
        if isinstance(src, StringType):
            v = col(c).try_cast(DoubleType())
        elif isinstance(src, (DoubleType, FloatType)):
            v = col(c).cast(DoubleType())
        elif isinstance(src, NumericType):
            v = col(c).cast(DoubleType())
        else:
            v = col(c).try_cast(DoubleType())
        changes[c] = F.when(F.abs(v) < F.lit(MONEY_LIMIT), v)
    for c in present(df, ints):
        src = types[c]
        if isinstance(src, IntegerType):
            changes[c] = col(c)
        elif isinstance(src, (DoubleType, FloatType, StringType)):
            v = col(c).try_cast(DoubleType())
            changes[c] = F.when(F.abs(v) < 2147483648.0, v).try_cast(IntegerType())
        else:
            changes[c] = col(c).try_cast(IntegerType())
    return df.withColumns(changes) if changes else df


def clamp_discount(df: DataFrame, column: str = "Discount", lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Clamp to [lo, hi] (CL9); NULL becomes ``lo`` because greatest skips NULL."""
    if column not in df.columns:
        return df
    return df.withColumn(column, clamp(col(column), lo, hi))


def remove_invalid_sales(df: DataFrame, column: str = "Sales") -> DataFrame:
    """Keep rows with Sales > 0 (FI9); NULL Sales is removed too."""
    return df.filter(col(column) > 0)


def null_profile(df: DataFrame, skip_prefix: str = "_", max_null_pct: float | None = None) -> DataFrame:
    """NULL count and share per column in ONE pass (CL10-CL12).

    Rows: (column, null_count, null_pct, over_limit). A single aggregate
    computes every count; the one-row result is unpivoted with ``stack`` so
    the report stays a DataFrame. ``over_limit`` compares ``null_pct`` with
    ``max_null_pct`` (the declared ceiling; NULL when no ceiling is given).
    """
    cols = [c for c in df.columns if not c.startswith(skip_prefix)]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("total", f"stack({len(cols)}, {pairs}) AS (`column`, null_count)")
    pct = F.round(F.try_divide(F.col("null_count"), F.col("total")) * 100, 2)
    limit = F.lit(None).cast("boolean") if max_null_pct is None else pct > F.lit(max_null_pct)
    return long.select("column", "null_count", pct.alias("null_pct"), limit.alias("over_limit"))


def distinct_before_after(df: DataFrame, cols=TEXT_COLS) -> DataFrame:
    """Distinct values per text column before and after title-casing, one scan and one job (CL5).

    Each row becomes one (column, value) pair per column; map tasks reduce the
    pairs to their distinct ones before the shuffle, and only distinct values
    are title-cased and counted. An all-NULL column reports 0 / 0.
    """
    cols = present(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, distinct_before bigint, distinct_after bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.column", "p.value").distinct()
    titles = values.groupBy("column", title_case(F.col("value")).alias("title")).agg(F.count("value").alias("n"))
    return titles.groupBy("column").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("distinct_before"),
        F.count("title").alias("distinct_after"),
    )
