"""Window operators (WI1-WI6) and a distributed global rank.

Ranks inside a partition (``rank_within``) are plain windows: after a mart's
aggregation the partitions are small. A rank over the WHOLE frame is
different: ``Window.orderBy`` without a partition moves every row into one
task. ``global_rank`` computes the same numbers without that:

1. store the input, reduce it to distinct values with their multiplicity
   (partial aggregate, so a value held by a third of the rows is one row per
   map task) and store those (reliably, in the shared folder);
2. range-partition the distinct values (``repartitionByRange``, as many ranges
   as their count asks for) and store them with the number of their range;
3. rank inside each range with a window partitioned by range, and add the
   number of rows in all earlier ranges (a table with one row per range);
4. join the rank back on the value (AQE splits a skewed value on the big side).

Ties share a rank and leave a gap after, as with ``rank()``; the rank is a
bigint, as it may exceed what an int holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.text import col
from ledgerlake.operators.joins import bounded_broadcast
from ledgerlake.session import passing_rows, stored_rows

RANGE_ROWS = 2_000_000  # rows that one task numbers
MOST_OFFSETS = 100_000  # rows of a table of offsets that is broadcast


def rank_within(df: DataFrame, partition: list[str], order: list[Column], name: str) -> DataFrame:
    """rank() over (partition by ... order by ...) (WI1, WI2)."""
    w = Window.partitionBy(*[col(p) for p in partition]).orderBy(*order)
    return df.withColumn(name, F.rank().over(w))


def _in_ranges(df: DataFrame, rows: int, per_range: int, order: list[Column], cut: Callable[[DataFrame], DataFrame] = stored_rows) -> DataFrame:
    """``df`` stored in ranges of about ``per_range`` rows, numbered in order as ``__r``; ``__i`` is a row's place in its range, from 0.

    Stored, because another run of the plan could draw the ranges elsewhere. A range is sorted once, by the
    task that writes it: places are taken from there, and the rows need not be shuffled again to be numbered.
    """
    ranges = max(1, -(-rows // per_range))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__p", F.monotonically_increasing_id())
    at = F.col("__p")  # the task's number, then 33 bits for the row
    return cut(placed).withColumns({"__r": F.shiftright(at, 33).cast("int"), "__i": at.bitwiseAND(F.lit((1 << 33) - 1))}).drop("__p")


def global_rank(df: DataFrame, order_col: str, name: str, ascending: bool = True, per_range: int = RANGE_ROWS,
                cut: Callable[[DataFrame], DataFrame] = stored_rows) -> DataFrame:
    """rank() over (order by order_col) as bigint, without a single-partition window over the rows.

    Ascending puts NULLs first, descending puts them last (Spark's defaults).
    ``per_range`` is the number of distinct values that one task ranks; ``cut`` stores a frame between steps.
    """
    v = col(order_col)
    df = cut(df)
    counts = cut(df.groupBy(v.alias("__v")).agg(F.count(F.lit(1)).alias("__n")))
    order = F.col("__v").asc_nulls_first() if ascending else F.col("__v").desc_nulls_last()
    counts = _in_ranges(counts, counts.count(), per_range, [order], cut).drop("__i")
    per = counts.groupBy("__r").agg(F.sum("__n").alias("__rn"))
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = per.select("__r", F.coalesce(F.sum("__rn").over(earlier), F.lit(0)).alias("__off"))
    before = Window.partitionBy("__r").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = counts.select("__r", "__v", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = local.join(offsets, "__r").select("__v", (F.col("__off") + F.col("__before") + 1).cast("long").alias(name))
    return df.join(ranked, v.eqNullSafe(F.col("__v")), "left").drop("__v")


def with_position(df: DataFrame, order: list[Column], name: str = "_position", per_range: int = RANGE_ROWS) -> DataFrame:
    """Adds 1..n in the given order (OR1, OR2) without one task that sees all rows.

    The rows are stored once in ranges of the order; a row's position is its number in its
    range plus the rows of the ranges before. Ties get any order unless ``order`` is total.
    """
    df = stored_rows(df)
    tagged = _in_ranges(df, df.count(), per_range, order)
    per = tagged.groupBy("__r").agg(F.count(F.lit(1)).alias("__rn"))
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = per.select("__r", F.coalesce(F.sum("__rn").over(earlier), F.lit(0)).alias("__off"))
    both = tagged.join(bounded_broadcast(offsets, MOST_OFFSETS), "__r")
    return both.select(*[col(c) for c in df.columns], (F.col("__off") + F.col("__i") + 1).cast("long").alias(name))


def lag_previous_row(df: DataFrame, order_col: str, value_col: str, name: str) -> DataFrame:
    """Value of the previous ROW in ``order_col`` order (WI4), gaps ignored.

    Used on per-year aggregates, whose size is bounded by the number of years.
    """
    return df.withColumn(name, F.lag(col(value_col)).over(Window.orderBy(col(order_col))))


def lag_previous_value(df: DataFrame, order_col: str, value_col: str, name: str, step: int = 1) -> DataFrame:
    """Value at exactly ``order_col - step`` (strict variant): NULL across a gap."""
    w = Window.orderBy(col(order_col)).rangeBetween(-step, -step)
    return df.withColumn(name, F.last(col(value_col)).over(w))


def growth_pct(current: Column, previous: Column) -> Column:
    """(cur - prev) / prev * 100, rounded to 2; NULL when prev is NULL or 0 (WI5)."""
    return F.when(
        previous.isNotNull() & (previous != 0),
        F.round(F.try_divide(current - previous, previous) * 100, 2),
    ).otherwise(F.lit(None).cast("double"))


def sequential_ids(df: DataFrame, group_col: str, order_col: str, name: str, base: Column | None = None,
                   per_range: int = RANGE_ROWS, most: int | None = None) -> DataFrame:
    """1..n per group in (order_col, other columns) order, plus ``base`` (WI6).

    The rows are stored once, range-partitioned by group and full sort key, numbered
    inside (group, range) by their place there, and shifted by the row count of the earlier ranges
    of the same group. A big group and a hot ``order_col`` value are both
    spread over many ranges (rows equal in every column are interchangeable
    and can only stay together). A group with over ``most`` rows raises.
    """
    key_cols = [order_col] + [c for c in df.columns if c not in (order_col, group_col)]
    order = [col(c).asc_nulls_first() for c in key_cols]
    g = col(group_col)
    with passing_rows(df) as rows:  # the ranges are stored: the rows as they came need not lie beside them
        tagged = _in_ranges(rows, rows.count(), per_range, [g.asc_nulls_first(), *order])
    per = tagged.groupBy(g.alias("__g"), F.col("__r")).agg(F.count(F.lit(1)).alias("__cnt"), F.min("__i").alias("__first"))
    if most is not None:
        largest = per.groupBy("__g").agg(F.sum("__cnt").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest > most:
            raise ValueError(f"a group of {largest} rows does not fit into ids for {most}")
    prev = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__cnt").over(prev), F.lit(0)) - F.col("__first")  # the rows of a group lie together in a range
    offsets = bounded_broadcast(per.select("__g", F.col("__r").alias("__r2"), before.alias("__off")), MOST_OFFSETS)
    joined = tagged.join(offsets, g.eqNullSafe(F.col("__g")) & (F.col("__r") == F.col("__r2")))
    seq = (F.col("__off") + F.col("__i") + 1).cast("long")
    if base is not None:
        seq = seq + base
    return joined.select(*[col(c) for c in df.columns], seq.alias(name))
