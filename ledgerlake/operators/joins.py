"""Joins: enrichment left joins, size-checked broadcast, lookups (JO1-JO5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.config import NOT_RETURNED
from ledgerlake.functions.text import col
from ledgerlake.operators.skew import HeavyKeys, left_lookup


class DuplicateKeyError(ValueError):
    """A lookup table holds a key more than once, so a join with it would multiply rows."""


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    A bounded probe ``limit(max_rows + 1).count()`` reads at most
    ``max_rows + 1`` rows. Above the bound the side is returned as-is and
    the planner picks a shuffle join (AQE can still demote it at runtime).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def unique_lookup(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """A lookup side, broadcast if its counted rows are at most ``max_rows``; a repeated key raises.

    One job over the lookup counts its rows and its keys. NULL keys match nothing and may repeat.
    """
    each = df.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    got = each.agg(F.max(F.when(F.col("k").isNotNull(), F.col("n"))).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if (got["most"] or 0) > 1:
        raise DuplicateKeyError(f"{key!r} repeats up to {got['most']} times in the lookup table")
    return F.broadcast(df) if got["rows"] <= max_rows else df


def dedup_returns(returns: DataFrame, key: str = "Order ID", reason: str = "Return Reason") -> DataFrame:
    """One row per returned order (DD3), smallest reason wins; adds Is_Returned.

    A grouped min is a partial aggregate, so a hot order collapses map-side
    before the shuffle.
    """
    return returns.groupBy(col(key)).agg(F.min(col(reason)).alias(reason)).withColumn("Is_Returned", F.lit(True))


def join_returns(orders: DataFrame, returns: DataFrame, key: str = "Order ID", heavy: HeavyKeys | None = None,
                 watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """orders LEFT JOIN deduplicated returns; non-returned rows get defaults (JO1, CL3, DE9).

    With ``heavy`` (skew.heavy_keys of the orders) the rows of hot orders are not shuffled.
    ``watch`` is applied to the order rows before they are joined (to observe their number).
    """
    out = left_lookup(orders, dedup_returns(returns, key), heavy or HeavyKeys(key, 2), watch)
    return out.withColumns(
        {
            "Is_Returned": F.coalesce(col("Is_Returned"), F.lit(False)),
            "Return Reason": F.coalesce(col("Return Reason"), F.lit(NOT_RETURNED)),
        }
    )


def join_salespeople(orders: DataFrame, reps: DataFrame, key: str = "Region", max_rows: int = 10000,
                     normalize_keys: bool = False) -> DataFrame:
    """orders LEFT JOIN sales reps on Region (JO2).

    The join is exact (case-sensitive), as in the raw stage: a region spelled
    'EAST' finds no rep. ``normalize_keys=True`` trims and title-cases both
    sides' key before matching. The rep table is broadcast after a size check; a
    region with two reps raises, as its orders would be multiplied.
    """
    slim = reps.select(col(key), col("Salesperson"), col("Target_Sales"))
    if normalize_keys:
        slim = slim.withColumn(key, F.initcap(F.trim(col(key))))
        orders = orders.withColumn(key, F.initcap(F.trim(col(key))))
    return orders.join(unique_lookup(slim, key, max_rows), on=key, how="left")


def unmatched_count(joined: DataFrame, probe_col: str = "Salesperson") -> DataFrame:
    """Rows whose right side is missing after a left join (JO3), one-row frame."""
    return joined.agg(F.count_if(col(probe_col).isNull()).alias("unmatched_rows"))


def row_inflation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in vs rows out of a left join (JO4); ``inflated`` is true on fan-out.

    Both counts come out of one job: the two inputs are tagged and unioned.
    """
    tagged = before.select(F.lit(0).alias("_side")).unionByName(after.select(F.lit(1).alias("_side")))
    agg = tagged.agg(
        F.count_if(F.col("_side") == 0).alias("rows_before"),
        F.count_if(F.col("_side") == 1).alias("rows_after"),
    )
    return agg.withColumn("inflated", F.col("rows_after") != F.col("rows_before"))


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str, default,
                        max_rows: int = 10000) -> DataFrame:
    """Left join a small key->value table; missing keys get ``default`` (JO5)."""
    small = unique_lookup(lookup.select(col(key), col(value)), key, max_rows)
    return df.join(small, on=key, how="left").withColumn(value, F.coalesce(col(value), F.lit(default)))
