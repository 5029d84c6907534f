"""Bronze: raw sales + returns + sales reps, stamped with batch metadata (PL1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerlake.config import LAYER_BRONZE
from ledgerlake.functions.hashing import record_hash
from ledgerlake.functions.text import col
from ledgerlake.operators.joins import join_returns, join_salespeople
from ledgerlake.operators.skew import SLICE, HeavyKeys, with_slices

ENRICH_COLUMNS = ["Return Reason", "Is_Returned", "Salesperson", "Target_Sales"]


def batch_stamp(batch_time: str | None) -> tuple[Column, Column]:
    """(timestamp, batch id) columns: a fixed time string, or the query's current time."""
    ts = F.lit(batch_time).cast("timestamp") if batch_time else F.current_timestamp()
    return ts, F.date_format(ts, "yyyyMMdd_HHmmss")


def hash_text(c: Column, dtype) -> Column:
    """Text used in the record hash; doubles go through DECIMAL so '1.0E7' never appears."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.coalesce(c.try_cast("decimal(24,6)").cast("string"), c.cast("string"))
    return c.cast("string")


def add_bronze_metadata(df: DataFrame, batch_time: str | None = None) -> DataFrame:
    ts, batch_id = batch_stamp(batch_time)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    parts = [hash_text(col(c), types[c]) for c in ["Order ID", "Product ID", "Sales", "Source_Year"] if c in types]
    return df.withColumns(
        {
            "_ingestion_timestamp": ts,
            "_batch_id": batch_id,
            "_source_layer": F.lit(LAYER_BRONZE),
            "_record_hash": record_hash(*parts),
        }
    )


def build_bronze(orders: DataFrame, returns: DataFrame, reps: DataFrame, batch_time: str | None = None, normalize_region: bool = False,
                 heavy: HeavyKeys | None = None, watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """orders LEFT JOIN returns (deduplicated) LEFT JOIN reps, plus metadata.

    Column order: the raw columns, then the enrichment columns, then metadata.
    ``normalize_region`` fixes the region spelling before the rep lookup;
    by default the lookup is exact, as a raw-stage join is. ``heavy`` and
    ``watch`` as in ``join_returns``; with heavy orders the rows get a slice, if they have none yet.
    """
    joined = join_returns(orders, returns, heavy=heavy, watch=watch)
    joined = join_salespeople(joined, reps, normalize_keys=normalize_region)
    ordered = joined.select(*[col(c) for c in orders.columns], *[col(c) for c in ENRICH_COLUMNS])
    out = add_bronze_metadata(ordered, batch_time)
    if SLICE in out.columns:
        return out.select(*[col(c) for c in out.columns if c != SLICE], SLICE)
    return with_slices(out, heavy) if heavy else out
