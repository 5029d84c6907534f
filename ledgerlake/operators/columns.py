"""Projection and column management (PR1-PR9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import record_hash
from ledgerlake.functions.text import col


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select the listed columns that exist, in list order (PR1)."""
    have = set(df.columns)
    return df.select(*[col(c) for c in columns if c in have])


def preview(df: DataFrame, rows: int = 5, columns: list[str] | None = None) -> DataFrame:
    """The first rows of a frame, some columns of it (OR5): a limit, so only as many tasks run as it needs."""
    return (keep_existing(df, columns) if columns else df).limit(rows)


def add_constants(df: DataFrame, values: dict) -> DataFrame:
    """Constant columns in one projection (PR3); values may be Columns or literals."""
    return df.withColumns({k: (v if hasattr(v, "alias") else F.lit(v)) for k, v in values.items()})


def batch_columns(batch_time: str | None) -> dict:
    """Batch id (``yyyyMMdd_HHmmss``) and batch timestamp columns (PR8)."""
    ts = F.lit(batch_time).cast("timestamp") if batch_time else F.current_timestamp()
    return {"_batch_time": ts, "_batch_id": F.date_format(ts, "yyyyMMdd_HHmmss")}


def with_record_hash(df: DataFrame, columns: list[str], name: str = "_record_hash") -> DataFrame:
    """md5 fingerprint of the listed columns (PR9); NULL parts are skipped."""
    return df.withColumn(name, record_hash(*[col(c) for c in columns]))
