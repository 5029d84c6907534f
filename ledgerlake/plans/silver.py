"""Silver: dedup, clean, type, derive (PL2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.config import DEDUP_KEY, LAYER_SILVER, MANDATORY_COLS, Thresholds
from ledgerlake.operators.clean import (
    clamp_discount,
    coerce_types,
    drop_mandatory_nulls,
    fill_defaults,
    parse_dates,
    remove_invalid_sales,
    standardize_text,
)
from ledgerlake.operators.dedup import keep_first_sliced
from ledgerlake.operators.derive import derive_measures


def clean_rows(bronze: DataFrame, dedup_key=DEDUP_KEY, date_formats: list[str] | None = None) -> DataFrame:
    """Bronze -> typed, cleaned rows (no derived columns yet)."""
    df = keep_first_sliced(bronze, list(dedup_key), complete=MANDATORY_COLS)
    df = drop_mandatory_nulls(df)
    df = fill_defaults(df)
    df = standardize_text(df)
    df = parse_dates(df, formats=date_formats)
    df = coerce_types(df)
    df = clamp_discount(df)
    return remove_invalid_sales(df)


def build_silver(bronze: DataFrame, silver_time: str | None = None, dedup_key=DEDUP_KEY,
                 date_formats: list[str] | None = None) -> DataFrame:
    df = derive_measures(clean_rows(bronze, dedup_key, date_formats))
    ts = F.lit(silver_time).cast("timestamp") if silver_time else F.current_timestamp()
    return df.withColumns({"_silver_timestamp": ts, "_source_layer": F.lit(LAYER_SILVER)})


def retention(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """bronze rows, silver rows and retention % from ONE job (tagged union, no join)."""
    tagged = bronze.select(F.lit(0).alias("_side")).unionByName(silver.select(F.lit(1).alias("_side")))
    agg = tagged.agg(
        F.count_if(F.col("_side") == 0).alias("bronze_rows"),
        F.count_if(F.col("_side") == 1).alias("silver_rows"),
    )
    return agg.withColumn(
        "retention_pct",
        F.when(F.col("bronze_rows") > 0, F.round(F.col("silver_rows") / F.col("bronze_rows") * 100, 2)).otherwise(F.lit(0.0)),
    )


class RetentionError(ValueError):
    pass


def retention_gate(bronze: DataFrame, silver: DataFrame, thresholds: Thresholds = Thresholds()) -> float:
    """Raise when silver keeps less than the minimum share of bronze rows (DQ5)."""
    row = retention(bronze, silver).first()
    # compare the exact share, not the 2-decimal display value
    pct = row["silver_rows"] / row["bronze_rows"] * 100.0 if row["bronze_rows"] else 0.0
    if pct < thresholds.min_retention_pct:
        raise RetentionError(f"Retention {pct:.2f}% below threshold {thresholds.min_retention_pct}%")
    return pct
