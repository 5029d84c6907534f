"""Lazy end-to-end flows over the driver tables (raw -> bronze -> silver).

Nothing here runs a job except the bounded size probes of the broadcast
helper; callers decide what to compute or write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.bronze import build_bronze
from ledgerlake.plans.silver import build_silver
from ledgerlake.sources import fixture

# Fixed stamps so query results are reproducible (pipelines pass real times).
FIXED_BATCH_TIME = "2024-01-01 06:00:00"
FIXED_SILVER_TIME = "2024-01-01 06:30:00"


def bronze_from_tables(spark: SparkSession, sf_dir: str, batch_time: str | None = FIXED_BATCH_TIME) -> DataFrame:
    orders = fixture.raw_sales(spark, sf_dir)
    returns = fixture.returns_source(spark, sf_dir)
    reps = fixture.salespeople(spark)
    return build_bronze(orders, returns, reps, batch_time=batch_time)


def silver_from_tables(spark: SparkSession, sf_dir: str, batch_time: str | None = FIXED_BATCH_TIME,
                       silver_time: str | None = FIXED_SILVER_TIME) -> DataFrame:
    return build_silver(bronze_from_tables(spark, sf_dir, batch_time), silver_time=silver_time)
