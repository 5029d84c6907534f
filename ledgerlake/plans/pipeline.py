"""The whole job: raw -> bronze table -> silver table -> gold marts -> report (PL1-PL4).

Each layer is written, and the next layer reads the written table, never the
in-memory plan: stages restart from storage after a failure, and a mart only
reads the silver columns it needs (column pruning at the parquet scan)
instead of caching the whole silver table. Row counts come from observations
during the writes, so nothing is re-read just to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ledgerlake.config import DEDUP_KEY, Coverage, Thresholds
from ledgerlake.functions.text import col
from ledgerlake.operators.skew import SLICE, HeavyKeys, heavy_keys, with_slices
from ledgerlake.plans import marts
from ledgerlake.plans.bronze import build_bronze
from ledgerlake.plans.quality import SuiteInputs, ordered_report, validation_report
from ledgerlake.plans.silver import RetentionError, build_silver
from ledgerlake.session import portions
from ledgerlake.sinks.writers import Store, publish_mart

BRONZE_TABLE = "orders_raw"
SILVER_TABLE = "orders_cleaned"
REPORT_TABLE = "validation_report"
LEAST_BUCKETS = 4  # buckets that are written at a time, at least: as many tasks write them


@dataclass
class RunResult:
    bronze_rows: int
    silver_rows: int
    retention_pct: float
    mart_rows: dict[str, int] = field(default_factory=dict)
    report: DataFrame | None = None


class RowInflationError(ValueError):
    """A join of the bronze job changed the number of order rows."""


def bucket_count(store: Store) -> int:
    return store.buckets or int(store.spark.conf.get("spark.sql.shuffle.partitions", "200"))


def order_buckets(store: Store, df: DataFrame | None = None) -> tuple[int, list[str]]:
    """Bucket a layer by Order ID (catalog tables). Bronze: the silver dedup,
    keyed by (Order ID, Product ID, Source_Year), reads it without a shuffle.
    Silver: every mart counts distinct Order IDs per group, and the first phase
    of that aggregate, keyed by (group, Order ID), reads it without a shuffle
    too; the dedup output already has this partitioning, so writing the
    buckets costs no exchange either. Rows with slices (orders that hold more
    than a task's share were found) are bucketed by Order ID and slice."""
    sliced = [SLICE] if df is not None and SLICE in df.columns else []
    return bucket_count(store), ["Order ID", *sliced]


def observed(seen: Observation) -> int:
    """The observed number ``n``; 0 where Spark found no rows to join, left the join out and observed nothing."""
    return int(seen.get["n"]) if seen._jo.getRow().length() else 0


def run_bronze(store: Store, orders: DataFrame, returns: DataFrame, reps: DataFrame, batch_time: str | None = None,
               order_ids: DataFrame | None = None) -> int:
    """Write bronze; rows written.

    Hot orders are looked for in ``order_ids`` (a frame with the order ids of the input, where that is
    cheaper to read than the input itself). The order rows that go into the joins are observed by the write
    itself and compared with the rows written (JO4): a difference raises, and the bronze table stays as it was.
    Of a large table some buckets are written at a time: the input is read once for each such portion (give
    a stored table), and only a portion's rows are shuffled at once.
    """
    heavy = heavy_keys(orders if order_ids is None else order_ids, "Order ID", bucket_count(store))
    seen: list[Observation] = []

    def watch(df: DataFrame) -> DataFrame:
        seen.append(Observation())
        return df.observe(seen[-1], F.count(F.lit(1)).alias("n"))

    orders = with_slices(orders, heavy)
    n, keys = order_buckets(store, orders)
    steps = portions(heavy.rows, n // LEAST_BUCKETS)
    bucket = F.pmod(F.hash(*[col(c) for c in keys]), F.lit(n))  # as the table's buckets are dealt
    mine = lambda i: orders if steps == 1 else orders.filter(F.pmod(bucket, F.lit(steps)) == i)
    theirs = lambda i: returns if steps == 1 else returns_of(orders, returns, heavy, bucket, steps, i)
    bronze = (build_bronze(mine(i), theirs(i), reps, batch_time=batch_time, heavy=heavy, watch=watch) for i in range(steps))
    staged, written = store.stage(bronze, "bronze", BRONZE_TABLE, partition_by="Source_Year", bucket_by=(n, keys))
    before = sum(observed(o) for o in seen)
    if before != written:
        raise RowInflationError(f"{before} order rows became {written} in the bronze joins")
    store.publish("bronze", BRONZE_TABLE, staged, keep=0)
    return written


def returns_of(orders: DataFrame, returns: DataFrame, heavy: HeavyKeys, bucket: Column, steps: int, i: int) -> DataFrame:
    """The returns that orders of a portion can have: those of its buckets, and of heavy orders, which lie in all."""
    kind = orders.schema[heavy.key].dataType
    if kind != returns.schema[heavy.key].dataType or not isinstance(kind, (IntegralType, StringType)):
        return returns  # equal keys could have different hashes
    here = F.pmod(bucket, F.lit(steps)) == i
    hot = F.coalesce(col(heavy.key).isin(list(heavy.keys)), F.lit(False)) if heavy.keys else F.lit(False)
    return returns.withColumn(SLICE, F.lit(0)).filter(here | hot).drop(SLICE)


def silver_portions(bronze: DataFrame, n: int) -> list[DataFrame]:
    """Bronze rows that silver can be built of one after the other: no two have rows of one dedup key.

    Rows without a slice are reduced in their buckets and need no shuffle; only those of heavy orders do.
    """
    if SLICE not in bronze.columns:
        return [bronze]
    heavy = bronze.filter(col(SLICE) > 0)
    steps = portions(heavy.count(), n // LEAST_BUCKETS)
    part = F.pmod(F.xxhash64(*[col(c) for c in DEDUP_KEY]), F.lit(steps))
    return [bronze.filter(col(SLICE) == 0), *[heavy if steps == 1 else heavy.filter(part == i) for i in range(steps)]]


def run_silver(store: Store, silver_time: str | None = None, bronze_rows: int | None = None,
               thresholds: Thresholds = Thresholds()) -> tuple[int, float]:
    """Build silver from the bronze table, stage it, apply the retention gate (DQ5), then publish.

    Silver is written once; publishing makes the staged version the table in one atomic step. A
    failed gate or a crash leaves the silver table of the run before as it was; the staged version stays for
    inspection until the next publish removes it.
    """
    bronze = store.read("bronze", BRONZE_TABLE)
    silver = [build_silver(x, silver_time=silver_time) for x in silver_portions(bronze, bucket_count(store))]
    staged, n = store.stage(silver, "silver", SILVER_TABLE, partition_by="Order_Year", bucket_by=order_buckets(store, silver[0]))
    if bronze_rows is None:
        bronze_rows = bronze.count()
    pct = (n / bronze_rows * 100.0) if bronze_rows else 0.0
    if pct < thresholds.min_retention_pct:
        raise RetentionError(f"Retention {pct:.2f}% below threshold {thresholds.min_retention_pct}%")
    store.publish("silver", SILVER_TABLE, staged)
    return n, pct


def run_gold(store: Store, created_at: str | None = None, csv_base: str | None = None, ordered: bool = False) -> dict[str, int]:
    """Write the six marts; ``ordered`` stores each in its sort order (marts.MART_ORDER), for readers and CSV files."""
    silver = store.read("silver", SILVER_TABLE)
    out = {}
    for name, fn in marts.MARTS.items():
        mart = fn(silver)
        out[name] = publish_mart(store, mart, name, partition_by=marts.MART_PARTITION[name], created_at=created_at,
                                 csv_base=csv_base, order=marts.total_order(mart, name) if ordered else None)
    return out


def run_validation(store: Store, validation_time: str, thresholds: Thresholds = Thresholds(),
                   coverage: Coverage = Coverage()) -> DataFrame:
    gold = {name: (store.read("gold", name) if store.exists("gold", name) else None) for name in marts.MARTS}
    inp = SuiteInputs(store.read("bronze", BRONZE_TABLE), store.read("silver", SILVER_TABLE), gold)
    report = validation_report(inp, validation_time, thresholds, coverage)
    store.write(report, "gold", REPORT_TABLE)
    return ordered_report(store.read("gold", REPORT_TABLE))


def run_all(store: Store, orders: DataFrame, returns: DataFrame, reps: DataFrame, batch_time: str,
            coverage: Coverage = Coverage(), thresholds: Thresholds = Thresholds(), csv_base: str | None = None,
            order_ids: DataFrame | None = None) -> RunResult:
    store.create_databases()
    nb = run_bronze(store, orders, returns, reps, batch_time=batch_time, order_ids=order_ids)
    ns, pct = run_silver(store, silver_time=batch_time, bronze_rows=nb, thresholds=thresholds)
    mart_rows = run_gold(store, created_at=batch_time, csv_base=csv_base, ordered=csv_base is not None)
    report = run_validation(store, batch_time, thresholds, coverage)
    return RunResult(nb, ns, pct, mart_rows, report)
