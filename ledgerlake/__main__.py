"""Command line: run the whole pipeline on raw CSV folders.

  python -m ledgerlake run --orders raw/sales_2019 raw/sales_2020 ... \\
      --returns raw/returns --salesperson raw/salesperson [--store PATH] [--catalog]

The session comes from the cluster's configuration (spark-submit /
spark-defaults); tables go under --store, by default the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import MANDATORY_COLS, Coverage
from ledgerlake.plans.pipeline import run_all
from ledgerlake.session import shared_dir
from ledgerlake.sinks.writers import Store
from ledgerlake.sources.files import read_csv, read_yearly, require_sources, text_schema


def run(args) -> int:
    spark = SparkSession.builder.appName("ledgerlake").getOrCreate()
    require_sources(spark, list(args.orders) + [args.returns, args.salesperson])
    # headers only: the names of all folders, all text
    columns = list(dict.fromkeys(c for path in args.orders for c in read_csv(spark, path).columns))
    columns = [c for c in columns if c not in ("Source_Year", "Source_File")]
    orders = read_yearly(spark, list(args.orders), text_schema(columns), required=MANDATORY_COLS)
    returns = read_csv(spark, args.returns)
    reps = read_csv(spark, args.salesperson).withColumn("Target_Sales", F.col("Target_Sales").try_cast("int"))
    base = args.store or os.path.join(shared_dir(spark), "ledgerlake")
    store = Store(spark, base_path=base, use_catalog=args.catalog, prefix=args.prefix)
    default = Coverage()
    coverage = Coverage(years=args.years or default.years, regions=args.regions or default.regions,
                        categories=args.categories or default.categories)
    stamp = args.batch_time or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    res = run_all(store, orders, returns, reps, batch_time=stamp, coverage=coverage, csv_base=args.csv_export)
    print(f"bronze rows {res.bronze_rows:,} | silver rows {res.silver_rows:,} | retention {res.retention_pct:.2f}%")
    for name, n in res.mart_rows.items():
        print(f"gold {name}: {n:,} rows")
    rows = res.report.collect()
    for r in rows:
        print(f"[{r.status}] {r.category} | {r.check_name} | expected {r.expected} | actual {r.actual}")
    return 1 if any(r.status == "FAIL" for r in rows) and args.fail_on_fail else 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="raw CSV -> bronze -> silver -> gold marts -> validation report")
    r.add_argument("--orders", nargs="+", required=True, help="yearly CSV folders; the year comes from the folder name")
    r.add_argument("--returns", required=True, help="returns CSV folder (Order ID, Return Reason)")
    r.add_argument("--salesperson", required=True, help="sales reps CSV folder (Region, Salesperson, Target_Sales)")
    r.add_argument("--store", help="base folder for the tables (default: spark.checkpoint.dir/ledgerlake)")
    r.add_argument("--catalog", action="store_true", help="managed tables (bucketed by Order ID) instead of folders")
    r.add_argument("--prefix", default="sales", help="database name prefix in catalog mode")
    r.add_argument("--csv-export", help="folder for one CSV export per mart")
    r.add_argument("--batch-time", help="batch timestamp 'yyyy-MM-dd HH:mm:ss' (default: now)")
    r.add_argument("--years", nargs="*", type=int)
    r.add_argument("--regions", nargs="*")
    r.add_argument("--categories", nargs="*")
    r.add_argument("--fail-on-fail", action="store_true", help="exit 1 when any check FAILs")
    args = p.parse_args(argv)
    return run(args)


if __name__ == "__main__":
    raise SystemExit(main())
