"""Benchmark: the full written pipeline plus headline queries, one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Stages are timed separately: bronze write, silver write (with retention
gate), each gold mart (table + CSV export), the one-job validation report;
then headline queries run lazily from the raw tables (collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans import marts  # noqa: E402
from ledgerlake.plans.pipeline import (  # noqa: E402
    run_bronze,
    run_silver,
    run_validation,
)
from ledgerlake.registry import FIXTURE_COVERAGE, registry  # noqa: E402
from ledgerlake.session import build_session, shared_dir  # noqa: E402
from ledgerlake.sinks.writers import Store, publish_mart  # noqa: E402
from ledgerlake.sources import fixture  # noqa: E402

HEADLINE = ["executive_kpis", "loss_making_products", "dq_category_1", "global_rank", "dedup_deterministic"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    run_id = uuid.uuid4().hex[:12]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="ledgerlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # every table (catalog databases included) lives under the shared folder
    base = os.path.join(shared_dir(spark), "ledgerlake-bench", run_id)
    catalog = os.environ.get("BENCH_CATALOG", "1") == "1"
    store = Store(spark, base_path=base, use_catalog=catalog, prefix=f"b{run_id}")
    stamp = "2024-01-01 06:00:00"
    times: dict[str, float] = {}

    # warm-up (not timed): the same stages once on the smallest tables, so JIT
    # compilation and class loading do not land in the first timed stage
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm = Store(spark, base_path=os.path.join(base, "warmup"), use_catalog=catalog, prefix=f"w{run_id}")
        warm.create_databases()
        wb = run_bronze(warm, fixture.raw_sales(spark, warm_dir), fixture.returns_source(spark, warm_dir),
                        fixture.salespeople(spark), batch_time="2024-01-01 06:00:00", order_ids=fixture.order_ids(spark, warm_dir))
        run_silver(warm, silver_time="2024-01-01 06:00:00", bronze_rows=wb)
        wsilver = warm.read("silver", "orders_cleaned")
        for name, fn in marts.MARTS.items():
            publish_mart(warm, fn(wsilver), name, partition_by=marts.MART_PARTITION[name])
        run_validation(warm, "2024-01-01 06:00:00", coverage=FIXTURE_COVERAGE).collect()

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    reps = fixture.salespeople(spark)
    store.create_databases()
    nb = timed("bronze", lambda: run_bronze(store, fixture.raw_sales(spark, sf_dir), fixture.returns_source(spark, sf_dir),
                                            reps, batch_time=stamp, order_ids=fixture.order_ids(spark, sf_dir)))
    ns, _pct = timed("silver", lambda: run_silver(store, silver_time=stamp, bronze_rows=nb))
    silver = store.read("silver", "orders_cleaned")
    for name, fn in marts.MARTS.items():
        timed(f"gold_{name}", lambda n=name, f=fn: publish_mart(store, f(silver), n,
                                                                partition_by=marts.MART_PARTITION[n], created_at=stamp))
    report = timed("validation", lambda: run_validation(store, stamp, coverage=FIXTURE_COVERAGE).collect())
    pipeline_total = round(sum(times.values()), 3)

    # headline queries end to end from the raw tables; the no-op sink runs the
    # whole plan without pulling rows into Python
    q = registry()
    for name in HEADLINE:
        timed(f"q_{name}", lambda n=name: q[n](spark, sf_dir).write.format("noop").mode("overwrite").save())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "pipeline_total_sec",
        "value": pipeline_total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "rows": {"bronze": nb, "silver": ns, "report_checks": len(report)},
        "cpus": cpus,
        "store": "catalog (bucketed by Order ID)" if catalog else "path",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
