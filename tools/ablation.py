"""Design comparisons at one scale factor (default sf0.1), one JSON line.

1. quality report: one aggregate job vs one job per measure (the suite's own
   expressions, evaluated one by one);
2. rep-table join: size-checked broadcast vs forced shuffle (sort-merge) join;
3. loss ranking over silver rows: distributed ``global_rank`` vs a
   single-partition ``rank()`` window;
4. marts: silver bucketed by Order ID (catalog) vs plain parquet folders.

usage: python tools/ablation.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators import joins, windows  # noqa: E402
from ledgerlake.plans import marts, pipeline, quality  # noqa: E402
from ledgerlake.registry import FIXTURE_COVERAGE  # noqa: E402
from ledgerlake.session import build_session, shared_dir  # noqa: E402
from ledgerlake.sinks.writers import Store  # noqa: E402
from ledgerlake.sources import fixture  # noqa: E402


def timed(fn, repeat=2):
    best = None
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def job_per_measure(inp):
    """The same measures, each evaluated by a job of its own."""
    for name in quality.measures(inp, coverage=FIXTURE_COVERAGE).columns:
        quality.measures(inp, coverage=FIXTURE_COVERAGE, names={name}).collect()


def main() -> None:
    sf = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    spark = build_session(shuffle_partitions=16, app="ledgerlake-ablation")
    spark.sparkContext.setLogLevel("ERROR")
    rid = uuid.uuid4().hex[:10]
    base = os.path.join(shared_dir(spark), "ledgerlake-ablation", rid)
    out = {}

    stores = {}
    for mode in ("catalog", "path"):
        st = Store(spark, base_path=f"{base}/{mode}", use_catalog=mode == "catalog", prefix=f"a{mode[0]}{rid}")
        st.create_databases()
        nb = pipeline.run_bronze(st, fixture.raw_sales(spark, sf), fixture.returns_source(spark, sf),
                                 fixture.salespeople(spark), batch_time="2024-01-01 06:00:00")
        pipeline.run_silver(st, silver_time="2024-01-01 06:00:00", bronze_rows=nb)
        stores[mode] = st
    st = stores["catalog"]
    bronze, silver = st.read("bronze", "orders_raw"), st.read("silver", "orders_cleaned")
    gold = marts.build_gold(silver)
    inp = quality.SuiteInputs(bronze, silver, gold)

    # 1. quality checks (silver/bronze measures; marts excluded on both sides)
    inp_no_gold = quality.SuiteInputs(bronze, silver, {})
    out["quality_one_job_sec"] = timed(lambda: quality.measures(inp_no_gold, coverage=FIXTURE_COVERAGE).collect())
    out["quality_job_per_measure_sec"] = timed(lambda: job_per_measure(inp_no_gold))
    out["quality_full_report_sec"] = timed(lambda: quality.validation_report(inp, "t", coverage=FIXTURE_COVERAGE).collect())

    # 2. rep join: broadcast (bounded) vs forced sort-merge join
    raw = fixture.raw_sales(spark, sf)
    reps = fixture.salespeople(spark)
    bcast = joins.join_salespeople(raw, reps)
    smj = raw.join(reps.select("Region", "Salesperson", "Target_Sales").hint("merge"), "Region", "left")
    out["rep_join_broadcast_sec"] = timed(lambda: bcast.write.format("noop").mode("overwrite").save())
    out["rep_join_shuffle_sec"] = timed(lambda: smj.write.format("noop").mode("overwrite").save())

    # 3. overall rank of every silver row by profit
    rows = silver.select("Order ID", "Product ID", "Source_Year", "Profit")
    out["rank_distributed_sec"] = timed(lambda: windows.global_rank(rows, "Profit", "rk").write.format("noop")
                                        .mode("overwrite").save())
    single = rows.withColumn("rk", F.rank().over(Window.orderBy("Profit")))
    out["rank_single_partition_sec"] = timed(lambda: single.write.format("noop").mode("overwrite").save())

    # 4. all six marts from bucketed vs plain silver
    for mode, s in stores.items():
        sil = s.read("silver", "orders_cleaned")
        out[f"marts_{mode}_silver_sec"] = timed(
            lambda sil=sil: [fn(sil).write.format("noop").mode("overwrite").save() for fn in marts.MARTS.values()])

    out["sf"] = sf
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
