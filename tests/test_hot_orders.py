"""Hot orders: found, joined without moving, stored in slices; the publish by swap; observed row counts."""

import json
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import joins
from ledgerlake.operators.skew import SLICE, heavy_keys, with_slices
from ledgerlake.plans import pipeline
from ledgerlake.plans.silver import build_silver
from ledgerlake.sinks.writers import Store
from tests import frames

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def hot_orders(spark, n=900):
    return frames.orders(spark, [{"Order ID": "HOT" if i % 3 == 0 else str(i), "Product ID": f"P{i // 6}", "Sales": str(1 + i % 50)} for i in range(n)])


def test_heavy_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    got = heavy_keys(df, "k", 8)
    assert set(got.keys) == {-1} and got.keys[-1] >= 1000 and got.null_rows == 1000 and bool(got)
    assert not heavy_keys(spark.range(3000), "id", 8) and not heavy_keys(spark.range(0), "id", 8)
    sliced = with_slices(df.withColumn("v", F.rand(3)), got).groupBy("k", SLICE).count().filter("count > 1").collect()
    assert {r["k"] for r in sliced} == {-1, None} and max(r["count"] for r in sliced) < 400 and min(r[SLICE] for r in sliced) >= 1


def test_same_rows_with_and_without_split(spark):
    orders = hot_orders(spark).union(frames.orders(spark, [{"Order ID": None, "Product ID": f"N{i}"} for i in range(300)]))
    returns = frames.returns(spark, [("HOT", "Wrong Item"), ("HOT", "Changed Mind"), ("4", "Wrong Item"), (None, "Wrong Item")])
    heavy = heavy_keys(orders, "Order ID", 8)
    assert set(heavy.keys) == {"HOT"}
    want, got = joins.join_returns(orders, returns), joins.join_returns(orders, returns, heavy=heavy)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("catalog", [False, True])
def test_pipeline_with_a_hot_order(spark, tmp_dir, catalog):
    store = Store(spark, base_path=f"{tmp_dir}/s", use_catalog=catalog, prefix="h" + uuid.uuid4().hex[:8], buckets=8)
    store.create_databases()
    orders, returns = hot_orders(spark), frames.returns(spark, [("HOT", "Wrong Item"), ("4", "Wrong Item")])
    n = pipeline.run_bronze(store, orders, returns, frames.reps(spark), batch_time="2024-01-01 06:00:00")
    bronze = store.read("bronze", pipeline.BRONZE_TABLE)
    assert n == 900 and SLICE in bronze.columns
    assert bronze.filter("`Order ID` = 'HOT'").select(SLICE).distinct().count() > 2
    if catalog:  # ordinary rows are reduced within their buckets
        plan = build_silver(bronze.filter(F.col(SLICE) == 0))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(Order ID") <= 1
    pipeline.run_silver(store, silver_time="2024-01-01 06:00:00", bronze_rows=n, thresholds=pipeline.Thresholds(min_retention_pct=10.0))
    keys = orders.select("Order ID", "Product ID", "Source_Year").distinct().count()
    assert store.read("silver", pipeline.SILVER_TABLE).count() == keys


TASKS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from ledgerlake.operators import joins
from ledgerlake.operators.skew import heavy_keys, with_slices
from ledgerlake.operators.dedup import keep_first_sliced
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "16")
    .config("spark.sql.adaptive.enabled", "false").config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", {log!r}).getOrCreate())
orders = spark.range(0, 48000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("Order ID"), (F.col("id") % 977).alias("Product ID"), F.lit(2019).alias("Source_Year"))
returns = spark.range(0, 9000, 7).select(F.col("id").alias("Order ID"), F.lit("Wrong Item").alias("Return Reason"))
heavy = heavy_keys(orders, "Order ID", 16) if {split} else None
bronze = joins.join_returns(orders, returns, heavy=heavy)
bronze = with_slices(bronze, heavy) if heavy else bronze
bronze.repartition(16, *[c for c in ("Order ID", "_slice") if c in bronze.columns]).write.parquet({out!r} + "/bronze")
back = spark.read.parquet({out!r} + "/bronze")
keep_first_sliced(back, ["Order ID", "Product ID", "Source_Year"]).write.parquet({out!r} + "/silver")
spark.stop()
"""


def most_read(tmp_dir, split):
    """The largest number of shuffled rows that one task read, over the stages that shuffle many rows."""
    base = f"{tmp_dir}/{split}"
    os.makedirs(f"{base}/log")
    code = TASKS.format(root=ROOT, log=f"file://{base}/log", split=split, out=base)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    stages = {}
    for folder, _, names in os.walk(f"{base}/log"):
        for name in names:
            for line in open(os.path.join(folder, name), errors="replace"):
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                e = json.loads(line)
                n = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                stages.setdefault(e["Stage ID"], []).append(n)
    return max(max(v) for v in stages.values() if sum(v) > 10000)


def test_rows_of_tasks(spark, tmp_dir):
    """A third of 48,000 rows in one order, 16 partitions: one task read 16,000 rows and more, now none reads a third of that."""
    assert most_read(tmp_dir, False) >= 16000
    assert most_read(tmp_dir, True) < 6000


@pytest.mark.parametrize("catalog", [False, True])
def test_publish_by_swap(spark, tmp_dir, catalog, monkeypatch):
    store = Store(spark, base_path=f"{tmp_dir}/s", use_catalog=catalog, prefix="p" + uuid.uuid4().hex[:8])
    store.create_databases()
    rows = lambda n: spark.range(n).withColumn("y", F.col("id") % 2)
    one, n = store.stage(rows(5), "silver", "t", partition_by="y")
    assert n == 5 and not store.exists("silver", "t")
    store.publish("silver", "t", one)
    assert store.read("silver", "t").count() == 5 and store.published("silver", "t") == one
    before = store.read("silver", "t")
    two, _ = store.stage(rows(7), "silver", "t", partition_by="y")  # a crash here: nothing has changed
    assert store.read("silver", "t").count() == 5
    three, _ = store.stage(rows(9), "silver", "t", partition_by="y")
    if not catalog:  # a crash while the pointer is replaced

        def crash(*args):
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr("ledgerlake.sinks.files.replace_text", crash)
            with pytest.raises(OSError):
                store.publish("silver", "t", three)
        assert store.read("silver", "t").count() == 5
    store.publish("silver", "t", three)
    assert store.read("silver", "t").count() == 9 and before.count() == 5
    assert store.versions("silver", "t") == [one, three]  # the abandoned one is gone
    four, _ = store.stage(rows(2), "silver", "t", partition_by="y")
    store.publish("silver", "t", four)
    assert store.versions("silver", "t") == [three, four] and store.read("silver", "t").count() == 2


def test_a_plain_table_becomes_a_version(spark, tmp_dir):
    store = Store(spark, base_path=tmp_dir, use_catalog=True, prefix="o" + uuid.uuid4().hex[:8])
    store.create_databases()
    store.write(spark.range(3), "silver", "t")
    new, _ = store.stage(spark.range(4), "silver", "t")
    store.publish("silver", "t", new)
    assert store.read("silver", "t").count() == 4 and len(store.versions("silver", "t")) == 2


def test_row_inflation_raises(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(joins, "dedup_returns", lambda r, key="Order ID": r.withColumn("Is_Returned", F.lit(True)))
    store = Store(spark, base_path=tmp_dir)
    with pytest.raises(pipeline.RowInflationError):
        pipeline.run_bronze(store, frames.orders(spark, [{"Order ID": "1"}, {"Order ID": "2"}]), frames.returns(spark, [("1", "a"), ("1", "b")]), frames.reps(spark))


def test_one_scan_each(spark):
    from ledgerlake.operators import clean, prep
    from ledgerlake.sources import fixture
    from tests.conftest import SF_SMALL

    raw = fixture.raw_sales(spark, SF_SMALL)
    for df in (clean.distinct_before_after(raw), prep.defect_audit(raw)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in line and "l_orderkey" in line for line in plan.splitlines()) == 1
