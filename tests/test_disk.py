"""What lies on the disk while a query runs: compressed files, and no copy that nothing reads any more."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake import registry
from ledgerlake.config import Thresholds
from ledgerlake.operators import windows
from ledgerlake.plans import pipeline
from ledgerlake.plans.generate import generate_years
from ledgerlake.plans.silver import build_silver
from ledgerlake.session import CUT, dealt_rows, passing_rows, shared_dir
from ledgerlake.sinks import writers
from ledgerlake.sinks.writers import Store
from ledgerlake.sources import files, fixture
from tests import frames
from tests.conftest import SF_SMALL


def stored(spark):
    return set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/{CUT}/*"))


def size(top):
    return sum(os.path.getsize(f) for f in glob.glob(f"{top}/**/part-*", recursive=True))


def orders(spark, n=3000):
    return frames.orders(spark, [{"Order ID": f"O{i // 3}", "Product ID": f"P{i}", "Order Date": f"{1 + i % 12}/{1 + i % 28}/2016"} for i in range(n)])


def test_passing_rows_are_removed(spark):
    before = stored(spark)
    with passing_rows(spark.range(100)) as rows:
        assert rows.count() == 100 and len(stored(spark) - before) == 1
    assert stored(spark) == before
    with pytest.raises(ValueError), passing_rows(spark.range(100)):
        raise ValueError
    assert stored(spark) == before
    with passing_rows(spark.range(3).select(F.lit(None).alias("nothing"))) as rows:  # a checkpoint
        assert rows.count() == 3


def test_numbered_rows_are_stored_once(spark):
    before = stored(spark)
    out = windows.sequential_ids(spark.range(1000).select((F.col("id") % 3).alias("y"), F.col("id").alias("k")), "y", "k", "rid", per_range=90)
    assert len(stored(spark) - before) == 1
    assert {(r.y, r.rid) for r in out.collect()} == {(i % 3, i // 3 + 1) for i in range(1000)}


def test_compressed_yearly_files_hold_the_same_rows(spark, tmp_dir):
    schema, got = files.text_schema(frames.ORDER_COLS), []
    for kind in ("none", "gzip"):
        generate_years(orders(spark), [2019, 2020], f"{tmp_dir}/{kind}", rows_per_file=800, compression=kind)
        got.append(files.read_yearly(spark, [f"{tmp_dir}/{kind}/*/"], schema, required=["Order ID"]))
    assert got[0].exceptAll(got[1]).isEmpty() and got[1].exceptAll(got[0]).isEmpty() and got[0].count() == 2 * 3030
    assert 4 * size(f"{tmp_dir}/gzip") < size(f"{tmp_dir}/none")
    for year in (2019, 2020):
        assert len(glob.glob(f"{tmp_dir}/gzip/Source_File=sales_{year}/part-*.csv.gz")) == 4


def test_generate_years_writes_compressed_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(registry, "scratch", lambda spark, name: f"{tmp_dir}/{name}")
    rows = registry.q_generate_years(spark, SF_SMALL).collect()
    assert len(rows) == 5 and len({r["rows"] for r in rows}) == 1
    assert glob.glob(f"{tmp_dir}/generated/*/part-*.csv.gz") and not glob.glob(f"{tmp_dir}/generated/*/part-*.csv")


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_parts_make_up_the_sales_rows(spark, monkeypatch):
    assert fixture.parts(spark, SF_SMALL) == [(0, 1)]
    monkeypatch.setattr("ledgerlake.session.PORTION_ROWS", 2500)
    parts = fixture.parts(spark, SF_SMALL)
    assert len(parts) == 3
    raws = [fixture.raw_sales(spark, SF_SMALL, part=p) for p in parts]
    orders = [{r[0] for r in raw.select("Order ID").distinct().collect()} for raw in raws]
    assert all(orders) and not any(a & b for i, a in enumerate(orders) for b in orders[:i])
    before = stored(spark)
    with passing_rows(raws) as rows:
        assert len(stored(spark) - before) == 3 and same(rows, fixture.raw_sales(spark, SF_SMALL))
    assert stored(spark) == before


@pytest.mark.parametrize("catalog", [False, True])
def test_tables_written_in_portions_hold_the_same_rows(spark, tmp_dir, catalog, monkeypatch):
    hot = [{"Order ID": "HOT" if i % 3 == 0 else str(i // 2), "Product ID": f"P{i // 6}", "Sales": str(1 + i % 50)} for i in range(900)]
    rows = frames.orders(spark, [*hot, *[{"Order ID": None, "Product ID": f"N{i // 2}"} for i in range(300)]])
    returns = frames.returns(spark, [("HOT", "Wrong Item"), ("4", "Wrong Item"), ("4", "Changed Mind"), ("17", "Wrong Item"), (None, "Wrong Item")])
    got, calls = [], []
    write = writers.write_table
    monkeypatch.setattr(writers, "write_table", lambda df, location, **options: calls.append((location, write(df, location, **options))) or calls[-1][1])
    for portion in (10**6, 100):
        monkeypatch.setattr("ledgerlake.session.PORTION_ROWS", portion)
        store = Store(spark, base_path=f"{tmp_dir}/{portion}", use_catalog=catalog, prefix="d" + uuid.uuid4().hex[:8], buckets=16)
        store.create_databases()
        for _ in range(1 if portion > 100 or not catalog else 2):  # a second run replaces the tables of the first
            calls.clear()
            n = pipeline.run_bronze(store, rows, returns, frames.reps(spark), batch_time="2024-01-01 06:00:00")
            pipeline.run_silver(store, silver_time="2024-01-01 06:00:00", bronze_rows=n, thresholds=Thresholds(min_retention_pct=1.0))
        assert n == 1200 and len(store.versions("bronze", pipeline.BRONZE_TABLE)) == 1
        got.append([store.read("bronze", pipeline.BRONZE_TABLE), store.read("silver", pipeline.SILVER_TABLE)])
        if portion == 100:  # four steps for bronze; for silver one without a shuffle, and four for the hot orders
            steps = [sorted(k for location, k in calls if f"{layer}." in location or f"/{layer}/" in location) for layer in ("bronze", "silver")]
            assert list(map(len, steps)) == [4, 5] and steps[0][-1] < 600 and steps[1][-2] < 200
    assert same(got[0][0], got[1][0]) and same(got[0][1], got[1][1])
    if catalog:
        plain, *rest = pipeline.silver_portions(got[1][0], 16)
        plan = build_silver(plain)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Union" not in plan and len(rest) == 4


def test_a_portion_without_ordinary_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("ledgerlake.session.PORTION_ROWS", 50)
    rows = frames.orders(spark, [{"Order ID": "HOT", "Product ID": f"P{i}"} for i in range(400)])
    store = Store(spark, base_path=tmp_dir, buckets=16)
    assert pipeline.run_bronze(store, rows, frames.returns(spark, [("HOT", "Wrong Item")]), frames.reps(spark)) == 400
    assert pipeline.run_silver(store, bronze_rows=400)[0] == 400
    assert store.read("bronze", pipeline.BRONZE_TABLE).filter("not Is_Returned").isEmpty()


def test_hot_order_kpis_in_portions(spark, monkeypatch):
    want = registry.q_hot_order_kpis(spark, SF_SMALL).collect()
    monkeypatch.setattr("ledgerlake.session.PORTION_ROWS", 1000)
    before = stored(spark)
    assert registry.q_hot_order_kpis(spark, SF_SMALL).collect() == want
    assert stored(spark) == before  # the raw rows are gone


def test_dealt_rows_keep_keys_together(spark):
    before = stored(spark)
    a = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id") % 6).cast("string").alias("Order ID"), F.col("id").alias("v"))
    b = spark.createDataFrame([("1", "x"), (None, "y"), ("nowhere", None)], "`Order ID` string, w string")
    with dealt_rows("Order ID", 16, a, b) as dealt:
        assert len(dealt) == 16
        rows = [[[tuple(r) for r in df.collect()] for df in part] for part in dealt]
    assert sorted(r[1] for part in rows for r in part[0]) == list(range(500)) and sum(len(part[1]) for part in rows) == 3
    keys = [{r[0] for df in part for r in df} for part in rows]
    assert not any(x & y for i, x in enumerate(keys) for y in keys[:i]) and not all(keys)  # some have no rows
    with dealt_rows("Order ID", 2, a.limit(0), b) as dealt:
        assert sum(left.join(right, "Order ID").count() + left.count() for left, right in dealt) == 0
    assert stored(spark) == before


def test_csv_pipeline_kpis_in_portions(spark, tmp_dir, monkeypatch):
    want = registry.q_csv_pipeline_kpis(spark, SF_SMALL).collect()
    monkeypatch.setattr(registry, "scratch", lambda spark, name: f"{tmp_dir}/{name}")
    monkeypatch.setattr("ledgerlake.session.PORTION_ROWS", 2500)
    before = stored(spark)
    assert registry.q_csv_pipeline_kpis(spark, SF_SMALL).collect() == want
    assert len(stored(spark) - before) == 3  # silver of three parts; the rows that were read are gone
    for table in ("orders/*", "returns"):
        assert glob.glob(f"{tmp_dir}/csvpipe/{table}/part-*.csv.gz") and not glob.glob(f"{tmp_dir}/csvpipe/{table}/part-*.csv")
