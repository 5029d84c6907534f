import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.sinks.writers import Store, export_csv, path_has_files, publish_mart, verify_tables, write_table
from ledgerlake.sources import files
from tests import frames


def test_csv_roundtrip_and_yearly_scan(spark, tmp_dir):
    df = frames.orders(spark, [{"Order ID": str(i), "Source_Year": 2019 + i % 2} for i in range(10)])
    for y in (2019, 2020):
        export_csv(df.filter(F.col("Source_Year") == y).drop("Source_Year", "Source_File"), f"{tmp_dir}/sales_{y}")
    schema = files.text_schema(frames.ORDER_COLS)
    got = files.read_yearly(spark, [f"{tmp_dir}/sales_2019", f"{tmp_dir}/sales_2020"], schema, required=["Order ID"])
    counts = {(r.Source_Year, r.Source_File): r["count"] for r in got.groupBy("Source_Year", "Source_File").count().collect()}
    assert counts == {(2019, "sales_2019"): 5, (2020, "sales_2020"): 5}
    with pytest.raises(files.MissingColumnsError):
        files.read_yearly(spark, [f"{tmp_dir}/sales_2019"], schema, required=["Nope"])


def test_yearly_files_are_read_by_name(spark, tmp_dir):
    for year, text in (("2020", "Region,Order ID,Sales,Extra\nWest,B,2.5,x\n"), ("2021", " Sales ,Order ID\n7,C\n"), ("2022", "Region,Order ID\nSouth,D\n")):
        os.makedirs(f"{tmp_dir}/sales_{year}")
        with open(f"{tmp_dir}/sales_{year}/part.csv", "w") as fh:
            fh.write(text)
    schema = files.text_schema(["Order ID", "Sales", "Region"])
    got = files.read_yearly(spark, [f"{tmp_dir}/sales_2020", f"{tmp_dir}/sales_2021"], schema, required=["Sales"])
    assert sorted(tuple(r) for r in got.collect()) == [("B", "2.5", "West", 2020, "sales_2020"), ("C", "7", None, 2021, "sales_2021")]
    with pytest.raises(files.MissingColumnsError, match="sales_2022.*Sales"):
        files.read_yearly(spark, [f"{tmp_dir}/*"], schema, required=["Sales"])


def test_source_gate(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/empty")
    assert not path_has_files(spark, f"{tmp_dir}/empty")
    assert not path_has_files(spark, f"{tmp_dir}/absent")
    with pytest.raises(files.MissingSourceError):
        files.require_sources(spark, [f"{tmp_dir}/empty"])


def test_encoding_fallback(spark, tmp_dir):
    p = f"{tmp_dir}/latin.csv"
    with open(p, "wb") as fh:
        fh.write("id,name\n1,Café\n".encode("latin-1"))
    df, enc = files.read_csv_any_encoding(spark, p, files.text_schema(["id", "name"]))
    assert enc == "ISO-8859-1" and df.first()["name"] == "Café"
    p2 = f"{tmp_dir}/utf8.csv"
    with open(p2, "wb") as fh:
        fh.write(" id , name \n1,Café\n".encode("utf-8"))
    df2, enc2 = files.read_csv_any_encoding(spark, p2)
    assert enc2 == "UTF-8" and df2.columns == ["id", "name"]


def test_write_observes_count_and_publish(spark, tmp_dir):
    df = spark.range(25).withColumn("y", F.col("id") % 3)
    assert write_table(df, f"{tmp_dir}/t", partition_by="y") == 25
    assert write_table(df, f"{tmp_dir}/t2", partition_by="y", balance=True) == 25
    assert spark.read.parquet(f"{tmp_dir}/t2").count() == 25
    store = Store(spark, base_path=f"{tmp_dir}/store")
    n = publish_mart(store, df, "m1", created_at="2024-01-01 00:00:00", csv_base=f"{tmp_dir}/csv")
    assert n == 25 and store.read("gold", "m1").select("_gold_table").distinct().first()[0] == "m1"
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv/m1").count() == 25
    v = {r.table: (r.exists, r.rows) for r in verify_tables(store, "gold", ["m1", "m2"]).collect()}
    assert v == {"m1": (True, 25), "m2": (False, None)}


def test_catalog_store_bucketed_bronze_skips_dedup_shuffle(spark):
    import uuid

    from ledgerlake.plans import pipeline
    from ledgerlake.plans.silver import build_silver
    from ledgerlake.sources import fixture

    store = Store(spark, use_catalog=True, prefix="t" + uuid.uuid4().hex[:8])
    assert len(store.create_databases()) == 3
    sf = "/root/testdata/sf0.001"
    nb = pipeline.run_bronze(store, fixture.raw_sales(spark, sf), fixture.returns_source(spark, sf),
                             fixture.salespeople(spark), batch_time="2024-01-01 00:00:00")
    assert nb == store.read("bronze", "orders_raw").count()
    plan = build_silver(store.read("bronze", "orders_raw"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan and "Exchange" not in plan
    ns, pct = pipeline.run_silver(store, bronze_rows=nb)
    assert ns > 0 and pct > 95
