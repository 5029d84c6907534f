"""Landing of mixed encodings, ordered marts, filtered marts, databases."""

import glob
import gzip
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.windows import with_position
from ledgerlake.plans import dashboard, marts
from ledgerlake.plans.flow import silver_from_tables
from ledgerlake.sinks.writers import Store, publish_mart, read_mart
from ledgerlake.sources.files import MissingSourceError
from ledgerlake.sources.landing import file_encodings, land_csv
from tests.conftest import SF_SMALL


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_encoding_is_decided_per_file(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    put(f"{raw}/a.csv", "Order ID, Name \n1,Café\n2,plain\n".encode())
    put(f"{raw}/b.csv", "Order ID,Name\n3,Café\n4,x\n".encode("latin-1"))
    put(f"{raw}/c.csv", "﻿Name,Order ID,Extra\nÑu,5,\"a, b\"\n".encode())
    put(f"{raw}/d.csv.gz", gzip.compress("Order ID,Name\n6,Zoë\n".encode()))
    put(f"{raw}/e.csv", b"")
    kinds = {os.path.basename(r.path): (r.encoding, r.lines, r.bad_lines) for r in file_encodings(spark, [raw]).collect()}
    assert kinds == {"a.csv": ("UTF-8", 3, 0), "b.csv": ("ISO-8859-1", 3, 1), "c.csv": ("UTF-8", 2, 0), "d.csv.gz": ("UTF-8", 2, 0)}
    done = land_csv(spark, [raw], f"{tmp_dir}/out", ["Order ID", "Sales"])
    assert done.rows == 6 and done.encodings == {"UTF-8": 3, "ISO-8859-1": 1} and done.missing == ["Sales"]
    assert [os.path.basename(p) for p in done.bad_files] == ["b.csv"]
    want = [("1", "Café", None), ("2", "plain", None), ("3", "Café", None), ("4", "x", None), ("5", "Ñu", "a, b"), ("6", "Zoë", None)]
    for df in (spark.read.parquet(done.parquet), spark.read.option("header", True).csv(done.csv)):
        assert sorted(tuple(r) for r in df.select("Order ID", "Name", "Extra").collect()) == want
    with pytest.raises(MissingSourceError):
        put(f"{tmp_dir}/none/e.csv", b"")
        land_csv(spark, [f"{tmp_dir}/none"], f"{tmp_dir}/out2")


def test_positions_over_many_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit(1).alias("same")).repartition(7)
    got = with_position(df, [F.col("v").desc()], "at", per_range=90)
    assert got.filter("at != 1000 - v").count() == 0 and got.columns == ["v", "same", "at"]
    assert sorted(r.at for r in with_position(df, [F.col("same")], "at", per_range=90).collect()) == list(range(1, 1001))
    assert with_position(df.limit(0), [F.col("v")]).count() == 0


def test_ordered_mart(spark, tmp_dir):
    store = Store(spark, base_path=f"{tmp_dir}/s")
    silver = silver_from_tables(spark, SF_SMALL).select(*[F.col(f"`{c}`") for c in dashboard.MART_COLUMNS])
    for name in ("loss_making_products", "regional_performance"):
        mart = marts.MARTS[name](silver)
        n = publish_mart(store, mart, name, partition_by=marts.MART_PARTITION[name], csv_base=f"{tmp_dir}/csv", order=marts.total_order(mart, name))
        rows = read_mart(store, name).collect()
        assert [r["_position"] for r in rows] == list(range(1, n + 1))
        value, down = marts.MART_ORDER[name][0]
        assert [r[value] for r in rows] == sorted((r[value] for r in rows), reverse=down)
        at = []
        for f in sorted(glob.glob(f"{tmp_dir}/csv/{name}/part-*.csv")):  # the files' order is the rows' order
            at += [int(r["_position"]) for r in spark.read.option("header", True).csv(f).collect()]
        assert at == list(range(1, n + 1))


def test_filtered_marts_read_the_slice_once(spark):
    silver = silver_from_tables(spark, SF_SMALL)
    years, regions, categories = [1996, 1997], ["Asia", "Europe"], ["Economy"]
    got = dashboard.filtered_marts(silver, years, regions, categories)
    want = marts.MARTS["category_performance"](dashboard.filter_silver(silver, years, regions, categories))
    assert got["category_performance"].exceptAll(want).isEmpty() and not got["category_performance"].isEmpty()
    for mart in got.values():
        assert "FileScan" not in mart._jdf.queryExecution().executedPlan().toString()


def test_databases(spark, tmp_dir):
    store = Store(spark, base_path=tmp_dir, use_catalog=True, prefix="d" + uuid.uuid4().hex[:8])
    names = store.create_databases()
    assert set(names) <= set(store.databases())
    before = store.use("silver")
    store.write(spark.range(3), "silver", "t")
    assert spark.table("t").count() == 3
    spark.catalog.setCurrentDatabase(before)
    folder = Store(spark, base_path=tmp_dir)
    folder.write(spark.range(1), "gold", "t")
    assert "gold" in folder.databases()
