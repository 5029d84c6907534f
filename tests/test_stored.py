"""What is stored between steps, and what is shuffled for it."""

import glob

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import prep, windows
from ledgerlake.plans import quality
from ledgerlake.plans.generate import generate_years, yearly_maker
from ledgerlake.registry import suite
from ledgerlake.session import CLEANUP, shared_dir, shuffles_freed, stored_rows
from ledgerlake.sources import files
from tests import frames
from tests.conftest import SF_SMALL


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def base(spark, n=1000):
    return frames.orders(spark, [{"Order ID": f"O{i // 3}", "Product ID": f"P{i}", "Order Date": f"{1 + i % 12}/{1 + i % 28}/2016"} for i in range(n)])


def test_stored_frames_are_columns(spark):
    df = stored_rows(spark.range(100).select("id", F.lit("x").alias("Sub-Category"), F.lit(None).cast("date").alias("d")))
    assert "parquet" in optimized(df).lower() and df.columns == ["id", "Sub-Category", "d"] and df.count() == 100
    assert stored_rows(spark.range(3).select(F.lit(None).alias("nothing"))).count() == 3  # Parquet has no void
    assert stored_rows(spark.range(0)).count() == 0


def test_cleanup_holds_for_the_write_only(spark):
    before = spark.conf.get(CLEANUP, "false")
    with pytest.raises(ValueError), shuffles_freed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(CLEANUP, "false") == before


def test_rows_are_numbered_where_they_were_sorted(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("y"), (F.col("id") * 37 % 501).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    df = df.withColumn("y", F.when(F.col("y") > 0, F.col("y")))  # a third without a group
    out = windows.sequential_ids(df, "y", "k", "rid", per_range=90)
    assert "row_number" not in optimized(out)
    by = {}
    for r in out.collect():
        by.setdefault(r.y, []).append(((r.k, r.v is not None, r.v or 0), r.rid))
    assert set(by) == {None, 1, 2}
    for rows in by.values():
        assert [i for _, i in sorted(rows)] == list(range(1, len(rows) + 1))
    assert "row_number" not in optimized(windows.with_position(df, [F.col("k")], per_range=90))


def test_audit_counts_keys_alone(spark):
    df = spark.createDataFrame([(1, 1, "a", 2.0, None), (1, 1, "A", 0.5, "x"), (None, 2, None, None, None), (None, 2, "a", 0.1, "y")],
                               "`Order ID` int, `Product ID` int, Region string, Discount double, `Ship Mode` string")
    out = prep.defect_audit(df)
    assert "Expand" not in optimized(out)
    assert out.first().asDict() == {"total_rows": 4, "null_Ship_Mode": 2, "bad_discounts": 1, "unique_keys": 2, "distinct_regions": 2, "duplicate_rows": 2}
    none = prep.defect_audit(df.limit(0)).first().asDict()
    assert set(none.values()) == {0}


def test_years_are_written_without_a_shuffle(spark, tmp_dir):
    make, totals, _ = yearly_maker(base(spark), [2019, 2020])
    plan = optimized(make(F.lit(2019)))
    assert "Repartition" not in plan and "explode(array(2019" not in plan
    assert make(F.lit(2019)).count() == totals[2019] == 1010
    generate_years(base(spark), [2019, 2020], f"{tmp_dir}/raw", rows_per_file=300)
    for year in (2019, 2020):
        sizes = [spark.read.option("header", True).csv(f).count() for f in glob.glob(f"{tmp_dir}/raw/Source_File=sales_{year}/part-*.csv")]
        assert sum(sizes) == 1010 and max(sizes) <= 300


def test_years_come_from_the_folder_without_a_pattern_over_the_path(spark, tmp_dir):
    for name in ("sales_2019", "Source_File=sales_2020", "odd", "x19"):
        spark.range(2).select(F.col("id").alias("Order ID")).write.option("header", True).csv(f"{tmp_dir}/y/{name}")
    df = files.read_yearly(spark, [f"{tmp_dir}/y/*/"], files.text_schema(["Order ID"]))
    assert "[^/]" not in optimized(df)
    got = {(r.Source_File, r.Source_Year) for r in df.collect()}
    assert got == {("sales_2019", 2019), ("Source_File=sales_2020", 2020), ("odd", None), ("x19", None)}


def test_suite_stores_of_bronze_what_checks_read(spark):
    inp = suite(spark, SF_SMALL)
    assert inp.bronze.columns == quality.BRONZE_COLUMNS and inp.bronze.count() >= inp.silver.count()


def test_verified_marts_read_one_stored_silver(spark):
    from ledgerlake.registry import q_verify_tables

    kept = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/ledgerlake-cut/*"))
    before = kept()
    assert {r.table: r.exists for r in q_verify_tables(spark, SF_SMALL).collect()}["sales_trend"]
    assert len(kept() - before) == 1
