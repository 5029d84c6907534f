import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import prep, windows
from ledgerlake.plans import marts


def test_global_rank_matches_rank_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(-50, 50)) for _ in range(3000)] + [None] * 17 + [5.0] * 900
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double").repartition(5)
    for asc in (True, False):
        order = F.col("v").asc_nulls_first() if asc else F.col("v").desc_nulls_last()
        want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(order))).collect()}
        for size in (7, 1_000_000):  # many ranges, then one
            got = {r.id: r.rk for r in windows.global_rank(df, "v", "rk", ascending=asc, per_range=size).collect()}
            assert got == want


def test_sequential_ids_per_group(spark):
    rows = [(y, k, f"x{k % 3}") for y in (2019, 2020) for k in range(500)] + [(2019, 7, "x1")]
    df = spark.createDataFrame(rows, "y int, k long, t string").repartition(4)
    out = windows.sequential_ids(df, "y", "k", "rid", per_range=90).collect()
    by_year = {}
    for r in out:
        by_year.setdefault(r.y, []).append((r.k, r.t, r.rid))
    for y, items in by_year.items():
        assert sorted(i[2] for i in items) == list(range(1, len(items) + 1))
        assert [i[2] for i in sorted(items)] == list(range(1, len(items) + 1))


def test_row_ids_need_room(spark):
    df = spark.createDataFrame([(2019, k) for k in range(20)], "Source_Year int, `Order ID` long")
    assert sorted(r["Row ID"] for r in prep.row_ids_by_year(df, block=20).collect()) == [20 + i for i in range(1, 21)]
    with pytest.raises(ValueError, match="20 rows"):
        prep.row_ids_by_year(df, block=19)


def _silver_like(spark, rows):
    schema = ("`Order ID` string, Order_Year int, Order_Month int, Order_Quarter int, Sales double, Profit double, "
              "Quantity int, Discount double, Profit_Margin_Pct double, Is_Loss boolean, Category string, "
              "`Sub-Category` string, Is_Returned boolean, Discount_Amount double, Shipping_Days int")
    return spark.createDataFrame(rows, schema)


def test_zero_sales_group_and_rank_ties(spark):
    rows = [
        ("a", 2019, 1, 1, 0.0, 0.0, 1, 0.0, 0.0, False, "Furniture", "Chairs", False, 0.0, 1),
        ("b", 2019, 2, 1, 50.0, 5.0, 1, 0.0, 10.0, False, "Furniture", "Tables", False, 0.0, 1),
        ("c", 2019, 2, 1, 50.0, -5.0, 1, 0.1, -10.0, True, "Furniture", "Desks", False, 5.0, 1),
    ]
    s = _silver_like(spark, rows)
    trend = {r.Order_Month: r for r in marts.sales_trend(s).collect()}
    assert trend[1].Profit_Margin_Pct == 0.0
    cat = {r["Sub-Category"]: r for r in marts.category_performance(s).collect()}
    assert cat["Chairs"].Profit_Margin_Pct is None
    assert cat["Tables"].Sales_Rank == 1 and cat["Desks"].Sales_Rank == 1 and cat["Chairs"].Sales_Rank == 3


def test_yoy_first_year_and_gaps(spark):
    rows = [(str(i), y, 1, 1, s, s / 10, 1, 0.0, 10.0, False, "F", "C", False, 0.0, 1)
            for i, (y, s) in enumerate([(2019, 100.0), (2021, 150.0), (2022, 0.0), (2023, 30.0)])]
    k = {r.Order_Year: r for r in marts.executive_kpis(_silver_like(spark, rows)).collect()}
    assert k[2019].YoY_Sales_Growth_Pct is None
    assert k[2021].YoY_Sales_Growth_Pct == 50.0  # previous ROW (2019), not previous year
    assert k[2023].YoY_Sales_Growth_Pct is None  # previous total is 0
    t = spark.createDataFrame([(2019, 100.0), (2021, 150.0)], "Order_Year int, Total_Sales double")
    strict = {r.Order_Year: r.p for r in windows.lag_previous_value(t, "Order_Year", "Total_Sales", "p").collect()}
    assert strict[2021] is None
