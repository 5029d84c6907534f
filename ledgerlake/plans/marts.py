"""Gold marts (GO1-GO7) and silver analyses (AN1-AN5).

Conventions shared by every mart:
* money totals: ``round(sum(x), 2)`` computed on DECIMAL (exact, independent
  of partition merge order), reported as DOUBLE;
* averages: exact sum / non-NULL count, then ``round``;
* ratios on the rounded totals, ``try_divide`` (NULL, never an error, on 0);
* ``countDistinct(Order ID)`` is exact (two-phase distinct aggregate).

Every mart is one grouped aggregate over silver, i.e. one scan of the
columns it needs plus one shuffle of partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numeric import exact_avg, pct, round_money_sum
from ledgerlake.functions.text import col
from ledgerlake.operators.derive import with_discount_bucket
from ledgerlake.operators.windows import global_rank, growth_pct, lag_previous_row, rank_within
from ledgerlake.session import cut_lineage


def _r(c, n):
    return F.round(c, n)


def loss_count(column: str = "Is_Loss"):
    """sum(cast(flag as int)): NULL for a group whose flags are all NULL."""
    return F.sum(col(column).cast("int"))


def sales_trend(silver: DataFrame) -> DataFrame:
    """GO1: by year, month, quarter."""
    agg = silver.groupBy("Order_Year", "Order_Month", "Order_Quarter").agg(
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        F.count_distinct(col("Order ID")).alias("Total_Orders"),
        F.sum(col("Quantity")).alias("Total_Quantity"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Margin_Pct"),
        loss_count().alias("Loss_Count"),
    )
    return agg.withColumn(
        "Profit_Margin_Pct",
        F.when(F.col("Total_Sales") != 0, pct(F.col("Total_Profit"), F.col("Total_Sales"))).otherwise(F.lit(0.0)),
    )


def category_performance(silver: DataFrame) -> DataFrame:
    """GO2: by Category, Sub-Category, ranked by sales within the category."""
    agg = silver.groupBy(col("Category"), col("Sub-Category")).agg(
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        F.count_distinct(col("Order ID")).alias("Total_Orders"),
        F.sum(col("Quantity")).alias("Total_Quantity"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
        loss_count().alias("Loss_Count"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Margin_Pct"),
    )
    agg = agg.withColumns(
        {
            "Profit_Margin_Pct": pct(F.col("Total_Profit"), F.col("Total_Sales")),
            "Loss_Rate_Pct": pct(F.col("Loss_Count"), F.col("Total_Orders")),
        }
    )
    return rank_within(agg, ["Category"], [F.col("Total_Sales").desc()], "Sales_Rank")


def regional_performance(silver: DataFrame) -> DataFrame:
    """GO3: by Region, State, Salesperson, Target_Sales; state sales vs region target."""
    agg = silver.groupBy("Region", "State", "Salesperson", "Target_Sales").agg(
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        F.count_distinct(col("Order ID")).alias("Total_Orders"),
        F.sum(col("Quantity")).alias("Total_Quantity"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
        loss_count().alias("Loss_Count"),
        _r(exact_avg(col("Shipping_Days")), 1).alias("Avg_Shipping_Days"),
    )
    agg = agg.withColumns(
        {
            "Profit_Margin_Pct": pct(F.col("Total_Profit"), F.col("Total_Sales")),
            "Sales_vs_Target_Pct": F.when(
                F.col("Target_Sales") > 0, pct(F.col("Total_Sales"), F.col("Target_Sales"))
            ).otherwise(F.lit(0.0)),
            "Loss_Rate_Pct": pct(F.col("Loss_Count"), F.col("Total_Orders")),
        }
    )
    return rank_within(agg, ["Region"], [F.col("Total_Sales").desc()], "Region_Sales_Rank")


def loss_making_products(silver: DataFrame) -> DataFrame:
    """GO4: loss rows by Category, Sub-Category, Product Name; ranked worst first.

    The overall rank uses ``global_rank`` (no single-partition window), since
    the number of products grows with the data.
    """
    agg = silver.filter(col("Is_Loss")).groupBy(col("Category"), col("Sub-Category"), col("Product Name")).agg(
        round_money_sum(col("Profit")).alias("Total_Loss"),
        F.count_distinct(col("Order ID")).alias("Loss_Transactions"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
        round_money_sum(col("Sales")).alias("Total_Sales"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Loss_Margin"),
        _r(exact_avg(col("Shipping_Days")), 1).alias("Avg_Shipping_Days"),
    )
    agg = agg.withColumn("Loss_Per_Transaction", _r(F.try_divide(F.col("Total_Loss"), F.col("Loss_Transactions")), 2))
    return global_rank(agg, "Total_Loss", "Loss_Rank", ascending=True, cut=cut_lineage)


def total_loss(silver: DataFrame) -> DataFrame:
    """GO7: total profit of loss rows, one row."""
    return silver.filter(col("Is_Loss")).agg(round_money_sum(col("Profit")).alias("Total_Loss_Amount"))


def discount_impact(silver: DataFrame) -> DataFrame:
    """GO5: by discount bucket."""
    agg = with_discount_bucket(silver).groupBy("Discount_Bucket").agg(
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        F.count_distinct(col("Order ID")).alias("Total_Orders"),
        _r(exact_avg(col("Sales")), 2).alias("Avg_Order_Sales"),
        _r(exact_avg(col("Profit")), 2).alias("Avg_Order_Profit"),
        loss_count().alias("Loss_Transactions"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
    )
    return agg.withColumns(
        {
            "Profit_Margin_Pct": pct(F.col("Total_Profit"), F.col("Total_Sales")),
            "Loss_Rate_Pct": pct(F.col("Loss_Transactions"), F.col("Total_Orders")),
        }
    )


KPI_COLUMNS = ["Order ID", "Order_Year", "Sales", "Profit", "Quantity", "Discount", "Discount_Amount", "Shipping_Days", "Is_Loss", "Is_Returned"]


def executive_kpis(silver: DataFrame) -> DataFrame:
    """GO6: yearly KPIs with year-over-year growth against the previous row."""
    agg = silver.groupBy("Order_Year").agg(
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        F.count_distinct(col("Order ID")).alias("Total_Orders"),
        F.sum(col("Quantity")).alias("Total_Units_Sold"),
        _r(exact_avg(col("Sales")), 2).alias("Avg_Order_Value"),
        _r(exact_avg(col("Discount")), 4).alias("Avg_Discount"),
        _r(exact_avg(col("Shipping_Days")), 2).alias("Avg_Shipping_Days"),
        loss_count().alias("Loss_Transactions"),
        F.count(col("Order ID")).alias("Total_Transactions"),
        F.sum(col("Is_Returned").cast("int")).alias("Returned_Orders"),
        round_money_sum(col("Discount_Amount")).alias("Total_Discount_Given"),
    )
    agg = agg.withColumns(
        {
            "Profit_Margin_Pct": pct(F.col("Total_Profit"), F.col("Total_Sales")),
            "Loss_Rate_Pct": pct(F.col("Loss_Transactions"), F.col("Total_Transactions")),
            "Return_Rate_Pct": pct(F.col("Returned_Orders"), F.col("Total_Orders")),
        }
    )
    # One row per year: the unpartitioned window sees a bounded number of rows.
    agg = lag_previous_row(agg, "Order_Year", "Total_Sales", "Prev_Year_Sales")
    agg = lag_previous_row(agg, "Order_Year", "Total_Profit", "Prev_Year_Profit")
    agg = agg.withColumns(
        {
            "YoY_Sales_Growth_Pct": growth_pct(F.col("Total_Sales"), F.col("Prev_Year_Sales")),
            "YoY_Profit_Growth_Pct": growth_pct(F.col("Total_Profit"), F.col("Prev_Year_Profit")),
        }
    )
    return agg.drop("Prev_Year_Sales", "Prev_Year_Profit")


MARTS = {
    "sales_trend": sales_trend,
    "category_performance": category_performance,
    "regional_performance": regional_performance,
    "loss_making_products": loss_making_products,
    "discount_impact": discount_impact,
    "executive_kpis": executive_kpis,
}

# Sort order each mart is presented in, as (column, descending) pairs: ``publish_mart(order=...)``
# stores it as a position column and ``read_mart`` returns the rows in it.
MART_ORDER = {
    "sales_trend": [("Order_Year", False), ("Order_Month", False)],
    "category_performance": [("Total_Sales", True)],
    "regional_performance": [("Total_Sales", True)],
    "loss_making_products": [("Total_Loss", False)],
    "discount_impact": [("Discount_Bucket", False)],
    "executive_kpis": [("Order_Year", False)],
}

# Partition column each mart is written with (None = unpartitioned).
MART_PARTITION = {
    "sales_trend": "Order_Year",
    "category_performance": None,
    "regional_performance": "Region",
    "loss_making_products": None,
    "discount_impact": None,
    "executive_kpis": None,
}


def total_order(mart: DataFrame, name: str) -> list[Column]:
    """The mart's sort order made total by its other columns; NULLs first ascending, last descending."""
    lead = MART_ORDER[name]
    rest = [c for c in mart.columns if c not in dict(lead) and not c.startswith("_")]
    return [col(c).desc_nulls_last() if down else col(c).asc_nulls_first() for c, down in lead] + [col(c).asc_nulls_first() for c in rest]


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: fn(silver) for name, fn in MARTS.items()}


# --- silver analyses (AN1-AN5) ------------------------------------------------


def silver_by_year(silver: DataFrame) -> DataFrame:
    """AN1."""
    return silver.groupBy("Order_Year").agg(
        F.count(F.lit(1)).alias("Total_Rows"),
        F.count_distinct(col("Order ID")).alias("Unique_Orders"),
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Margin_Pct"),
        F.sum(F.when(col("Is_Loss"), 1).otherwise(0)).alias("Loss_Count"),
    )


def silver_by_category(silver: DataFrame) -> DataFrame:
    """AN2."""
    return silver.groupBy("Category").agg(
        F.count(F.lit(1)).alias("Total_Rows"),
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Margin_Pct"),
    )


def silver_by_region(silver: DataFrame) -> DataFrame:
    """AN3."""
    return silver.groupBy("Region").agg(
        F.count(F.lit(1)).alias("Total_Rows"),
        round_money_sum(col("Sales")).alias("Total_Sales"),
        round_money_sum(col("Profit")).alias("Total_Profit"),
    )


def derived_sanity(silver: DataFrame) -> DataFrame:
    """AN4: min / max / avg of the derived columns, one row."""
    return silver.agg(
        F.min("Profit_Margin_Pct").alias("Min_Margin"),
        F.max("Profit_Margin_Pct").alias("Max_Margin"),
        exact_avg(col("Profit_Margin_Pct")).alias("Avg_Margin"),
        F.min("Shipping_Days").alias("Min_Ship_Days"),
        F.max("Shipping_Days").alias("Max_Ship_Days"),
        exact_avg(col("Shipping_Days")).alias("Avg_Ship_Days"),
        F.sum(F.when(col("Is_Loss"), 1).otherwise(0)).alias("Total_Loss_Records"),
        F.min("Order_Year").alias("Min_Year"),
        F.max("Order_Year").alias("Max_Year"),
    )


def inline_stats(silver: DataFrame) -> DataFrame:
    """AN5: loss rows, average margin, average shipping days, returned rows; one row."""
    return silver.agg(
        F.count_if(col("Is_Loss")).alias("Loss_Records"),
        _r(exact_avg(col("Profit_Margin_Pct")), 2).alias("Avg_Margin_Pct"),
        _r(exact_avg(col("Shipping_Days")), 1).alias("Avg_Shipping_Days"),
        F.count_if(col("Is_Returned")).alias("Returned_Records"),
    )
