"""Dashboard datasets (DB1-DB8): small frames derived from the marts or silver.

Every dataset here reads a mart whose size is bounded by dimension
cardinality (years, months, regions, buckets), except the loss-product top
list, which takes a distributed top-k first and only then looks at 20 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numeric import pct, round_money_sum
from ledgerlake.functions.text import col
from ledgerlake.plans import marts
from ledgerlake.session import cut_lineage

#: What the six marts read of silver.
MART_COLUMNS = [
    "Order ID", "Order_Year", "Order_Month", "Order_Quarter", "Sales", "Profit", "Quantity", "Discount", "Discount_Amount",
    "Profit_Margin_Pct", "Is_Loss", "Is_Returned", "Shipping_Days", "Category", "Sub-Category", "Product Name",
    "Region", "State", "Salesperson", "Target_Sales",
]


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """DB1: the latest year's headline numbers (kpis has one row per year)."""
    latest = F.max("Order_Year").over(Window.partitionBy())
    return kpis.withColumn("_latest", latest).filter(F.col("Order_Year") == F.col("_latest")).select(
        "Order_Year", "Total_Sales", "Total_Profit", "Profit_Margin_Pct", "YoY_Sales_Growth_Pct", "YoY_Profit_Growth_Pct"
    )


def monthly_series(trend: DataFrame) -> DataFrame:
    """DB2: monthly sales and profit with a 'yyyy-MM' period label."""
    return trend.select(
        "Order_Year",
        "Order_Month",
        F.format_string("%04d-%02d", F.col("Order_Year"), F.col("Order_Month")).alias("Period"),
        "Total_Sales",
        "Total_Profit",
        "Profit_Margin_Pct",
    )


def category_bars(category: DataFrame) -> DataFrame:
    """DB3: category / sub-category bars."""
    return category.select(col("Category"), col("Sub-Category"), "Total_Sales", "Total_Profit", "Profit_Margin_Pct",
                           "Sales_Rank")


def target_status(ratio_pct) -> F.Column:
    """Met (>= 100 %), Near (>= 80 %), Below; 'No Target' when there is no target."""
    return (F.when(ratio_pct.isNull(), F.lit("No Target"))
            .when(ratio_pct >= 100, F.lit("Met"))
            .when(ratio_pct >= 80, F.lit("Near"))
            .otherwise(F.lit("Below")))


def region_target_status(regional: DataFrame) -> DataFrame:
    """DB4: region sales (sum over states) against the region's target, with a status."""
    agg = regional.groupBy("Region", "Salesperson", "Target_Sales").agg(
        round_money_sum(F.col("Total_Sales")).alias("Region_Sales"),
        F.count(F.lit(1)).alias("States"),
    )
    ratio = F.when(F.col("Target_Sales") > 0, pct(F.col("Region_Sales"), F.col("Target_Sales")))
    return agg.withColumn("Sales_vs_Target_Pct", ratio).withColumn("Target_Status", target_status(F.col("Sales_vs_Target_Pct")))


def salesperson_performance(regional: DataFrame) -> DataFrame:
    """DB5: per salesperson and region."""
    return regional.groupBy("Region", "Salesperson").agg(
        round_money_sum(F.col("Total_Sales")).alias("Total_Sales"),
        round_money_sum(F.col("Total_Profit")).alias("Total_Profit"),
        F.sum("Total_Orders").alias("Total_Orders"),
        F.sum("Loss_Count").alias("Loss_Count"),
        F.count(F.lit(1)).alias("States"),
    ).withColumn("Profit_Margin_Pct", pct(F.col("Total_Profit"), F.col("Total_Sales")))


def discount_margin(discount: DataFrame) -> DataFrame:
    """DB6: margin per discount bucket."""
    return discount.select("Discount_Bucket", "Total_Sales", "Profit_Margin_Pct", "Loss_Rate_Pct")


def severity(share_pct) -> F.Column:
    return (F.when(share_pct >= 5, F.lit("Critical"))
            .when(share_pct >= 1, F.lit("High"))
            .otherwise(F.lit("Moderate")))


def top_loss_severity(loss: DataFrame, n: int = 20) -> DataFrame:
    """DB7: the ``n`` largest losses with their share of the total loss and a severity flag.

    Top-k first (each task keeps n rows), then the total as a one-row
    aggregate; the two are combined on at most n + 1 rows.
    """
    keys = [col("Category"), col("Sub-Category"), col("Product Name")]
    top = loss.orderBy(F.col("Total_Loss").asc_nulls_first(), *keys).limit(n).select(
        col("Category"), col("Sub-Category"), col("Product Name"), "Total_Loss", "Loss_Rank", F.lit(False).alias("_is_total")
    )
    total = loss.agg(round_money_sum(F.col("Total_Loss")).alias("Total_Loss")).select(
        F.lit(None).cast("string").alias("Category"), F.lit(None).cast("string").alias("Sub-Category"),
        F.lit(None).cast("string").alias("Product Name"), "Total_Loss", F.lit(None).cast("long").alias("Loss_Rank"),
        F.lit(True).alias("_is_total"))
    both = top.unionByName(total)
    grand = F.max(F.when(F.col("_is_total"), F.col("Total_Loss"))).over(Window.partitionBy())
    share = F.round(F.try_divide(F.col("Total_Loss"), grand) * 100, 2)
    return both.withColumn("Loss_Share_Pct", share).filter(~F.col("_is_total")).withColumn(
        "Severity", severity(F.col("Loss_Share_Pct"))).drop("_is_total")


def filter_silver(silver: DataFrame, years=None, regions=None, categories=None) -> DataFrame:
    """DB8: dashboard filters applied to silver (prunes Order_Year partitions of the table)."""
    out = silver
    if years:
        out = out.filter(F.col("Order_Year").isin(list(years)))
    if regions:
        out = out.filter(F.col("Region").isin(list(regions)))
    if categories:
        out = out.filter(F.col("Category").isin(list(categories)))
    return out


def filtered_marts(silver: DataFrame, years=None, regions=None, categories=None) -> dict[str, DataFrame]:
    """DB8: all six marts for a filtered slice.

    The slice is read from silver once: its rows, with only the columns that marts use, are
    stored, and the six groupings read those.
    """
    slice_ = filter_silver(silver, years, regions, categories)
    return marts.build_gold(cut_lineage(slice_.select(*[col(c) for c in MART_COLUMNS])))


def filtered_kpis(silver: DataFrame, years=None, regions=None, categories=None) -> DataFrame:
    """DB8: executive KPIs for a filtered slice."""
    return marts.executive_kpis(filter_silver(silver, years, regions, categories))
