"""Derived measures (DE1-DE9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.buckets import discount_bucket
from ledgerlake.functions.text import col


def derive_measures(df: DataFrame) -> DataFrame:
    """Add the seven silver measures in one projection.

    Profit_Margin_Pct = round(Profit/Sales*100, 2), 0.0 when Sales is 0/NULL;
    Discount_Amount = round(Sales*Discount, 2) (on the clamped discount);
    Is_Loss = Profit < 0 (NULL stays NULL); Order_Year/Month/Quarter;
    Shipping_Days = max(Ship Date - Order Date, 0), 0 when Ship Date is NULL.
    """
    sales, profit = col("Sales"), col("Profit")
    od, sd = col("Order Date"), col("Ship Date")
    return df.withColumns(
        {
            "Profit_Margin_Pct": F.when(sales != 0, F.round(F.try_divide(profit, sales) * 100, 2)).otherwise(F.lit(0.0)),
            "Discount_Amount": F.round(sales * col("Discount"), 2),
            "Is_Loss": profit < 0,
            "Order_Year": F.year(od),
            "Order_Month": F.month(od),
            "Order_Quarter": F.quarter(od),
            "Shipping_Days": F.greatest(F.datediff(sd, od), F.lit(0)),
        }
    )


def with_discount_bucket(df: DataFrame, column: str = "Discount", name: str = "Discount_Bucket") -> DataFrame:
    """Label each row's discount range (DE8)."""
    return df.withColumn(name, discount_bucket(col(column)))
