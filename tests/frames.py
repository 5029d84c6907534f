"""Tiny reference-shaped frames (all text, as a header CSV delivers them)."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

ORDER_COLS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
    "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category", "Sub-Category",
    "Product Name", "Sales", "Quantity", "Discount", "Profit",
]
SCHEMA = StructType([StructField(c, StringType()) for c in ORDER_COLS]
                    + [StructField("Source_Year", IntegerType()), StructField("Source_File", StringType())])

DEFAULT = {
    "Row ID": "1", "Order ID": "CA-1", "Order Date": "1/3/2019", "Ship Date": "1/7/2019", "Ship Mode": "Second Class",
    "Customer ID": "C-1", "Customer Name": "Ann Lee", "Segment": "Consumer", "Country": "United States",
    "City": "Springfield", "State": "Ohio", "Postal Code": "04401", "Region": "East", "Product ID": "P-1",
    "Category": "Furniture", "Sub-Category": "Chairs", "Product Name": "Desk Chair", "Sales": "100.0",
    "Quantity": "2", "Discount": "0.1", "Profit": "20.0", "Source_Year": 2019, "Source_File": "sales_2019",
}


def orders(spark, rows):
    data = []
    for r in rows:
        full = dict(DEFAULT)
        full.update(r)
        data.append(tuple(full[c] for c in ORDER_COLS + ["Source_Year", "Source_File"]))
    return spark.createDataFrame(data, SCHEMA)


def returns(spark, rows):
    return spark.createDataFrame(rows, "`Order ID` string, `Return Reason` string")


def reps(spark):
    from ledgerlake.config import REFERENCE_SALESPEOPLE
    from ledgerlake.sources.fixture import REPS_SCHEMA

    return spark.createDataFrame(REFERENCE_SALESPEOPLE, REPS_SCHEMA)
