"""Driver tables -> the sales model (raw orders, returns, sales reps).

Mapping (one line item = one sales row):
  Order ID <- l_orderkey, Product ID <- l_partkey, Order Date <- o_orderdate,
  Ship Date <- l_shipdate, Ship Mode <- o_orderpriority, Customer ID/Name/Segment
  <- o_custkey / c_name / c_mktsegment, State <- n_name, Region <- initcap(r_name),
  Category / Sub-Category / Product Name <- p_type / p_brand / p_name,
  Sales <- l_extendedprice, Quantity <- int(l_quantity), Discount <- l_discount,
  Profit <- Sales*(1-Discount) - 0.9*Quantity*p_retailprice (2 decimals),
  Source_Year <- year(o_orderdate). Returns are the line items flagged 'R'.

Join order is chosen for scale: the fact table meets ``part`` first (shuffle
on part key), then the customer-enriched orders (shuffle on order key), so the
result comes out hash-partitioned on Order ID and the bronze returns join on
the same key needs no further exchange of the big side. nation and region are
broadcast after a bounded size probe; customer, part and orders are never
broadcast unless the planner's own size check allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerlake.config import RETURN_REASONS
from ledgerlake.functions.hashing import pick_label
from ledgerlake.functions.text import col
from ledgerlake.operators.joins import bounded_broadcast
from ledgerlake.session import portions

RAW_COLUMNS = [
    "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
    "State", "Region", "Product ID", "Category", "Sub-Category", "Product Name",
    "Sales", "Quantity", "Discount", "Profit", "Source_Year", "Source_File",
]

# Sales reps for the fixture's five regions (our own test values).
FIXTURE_SALESPEOPLE = [
    ("Africa", "Ada Okafor", 90000000),
    ("America", "Ben Ortiz", 95000000),
    ("Asia", "Chen Wei", 85000000),
    ("Europe", "Dora Klein", 100000000),
    ("Middle East", "Omar Haddad", 80000000),
]

REPS_SCHEMA = StructType(
    [
        StructField("Region", StringType()),
        StructField("Salesperson", StringType()),
        StructField("Target_Sales", IntegerType()),
    ]
)

# Defect rules, by Order ID modulo (and the copy number for rules applied
# after duplication, so a copy can differ from its original).
NULL_EVERY = 50
DUPLICATE_EVERY = 97
CASE_EVERY = 33
DISCOUNT_EVERY = 100
NULLED_COLUMNS = ["Ship Mode", "Customer Name"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer + nation + region names; the nation/region table is broadcast after a size probe."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return cust.join(bounded_broadcast(geo, 10000), cust.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"
    )


def parts(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """(number, of how many) of each part that the sales rows are best made in: one for small tables."""
    of = portions(table(spark, sf_dir, "lineitem").count())
    return [(i, of) for i in range(of)]


def of_part(df: DataFrame, key: str, part: tuple[int, int] | None) -> DataFrame:
    """The rows whose key falls into a part (all rows without one); every row falls into one of them."""
    if part is None or part[1] == 1:
        return df
    return df.filter(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(part[1])) == part[0])


def clean_sales(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """The sales-shaped table before any defect is injected; with ``part`` the rows of its orders."""
    li = of_part(table(spark, sf_dir, "lineitem"), "l_orderkey", part).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    goods = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    orders = of_part(table(spark, sf_dir, "orders"), "o_orderkey", part).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = customer_dim(spark, sf_dir)
    orders_x = orders.join(cust, orders.o_custkey == cust.c_custkey)
    li_p = li.join(goods, li.l_partkey == goods.p_partkey)
    j = li_p.join(orders_x, li_p.l_orderkey == orders_x.o_orderkey)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    qty = F.col("l_quantity").cast("decimal(9,0)")
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    profit = (price * (F.lit(1) - disc) - F.lit(0.9).cast("decimal(2,1)") * qty * retail).cast("decimal(18,2)")
    year = F.year("o_orderdate")
    return j.select(
        F.col("l_orderkey").alias("Order ID"),
        F.to_date("o_orderdate").alias("Order Date"),
        F.to_date("l_shipdate").alias("Ship Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        F.col("o_custkey").alias("Customer ID"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("n_name").alias("State"),
        F.initcap("r_name").alias("Region"),
        F.col("l_partkey").alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        F.col("p_name").alias("Product Name"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
        profit.cast("double").alias("Profit"),
        year.alias("Source_Year"),
        F.concat(F.lit("sales_"), year.cast("string")).alias("Source_File"),
    )


def inject_modulo_defects(df: DataFrame, key: str = "Order ID") -> DataFrame:
    """Seed known defects by key modulo (reproducible in any SQL engine).

    NULL Ship Mode / Customer Name every 50th order; every 97th order's rows
    appear twice; then (after duplication, so copies can differ) upper/lower
    case Region every 33rd and Discount x10 every 100th (key + copy number).
    Duplication uses ``explode`` rather than a self-union: no second scan and
    the input partitioning is kept.
    """
    k = col(key)
    copies = F.when(F.pmod(k, F.lit(DUPLICATE_EVERY)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = df.withColumn("_copy", F.explode(copies))
    kc = k + F.col("_copy")
    case_slot = F.pmod(kc, F.lit(CASE_EVERY))
    nulled = F.pmod(k, F.lit(NULL_EVERY)) == 0
    changes = {
        "Region": F.when(case_slot == 0, F.upper(col("Region")))
        .when(case_slot == 1, F.lower(col("Region")))
        .otherwise(col("Region")),
        "Discount": F.when(F.pmod(kc, F.lit(DISCOUNT_EVERY)) == 0, col("Discount") * F.lit(10)).otherwise(col("Discount")),
    }
    for c in NULLED_COLUMNS:
        if c in df.columns:
            changes[c] = F.when(nulled, F.lit(None).cast(df.schema[c].dataType)).otherwise(col(c))
    return out.withColumns(changes).drop("_copy")


def raw_sales(spark: SparkSession, sf_dir: str, defects: bool = True, part: tuple[int, int] | None = None) -> DataFrame:
    """Raw sales rows (the ingest input), with seeded defects by default; with ``part`` (one of ``parts``) those of its orders."""
    df = clean_sales(spark, sf_dir, part)
    return inject_modulo_defects(df) if defects else df


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order ids of the sales rows, from one column of one table (for the search of hot orders)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("Order ID"))


def hot_sales(df: DataFrame, order: int = 1, every: int = 3, key: str = "Order ID") -> DataFrame:
    """Every ``every``-th order becomes one order: it then holds that share of all rows."""
    return df.withColumn(key, F.when(F.pmod(col(key), F.lit(every)) == 0, F.lit(order).cast(df.schema[key].dataType)).otherwise(col(key)))


def returns_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per returned line item: Order ID (may repeat) + Return Reason."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("Order ID"),
        pick_label(RETURN_REASONS, F.col("l_orderkey") * 31 + F.col("l_linenumber")).alias("Return Reason"),
    )


def salespeople(spark: SparkSession, rows=None) -> DataFrame:
    """Literal sales-rep dimension: Region, Salesperson, Target_Sales, Email."""
    return with_email(spark.createDataFrame(list(rows or FIXTURE_SALESPEOPLE), REPS_SCHEMA))


def with_email(reps: DataFrame, domain: str = "example.com") -> DataFrame:
    """Adds Email, first.last@domain of the rep's name."""
    return reps.withColumn("Email", F.concat(F.lower(F.replace(F.col("Salesperson"), F.lit(" "), F.lit("."))), F.lit(f"@{domain}")))


# Extra defects of the text-typed source, by Order ID modulo.
TEXT_DEFECTS = {
    "bad_sales_text": 211,     # Sales = 'n/a'            -> NULL after try_cast, row removed
    "bad_order_date": 223,     # Order Date = '13/45/yyyy' -> NULL date (kept, counted)
    "null_profit": 227,        # Profit NULL              -> row dropped (mandatory)
    "padded_region": 229,      # '  ' || lower(Region) || ' ' -> trimmed + title-cased
    "zero_sales": 233,         # Sales = '0'              -> row removed
    "bad_quantity": 239,       # Quantity = 'x'           -> NULL
    "empty_discount": 241,     # Discount = ''            -> NULL -> clamped to 0.0
}


def text_sales(df: DataFrame, key: str = "Order ID") -> DataFrame:
    """Every column as text, as a header CSV delivers it, plus text-level defects.

    Dates are written ``M/d/yyyy``; numbers use Spark's string cast.
    """
    k = col(key)

    def every(name):
        return F.pmod(k, F.lit(TEXT_DEFECTS[name])) == 0

    year = F.year(col("Order Date")).cast("string")
    out = {}
    for c in df.columns:
        dtype = df.schema[c].dataType.simpleString()
        v = F.date_format(col(c), "M/d/yyyy") if dtype == "date" else col(c).cast("string")
        out[c] = v
    out["Sales"] = F.when(every("bad_sales_text"), F.lit("n/a")).when(every("zero_sales"), F.lit("0")).otherwise(out["Sales"])
    out["Order Date"] = F.when(every("bad_order_date"), F.concat(F.lit("13/45/"), year)).otherwise(out["Order Date"])
    out["Profit"] = F.when(every("null_profit"), F.lit(None).cast("string")).otherwise(out["Profit"])
    out["Region"] = F.when(every("padded_region"), F.concat(F.lit("  "), F.lower(col("Region")), F.lit(" "))).otherwise(out["Region"])
    out["Quantity"] = F.when(every("bad_quantity"), F.lit("x")).otherwise(out["Quantity"])
    out["Discount"] = F.when(every("empty_discount"), F.lit("")).otherwise(out["Discount"])
    return df.select(*[out[c].alias(c) for c in df.columns])


def raw_text(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """The raw sales (with seeded defects) as all-text columns plus text defects."""
    return text_sales(raw_sales(spark, sf_dir, part=part))
