"""Data preparation as DataFrame transforms (GE1-GE11).

Re-basing history to other years, per-year scaling, seeded sampling and
seeded defect injection, all expressed as column expressions so they run in
parallel on any input size. Every random choice is a hash of the row's key
and a seed: the same rows are picked on any partitioning and on retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from ledgerlake.config import (
    INJECT_CASE_PCT,
    INJECT_DISCOUNT_PCT,
    INJECT_DUPLICATE_PCT,
    INJECT_NULL_PCT,
    RANDOM_SEED,
    RETURN_REASONS,
    RETURN_SAMPLE_PCT,
    YEAR_MULTIPLIERS,
)
from ledgerlake.functions.dates import parse_date
from ledgerlake.functions.hashing import hash_bucket, pick_label, seeded_fraction
from ledgerlake.functions.text import col
from ledgerlake.operators.aggregates import mode_value
from ledgerlake.operators.columns import keep_existing
from ledgerlake.operators.joins import unique_lookup
from ledgerlake.operators.windows import sequential_ids

DEFAULT_KEY = ["Order ID", "Product ID"]
ORDER_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
    "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category", "Sub-Category",
    "Product Name", "Sales", "Quantity", "Discount", "Profit",
]
TEXT_DATE_FORMAT = "MM/dd/yyyy"


def _keys(df: DataFrame, key: list[str] | None) -> list[Column]:
    return [col(c) for c in (key or [c for c in DEFAULT_KEY if c in df.columns] or df.columns)]


def modal_year(df: DataFrame, date_col: str = "Order Date") -> int | None:
    """Most frequent year (smallest on ties); one scalar reaches the driver."""
    d = parse_date(col(date_col), df.schema[date_col].dataType, [TEXT_DATE_FORMAT, "M/d/yyyy"])
    row = mode_value(df.select(F.year(d).alias("y")), "y").first()
    return row[0] if row else None


def shift_years(df: DataFrame, years: Column | int, date_cols=("Order Date", "Ship Date")) -> DataFrame:
    """Move dates by whole years (GE1); Feb 29 lands on Feb 28. Text dates stay text."""
    out = {}
    for c in date_cols:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        d = parse_date(col(c), dtype, [TEXT_DATE_FORMAT, "M/d/yyyy"])
        months = (years * 12) if isinstance(years, Column) else F.lit(int(years) * 12)
        shifted = F.add_months(d, months.cast("int"))
        out[c] = F.date_format(shifted, TEXT_DATE_FORMAT) if isinstance(dtype, StringType) else (
            shifted if isinstance(dtype, DateType) else shifted.cast(dtype))
    return df.withColumns(out) if out else df


def shift_to_year(df: DataFrame, target_year: int, date_cols=("Order Date", "Ship Date")) -> DataFrame:
    """Shift so the modal order year becomes ``target_year`` (GE1)."""
    base = modal_year(df, date_cols[0])
    return df if base is None else shift_years(df, target_year - base, date_cols)


def multipliers_frame(spark: SparkSession, table: dict | None = None) -> DataFrame:
    rows = [(y, float(s), float(p), float(q)) for y, (s, p, q) in (table or YEAR_MULTIPLIERS).items()]
    return spark.createDataFrame(rows, "mult_year int, m_sales double, m_profit double, m_qty double")


def scale_by_year(df: DataFrame, year_col: str = "Source_Year", table: dict | None = None) -> DataFrame:
    """Multiply Sales / Profit / Quantity by the row year's factors; unknown years x1.0 (GE2, JO5).

    Rounds half-to-even (2, 2, 0 decimals), Quantity back to int. The factor
    table has one row per configured year and is broadcast after a check.
    """
    spark = df.sparkSession
    m = multipliers_frame(spark, table)
    j = df.join(unique_lookup(m, "mult_year", 10000), col(year_col) == F.col("mult_year"), "left")
    one = F.lit(1.0)
    out = j.withColumns(
        {
            "Sales": F.bround(col("Sales").cast("double") * F.coalesce(F.col("m_sales"), one), 2),
            "Profit": F.bround(col("Profit").cast("double") * F.coalesce(F.col("m_profit"), one), 2),
            "Quantity": F.bround(col("Quantity").cast("double") * F.coalesce(F.col("m_qty"), one), 0).cast("int"),
        }
    )
    return out.drop("mult_year", "m_sales", "m_profit", "m_qty")


def row_ids_by_year(df: DataFrame, year_col: str = "Source_Year", order_col: str = "Order ID",
                    base_year: int = 2018, block: int = 10000, name: str = "Row ID") -> DataFrame:
    """Row ID = (year - base_year) * block + 1..n within the year (GE2/WI6), distributed.

    A year with more rows than ``block`` raises, as its ids would run into the next year's.
    """
    base = (col(year_col) - F.lit(base_year)).cast("long") * F.lit(block)
    df = df.drop(name) if name in df.columns else df
    return sequential_ids(df, year_col, order_col, name, base=base, most=block)


def seeded_sample(df: DataFrame, fraction: float, seed: int = RANDOM_SEED, key: list[str] | None = None) -> DataFrame:
    """About ``fraction`` of the rows, chosen by key hash (GE3)."""
    return df.filter(seeded_fraction(fraction, seed, *_keys(df, key)))


def random_label(df: DataFrame, name: str, labels: list[str], seed: int = RANDOM_SEED,
                 key: list[str] | None = None) -> DataFrame:
    """A label per row, picked by key hash (GE4)."""
    return df.withColumn(name, pick_label(labels, hash_bucket(seed, *_keys(df, key), buckets=len(labels))))


def inject_nulls(df: DataFrame, columns: list[str], fraction: float = INJECT_NULL_PCT, seed: int = 0,
                 key: list[str] | None = None) -> DataFrame:
    """NULL in the same sampled rows for every listed column (GE5)."""
    hit = seeded_fraction(fraction, seed, *_keys(df, key))
    return df.withColumns({c: F.when(hit, F.lit(None).cast(df.schema[c].dataType)).otherwise(col(c))
                           for c in columns if c in df.columns})


def inject_duplicates(df: DataFrame, fraction: float = INJECT_DUPLICATE_PCT, seed: int = 0,
                      key: list[str] | None = None, copy_col: str = "_copy") -> DataFrame:
    """Sampled rows appear twice (GE6), via ``explode`` (no second scan); ``copy_col`` numbers the copies."""
    hit = seeded_fraction(fraction, seed, *_keys(df, key))
    copies = F.when(hit, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(copy_col, F.explode(copies))


def corrupt_case(df: DataFrame, column: str = "Region", fraction: float = INJECT_CASE_PCT, seed: int = 1,
                 key: list[str] | None = None, extra: list[str] | None = None) -> DataFrame:
    """Upper-case the column in a seeded sample of rows (GE7)."""
    hit = seeded_fraction(fraction, seed, *_keys(df, key), *[col(c) for c in (extra or [])])
    return df.withColumn(column, F.when(hit, F.upper(col(column))).otherwise(col(column)))


def corrupt_discount(df: DataFrame, column: str = "Discount", fraction: float = INJECT_DISCOUNT_PCT, seed: int = 2,
                     key: list[str] | None = None, factor: float = 10.0, extra: list[str] | None = None) -> DataFrame:
    """Multiply the discount by ``factor`` in a seeded sample of rows (GE8)."""
    hit = seeded_fraction(fraction, seed, *_keys(df, key), *[col(c) for c in (extra or [])])
    return df.withColumn(column, F.when(hit, col(column).cast("double") * F.lit(factor)).otherwise(col(column)))


def inject_defects(df: DataFrame, seed: int = 0, key: list[str] | None = None,
                   null_columns=("Postal Code", "Ship Mode", "Customer Name")) -> DataFrame:
    """NULLs, then duplicates, then case and discount errors (after duplication, so copies differ) (GE5-GE8)."""
    out = inject_nulls(df, [c for c in null_columns if c in df.columns], seed=seed, key=key)
    out = inject_duplicates(out, seed=seed, key=key)
    out = corrupt_case(out, seed=seed + 1, key=key, extra=["_copy"])
    out = corrupt_discount(out, seed=seed + 2, key=key, extra=["_copy"])
    return out.drop("_copy")


def expand_years(df: DataFrame, years: list[int], date_cols=("Order Date", "Ship Date"),
                 base_year: int | None = None, prefix: str = "sales_") -> DataFrame:
    """One copy of the base rows per target year, dates shifted, tagged (GE9).

    ``explode`` over the literal year list: a generator, not a join. The base
    year defaults to the modal order year (one scalar job).
    """
    base = base_year if base_year is not None else modal_year(df, date_cols[0])
    out = df.withColumn("Source_Year", F.explode(F.array(*[F.lit(int(y)) for y in years])))
    out = shift_years(out, F.col("Source_Year") - F.lit(base), date_cols)
    return out.withColumn("Source_File", F.concat(F.lit(prefix), F.col("Source_Year").cast("string")))


def split_sources(df: DataFrame, reps_rows: list[tuple] | None = None, seed: int = RANDOM_SEED,
                  return_fraction: float = RETURN_SAMPLE_PCT) -> dict[str, DataFrame]:
    """Wide source -> orders, returns (seeded 10 % of lines, random reason), reps with Email (GE10)."""
    from ledgerlake.config import REFERENCE_SALESPEOPLE
    from ledgerlake.sources.fixture import salespeople

    orders = keep_existing(df, ORDER_COLUMNS)
    sampled = seeded_sample(orders, return_fraction, seed)
    returns = random_label(sampled, "Return Reason", RETURN_REASONS, seed + 1).select(col("Order ID"), col("Return Reason"))
    reps = salespeople(df.sparkSession, reps_rows or REFERENCE_SALESPEOPLE)
    return {"orders": orders, "returns": returns, "salesperson": reps}


def defect_audit(df: DataFrame, key: list[str] | None = None,
                 null_columns=("Ship Mode", "Postal Code", "Customer Name")) -> DataFrame:
    """Total, NULLs per column, duplicate rows on the key, distinct regions, discounts > 1 (GE11).

    One scan. Each row gives one for its key, which holds nothing else, and one for what is summed: its region and
    flags, of which there are few. Both are counted by one aggregate, so a task that counts keys keeps no sums for
    them, and no DISTINCT makes Spark expand the rows.
    """
    keys = [k.alias(f"__k{i}") for i, k in enumerate(_keys(df, key))]
    flags = {f"null_{c.replace(' ', '_')}": col(c).isNull() for c in null_columns if c in df.columns}
    has_region, has_discount = "Region" in df.columns, "Discount" in df.columns
    if has_discount:
        flags["bad_discounts"] = F.coalesce(col("Discount").try_cast("double") > 1.0, F.lit(False))
    region = col("Region") if has_region else F.lit(None).cast("string")
    bits = sum((c.cast("int") * (1 << i) for i, c in enumerate(flags.values())), F.lit(0))
    rows = df.select(*keys, region.alias("__region"), bits.alias("__bits"))
    names, rest = [f"__k{i}" for i in range(len(keys))], ["__region", "__bits"]
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    of_key = F.struct(F.lit(0).alias("__tag"), *names, *[none(c) for c in rest])
    of_sums = F.struct(F.lit(1).alias("__tag"), *[none(c) for c in names], *rest)
    per = rows.select(F.explode(F.array(of_key, of_sums)).alias("x")).select("x.*").groupBy("__tag", *names, *rest).agg(F.count(F.lit(1)).alias("__n"))
    hit = {name: F.when(F.col("__bits").bitwiseAND(F.lit(1 << i)) != 0, F.col("__n")) for i, name in enumerate(flags)}
    by_region = per.groupBy("__tag", "__region").agg(
        F.count(F.lit(1)).alias("unique_keys"), F.sum("__n").alias("total_rows"), *[F.sum(v).alias(n) for n, v in hit.items()])
    total = lambda tag, n: F.coalesce(F.sum(F.when(F.col("__tag") == tag, F.col(n))), F.lit(0)).cast("long").alias(n)
    out = by_region.agg(
        *[total(1, n) for n in ["total_rows", *flags]], total(0, "unique_keys"),
        *([F.count(F.when(F.col("__tag") == 1, F.col("__region"))).alias("distinct_regions")] if has_region else []))
    return out.withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_keys"))
