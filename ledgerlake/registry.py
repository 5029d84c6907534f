"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables in ``sf_dir`` (whole tables) and runs
the operator under test on what Spark derives from them: the raw sales, the
bronze / silver layers, or a mart.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import (
    CAT1,
    CAT2,
    CAT3,
    DEDUP_KEY,
    DERIVED_COLS,
    DUPLICATE_CHECK_KEY,
    MANDATORY_COLS,
    TEXT_COLS,
    Coverage,
    Thresholds,
)
from ledgerlake.functions.text import col
from ledgerlake.operators import aggregates, clean, columns, dedup, filters, joins, prep, setops, windows
from ledgerlake.operators.derive import with_discount_bucket
from ledgerlake.operators.sampling import exact_sample
from ledgerlake.operators.skew import heavy_keys
from ledgerlake.plans import dashboard, marts, quality
from ledgerlake.plans.bronze import build_bronze
from ledgerlake.plans.flow import FIXED_BATCH_TIME, bronze_from_tables, silver_from_tables
from ledgerlake.plans.generate import generate_years
from ledgerlake.plans.silver import build_silver, clean_rows, retention
from ledgerlake.session import dealt_rows, passing_rows, shared_dir, shuffles_freed, stored_parts, stored_rows
from ledgerlake.sinks.writers import Store, export_csv, publish_mart, read_mart, verify_tables, write_table
from ledgerlake.sources import files, fixture

Query = Callable[[SparkSession, str], DataFrame]

KEY3 = ["Order ID", "Product ID", "Source_Year"]

# What the fixture's marts should cover (used by the dashboard checks).
FIXTURE_COVERAGE = Coverage(
    years=list(range(1995, 2002)),
    regions=["Africa", "America", "Asia", "Europe", "Middle East"],
    categories=["Economy", "Large", "Medium", "Promo", "Small", "Standard"],
)
# Map fixture years onto the configured multiplier years (1995 -> 2019, ...).
YEAR_OFFSET = 24
VALIDATION_TIME = "2024-01-01 07:00:00"
FILTER_YEARS = [1996, 1997, 1998, 1999, 2000]
FILTER_REGIONS = ["Asia", "Europe"]
FILTER_CATEGORIES = ["Economy", "Promo", "Standard"]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one query's files, under the shared checkpoint folder."""
    return os.path.join(shared_dir(spark), "ledgerlake-q", f"{name}-{uuid.uuid4().hex[:12]}")


def _silver(fn) -> Query:
    def run(spark, sf):
        return fn(silver_from_tables(spark, sf))

    return run


def _mart(mart: str, fn) -> Query:
    def run(spark, sf):
        return fn(marts.MARTS[mart](silver_from_tables(spark, sf)))

    return run


def text_bronze(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixture.raw_text(spark, sf)
    ret = fixture.returns_source(spark, sf).withColumn("Order ID", col("Order ID").cast("string"))
    return build_bronze(raw, ret, fixture.salespeople(spark), batch_time=FIXED_BATCH_TIME)


def gold_of(silver: DataFrame) -> dict[str, DataFrame]:
    return marts.build_gold(silver)


def suite(spark: SparkSession, sf: str) -> quality.SuiteInputs:
    """Bronze, silver and marts for the quality checks; bronze and silver are stored as tables (the columns
    that checks and marts read), so that no consumer replays the joins. Silver is built where bronze's joins leave
    the rows, by order: from a stored bronze every column would be shuffled once more for the dedup."""
    base = scratch(spark, "suite")
    raw = bronze_from_tables(spark, sf)
    write_table(raw.select(*[col(c) for c in quality.BRONZE_COLUMNS]), f"{base}/bronze")
    b = files.read_parquet(spark, f"{base}/bronze")
    used = dict.fromkeys([*MANDATORY_COLS, "Ship Date", *DUPLICATE_CHECK_KEY, *DERIVED_COLS, *dashboard.MART_COLUMNS])
    write_table(build_silver(raw, silver_time=FIXED_BATCH_TIME).select(*[col(c) for c in used]), f"{base}/silver")
    s = files.read_parquet(spark, f"{base}/silver")
    return quality.SuiteInputs(b, s, gold_of(s))


def dq_category(category: str) -> Query:
    def run(spark, sf):
        rep = quality.validation_report(suite(spark, sf), VALIDATION_TIME, coverage=FIXTURE_COVERAGE, with_measure=True, categories=[category])
        return rep.select("check_name", "status", "measure")

    return run


# --- individual queries --------------------------------------------------------


def q_derived_columns(spark, sf):
    s = silver_from_tables(spark, sf)
    return s.select(*[col(c) for c in KEY3], "Profit_Margin_Pct", "Discount_Amount", "Is_Loss", "Order_Year",
                    "Order_Month", "Order_Quarter", "Shipping_Days")


def q_discount_buckets(spark, sf):
    s = with_discount_bucket(silver_from_tables(spark, sf))
    return s.select(*[col(c) for c in KEY3], "Discount", "Discount_Bucket")


def q_returned_enrichment(spark, sf):
    b = bronze_from_tables(spark, sf)
    return b.select(*[col(c) for c in KEY3], col("Is_Returned"), col("Return Reason"))


def q_join_returns_left(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    j = joins.join_returns(raw, fixture.returns_source(spark, sf))
    return j.groupBy("Is_Returned", col("Return Reason")).agg(F.count(F.lit(1)).alias("rows"))


def q_join_returns_hot(spark, sf):
    """The returns join where one order holds a third of all rows."""
    raw = fixture.hot_sales(fixture.raw_sales(spark, sf))
    heavy = heavy_keys(fixture.hot_sales(fixture.order_ids(spark, sf)), "Order ID", 64)
    j = joins.join_returns(raw, fixture.returns_source(spark, sf), heavy=heavy)
    return j.groupBy((col("Order ID") == 1).alias("hot"), "Is_Returned", col("Return Reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(col("Order ID").isin(list(heavy.keys))).alias("kept_in_place"))


def q_hot_order_kpis(spark, sf):
    """Bronze and silver tables, stored in slices, and the KPIs where one order holds a third of all rows."""
    from ledgerlake.plans import pipeline

    store = Store(spark, base_path=scratch(spark, "hot"), use_catalog=True, prefix="h" + uuid.uuid4().hex[:10])
    store.create_databases()
    # the raw rows are joined a part of the orders at a time and stored: bronze reads them more than once
    with passing_rows([fixture.hot_sales(fixture.raw_sales(spark, sf, part=part)) for part in fixture.parts(spark, sf)]) as raw:
        pipeline.run_bronze(store, raw, fixture.returns_source(spark, sf), fixture.salespeople(spark),
                            batch_time=FIXED_BATCH_TIME, order_ids=fixture.hot_sales(fixture.order_ids(spark, sf)))
    pipeline.run_silver(store, silver_time=FIXED_BATCH_TIME, thresholds=Thresholds(min_retention_pct=50.0))
    return marts.executive_kpis(store.read("silver", pipeline.SILVER_TABLE))


def q_join_rep_broadcast(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    j = joins.join_salespeople(raw, fixture.salespeople(spark))
    return j.groupBy("Region", "Salesperson", "Target_Sales").agg(F.count(F.lit(1)).alias("rows"))


def q_unmatched_regions(spark, sf):
    b = bronze_from_tables(spark, sf)
    return joins.unmatched_count(b)


def q_row_inflation_guard(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    return joins.row_inflation(raw, bronze_from_tables(spark, sf))


def _year_table(spark, sf):
    s = silver_from_tables(spark, sf)
    return marts.silver_by_year(s).select("Order_Year", "Total_Sales", (F.col("Order_Year") + YEAR_OFFSET).alias("mult_year"))


def q_year_multiplier_lookup(spark, sf):
    years = _year_table(spark, sf)
    mult = prep.multipliers_frame(spark)
    out = joins.lookup_with_default(years, mult.select("mult_year", "m_sales"), "mult_year", "m_sales", 1.0)
    return out.select("Order_Year", "Total_Sales", "m_sales")


def q_dedup_deterministic(spark, sf):
    b = bronze_from_tables(spark, sf)
    return dedup.keep_first(b, DEDUP_KEY, complete=MANDATORY_COLS).drop("_ingestion_timestamp", "_batch_id", "_source_layer")


def q_dedup_report(spark, sf):
    return dedup.dedup_report(bronze_from_tables(spark, sf), DEDUP_KEY)


def q_duplicate_rate(spark, sf):
    return dedup.dedup_report(silver_from_tables(spark, sf), DUPLICATE_CHECK_KEY)


def q_distinct_values(spark, sf):
    return dedup.distinct_values(bronze_from_tables(spark, sf), "Region")


def q_returns_dedup(spark, sf):
    return joins.dedup_returns(fixture.returns_source(spark, sf))


def _text(spark, sf):
    return fixture.raw_text(spark, sf)


def q_drop_mandatory_nulls(spark, sf):
    return clean.drop_mandatory_nulls(_text(spark, sf))


def q_fill_defaults(spark, sf):
    out = clean.fill_defaults(text_bronze(spark, sf))
    return out.select(*[col(c) for c in KEY3], col("Ship Mode"), col("Customer Name"), col("Salesperson"),
                      col("Return Reason"), col("Target_Sales"))


def q_case_null_default(spark, sf):
    b = bronze_from_tables(spark, sf)
    return b.groupBy("Is_Returned", col("Return Reason")).agg(F.count(F.lit(1)).alias("rows"))


def q_title_case(spark, sf):
    out = clean.standardize_text(_text(spark, sf))
    return out.select(*[col(c) for c in KEY3], *[col(c) for c in clean.present(out, TEXT_COLS)])


def q_parse_dates(spark, sf):
    out = clean.parse_dates(_text(spark, sf))
    return out.select(*[col(c) for c in KEY3], col("Order Date"), col("Ship Date"))


def q_unparseable_dates(spark, sf):
    out = clean.parse_dates(_text(spark, sf))
    return out.agg(F.count_if(col("Order Date").isNull()).alias("bad_order_dates"),
                   F.count_if(col("Ship Date").isNull()).alias("bad_ship_dates"))


def q_coerce_types(spark, sf):
    out = clean.coerce_types(_text(spark, sf))
    return out.select(*[col(c) for c in KEY3], col("Sales"), col("Profit"), col("Discount"), col("Quantity"))


def q_non_finite_sales(spark, sf):
    """Sales that no total can hold (infinite, not a number, out of range) are NULL after coercion, and counted."""
    raw = fixture.raw_sales(spark, sf)
    slot = F.pmod(col("Order ID"), F.lit(11))
    text = col("Sales").cast("string")
    for i, bad in enumerate(["Infinity", "-Infinity", "NaN", "1e20"]):
        text = F.when(slot == i, F.lit(bad)).otherwise(text)
    out = clean.coerce_types(raw.withColumn("Sales", text))
    return out.groupBy("Source_Year").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(col("Sales").isNull()).alias("lost_sales"),
        marts.round_money_sum(col("Sales")).alias("Total_Sales"), F.round(marts.exact_avg(col("Sales")), 2).alias("Avg_Sales"))


def q_clamp_discount(spark, sf):
    out = clean.clamp_discount(clean.coerce_types(_text(spark, sf)))
    return out.select(*[col(c) for c in KEY3], col("Discount"))


def q_null_profile(spark, sf):
    return clean.null_profile(_text(spark, sf), max_null_pct=Thresholds().max_null_pct)


def q_remove_invalid_sales(spark, sf):
    out = clean.remove_invalid_sales(clean.coerce_types(_text(spark, sf)))
    return out.select(*[col(c) for c in KEY3], col("Sales"))


def q_distinct_standardization(spark, sf):
    return clean.distinct_before_after(_text(spark, sf))


def q_text_pipeline_kpis(spark, sf):
    return marts.executive_kpis(build_silver(text_bronze(spark, sf), silver_time=FIXED_BATCH_TIME))


def q_filter_null(spark, sf):
    return filters.null_rows(fixture.raw_sales(spark, sf), "Ship Mode").select(*[col(c) for c in KEY3], col("Ship Mode"))


def q_filter_flag(spark, sf):
    return filters.flag_rows(silver_from_tables(spark, sf), "Is_Loss").select(*[col(c) for c in KEY3], "Profit")


def q_filter_threshold(spark, sf):
    return filters.threshold_rows(fixture.raw_sales(spark, sf), "Discount", ">=", 0.5).select(
        *[col(c) for c in KEY3], "Discount")


def q_filter_range_or(spark, sf):
    return filters.out_of_range_rows(fixture.raw_sales(spark, sf), "Discount", 0.0, 0.5).select(
        *[col(c) for c in KEY3], "Discount")


def q_filter_consistency(spark, sf):
    s = silver_from_tables(spark, sf)  # every 37th order gets the wrong flag
    s = s.withColumn("Is_Loss", col("Is_Loss") != (F.pmod(col("Order ID"), F.lit(37)) == 0))
    return filters.inconsistent_flag_rows(s).select(*[col(c) for c in KEY3])


def q_filter_year_null_state(spark, sf):
    k = marts.executive_kpis(silver_from_tables(spark, sf))  # even years lose their value
    k = k.withColumn("YoY_Sales_Growth_Pct", F.when(F.col("Order_Year") % 2 == 1, F.col("YoY_Sales_Growth_Pct")))
    return filters.null_state_rows(k, "Order_Year", FIXTURE_COVERAGE.years[0], "YoY_Sales_Growth_Pct").select("Order_Year")


def q_filter_casing(spark, sf):
    return filters.miscased_rows(bronze_from_tables(spark, sf), "Region").select(*[col(c) for c in KEY3], "Region")


def q_filter_tolerance(spark, sf):
    s = silver_from_tables(spark, sf)
    coarse = F.round(F.try_divide(col("Profit"), col("Sales")) * 100, 1)
    return filters.tolerance_violations(s, "Profit_Margin_Pct", coarse, 0.01).select(
        *[col(c) for c in KEY3], "Profit_Margin_Pct")


def q_union_years(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    early = raw.filter(col("Source_Year") <= 1997).drop("Segment")
    late = raw.filter(col("Source_Year") > 1997)
    return files.union_by_name([early, late])


def q_append_sample(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    return setops.append_rows(raw, raw.filter(F.pmod(col("Order ID"), F.lit(101)) == 0))


EXPECTED_REGIONS_WIDE = ["Africa", "America", "Antarctica", "Asia", "Europe", "Middle East", "Oceania"]


def q_coverage_gap(spark, sf):
    reg = marts.regional_performance(silver_from_tables(spark, sf))
    exp = setops.expected_values(spark, "Region", EXPECTED_REGIONS_WIDE, "string")
    return setops.coverage_gap(exp, reg, "Region")


def q_rank_in_category(spark, sf):
    s = silver_from_tables(spark, sf)
    agg = s.groupBy("Category", col("Product Name")).agg(marts.round_money_sum(col("Sales")).alias("Total_Sales"))
    return windows.rank_within(agg, ["Category"], [F.col("Total_Sales").desc()], "Sales_Rank")


def q_rank_in_region(spark, sf):
    s = silver_from_tables(spark, sf)
    agg = s.groupBy("Region", "State").agg(marts.round_money_sum(col("Sales")).alias("Total_Sales"))
    return windows.rank_within(agg, ["Region"], [F.col("Total_Sales").desc()], "State_Rank")


def q_global_rank(spark, sf):
    s = silver_from_tables(spark, sf).select(*[col(c) for c in KEY3], "Profit")
    return windows.global_rank(s, "Profit", "Profit_Rank", ascending=True)


def q_global_rank_desc(spark, sf):
    s = silver_from_tables(spark, sf).select(*[col(c) for c in KEY3], "Sales")
    return windows.global_rank(s, "Sales", "Sales_Rank", ascending=False)


def _region_year(spark, sf):
    s = silver_from_tables(spark, sf)
    return s.groupBy("Region", "Order_Year").agg(marts.round_money_sum(col("Sales")).alias("Total_Sales"))


def q_yoy_lag(spark, sf):
    from pyspark.sql import Window

    t = _region_year(spark, sf)
    prev = F.lag("Total_Sales").over(Window.partitionBy("Region").orderBy("Order_Year"))
    t = t.withColumn("Prev_Sales", prev)
    return t.withColumn("Growth_Pct", windows.growth_pct(F.col("Total_Sales"), F.col("Prev_Sales")))


def q_yoy_strict(spark, sf):
    k = marts.executive_kpis(silver_from_tables(spark, sf)).filter(F.col("Order_Year") != 1997)
    k = k.select("Order_Year", "Total_Sales")
    k = windows.lag_previous_row(k, "Order_Year", "Total_Sales", "Prev_Row_Sales")
    return windows.lag_previous_value(k, "Order_Year", "Total_Sales", "Prev_Year_Sales")


def q_year_row_ids(spark, sf):
    raw = fixture.raw_sales(spark, sf, defects=False)
    return prep.row_ids_by_year(raw, "Source_Year", "Order ID", base_year=1994, block=10**12)


def q_record_hash(spark, sf):
    b = bronze_from_tables(spark, sf)
    return b.select(*[col(c) for c in KEY3], col("Sales"), col("_record_hash"))


def q_const_columns(spark, sf):
    t = marts.silver_by_year(silver_from_tables(spark, sf)).select("Order_Year", "Total_Rows")
    return columns.add_constants(
        t, {"_layer": "GOLD", "_version": 1, "_is_final": True,
            "_created_at": F.lit(FIXED_BATCH_TIME).cast("timestamp"), **columns.batch_columns(FIXED_BATCH_TIME)})


def q_scalar_text(spark, sf):
    s = silver_from_tables(spark, sf)
    return s.select(
        *[col(c) for c in KEY3],
        F.upper(col("Region")).alias("region_upper"),
        F.lower(col("Category")).alias("category_lower"),
        F.initcap(col("Product Name")).alias("product_title"),
        F.concat_ws("|", col("Region"), col("State"), col("Segment")).alias("geo_key"),
        F.length(col("Product Name")).alias("name_length"),
        F.regexp_extract(col("Source_File"), r"sales_(\d{4})", 1).alias("file_year"),
    )


def q_scalar_date(spark, sf):
    s = silver_from_tables(spark, sf)
    return s.select(
        *[col(c) for c in KEY3],
        F.date_format(col("Order Date"), "MM/dd/yyyy").alias("order_text"),
        F.add_months(col("Order Date"), 12).alias("next_year_date"),
        F.datediff(col("Ship Date"), col("Order Date")).alias("raw_days"),
        F.dayofweek(col("Order Date")).alias("weekday"),
        F.last_day(col("Order Date")).alias("month_end"),
    )


def q_scalar_math(spark, sf):
    s = silver_from_tables(spark, sf)
    return s.select(
        *[col(c) for c in KEY3],
        F.round(col("Sales") * F.lit(1.005), 2).alias("sales_up_half_up"),
        F.bround(col("Sales") * F.lit(1.005), 2).alias("sales_up_half_even"),
        F.abs(col("Profit")).alias("abs_profit"),
        F.greatest(col("Profit"), F.lit(0.0)).alias("profit_floor"),
        F.least(col("Discount"), F.lit(0.05)).alias("discount_cap"),
        F.try_divide(col("Profit"), col("Quantity") - col("Quantity")).alias("div_by_zero"),
    )


def q_ordered_report(spark, sf):
    rep = quality.validation_report(suite(spark, sf), VALIDATION_TIME, coverage=FIXTURE_COVERAGE)
    return quality.ordered_report(rep).select("category", "check_name", "status", "expected", "layer")


def q_top_20_losses(spark, sf):
    lp = marts.loss_making_products(silver_from_tables(spark, sf))
    return lp.orderBy(F.col("Total_Loss").asc_nulls_first(), col("Category"), col("Sub-Category"),
                      col("Product Name")).limit(20)


def q_mode_year(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    return aggregates.mode_value(raw.select(F.year(col("Order Date")).alias("Order_Year")), "Order_Year", "Modal_Year")


def q_global_profile(spark, sf):
    return aggregates.global_profile(silver_from_tables(spark, sf), ["Sales", "Profit", "Discount", "Quantity"])


def q_conditional_counts(spark, sf):
    return aggregates.conditional_counts(silver_from_tables(spark, sf), ["Is_Loss", "Is_Returned"], by=["Order_Year"])


def q_shift_years(spark, sf):
    raw = fixture.raw_sales(spark, sf, defects=False).select(*[col(c) for c in KEY3], col("Order Date"), col("Ship Date"))
    return prep.shift_to_year(raw, 2019)


def q_scale_years(spark, sf):
    raw = fixture.raw_sales(spark, sf, defects=False)
    raw = raw.select(*[col(c) for c in KEY3], "Sales", "Profit", "Quantity",
                     (col("Source_Year") + YEAR_OFFSET).alias("mult_year_key"))
    return prep.scale_by_year(raw, "mult_year_key")


def q_expand_years(spark, sf):
    raw = fixture.raw_sales(spark, sf, defects=False).select(col("Order ID"), col("Product ID"), col("Order Date"),
                                                             col("Ship Date"))
    return prep.expand_years(raw, [2019, 2020, 2021, 2022, 2023])


def q_seeded_sample(spark, sf):
    return prep.seeded_sample(fixture.raw_sales(spark, sf, defects=False), 0.10)


def q_exact_sample(spark, sf):
    """Exactly a tenth of the rows."""
    return exact_sample(fixture.raw_sales(spark, sf, defects=False), 0.10, key=KEY3)


def q_generate_years(spark, sf):
    """The yearly files, written as one job and read back by name."""
    path = scratch(spark, "generated")
    generate_years(fixture.raw_sales(spark, sf, defects=False), [2019, 2020, 2021, 2022, 2023], path, compression="gzip")
    schema = files.text_schema(["Row ID", *[c for c in fixture.RAW_COLUMNS if c not in ("Source_Year", "Source_File")]])
    back = files.read_yearly(spark, [f"{path}/*/"], schema, required=MANDATORY_COLS)
    number = lambda c: col(c).try_cast("double")
    # ids are counted apart: within the other aggregate every row would be shuffled with all their buffers
    ids = back.select(F.col("Source_Year").alias("__year"), "Row ID").distinct().groupBy("__year").agg(F.count("Row ID").alias("ids"))
    out = back.groupBy("Source_Year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(col("Row ID").cast("long")).alias("first_id"), F.max(col("Row ID").cast("long")).alias("last_id"),
        F.min(col("Order Date").cast("date")).alias("first_date"), F.max(col("Ship Date").cast("date")).alias("last_ship_date"),
        F.count_if(col("Ship Mode").isNull()).alias("null_ship_modes"), F.count_if(col("Customer Name").isNull()).alias("null_customers"),
        F.count_if(col("Region") == F.upper(col("Region"))).alias("upper_regions"), F.count_if(number("Discount") > 0.1).alias("large_discounts"),
        marts.round_money_sum(number("Sales")).alias("sales"), marts.round_money_sum(number("Profit")).alias("profit"),
        marts.round_money_sum(number("Discount")).alias("discounts"), F.sum(col("Quantity").cast("long")).alias("quantity"),
        F.sum(F.when(col("Region") == F.upper(col("Region")), col("Row ID").cast("long"))).alias("upper_region_ids"))
    both = out.join(ids, F.col("Source_Year").eqNullSafe(F.col("__year")))
    return both.select("Source_Year", "rows", "ids", *out.columns[2:])


def q_random_label(spark, sf):
    raw = fixture.raw_sales(spark, sf, defects=False).select(*[col(c) for c in KEY3])
    return prep.random_label(raw, "Return Reason", prep.RETURN_REASONS)


def q_inject_defects(spark, sf):
    return prep.inject_defects(fixture.raw_sales(spark, sf, defects=False), seed=2019)


def q_defect_audit(spark, sf):
    return prep.defect_audit(fixture.raw_sales(spark, sf))


def q_split_sources(spark, sf):
    return prep.split_sources(fixture.raw_sales(spark, sf, defects=False))["returns"]


def q_split_orders(spark, sf):
    return prep.split_sources(fixture.raw_sales(spark, sf, defects=False))["orders"]


def q_csv_roundtrip(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    path = scratch(spark, "csv")
    export_csv(raw, path)
    return files.read_csv(spark, path, schema=raw.schema)


def q_encoding_read(spark, sf):
    cust = fixture.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.col("c_name"), F.lit(" Céleste")).alias("c_label"))
    path = scratch(spark, "latin1")
    cust.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    schema = files.text_schema(["c_custkey", "c_label"])
    df, enc = files.read_csv_any_encoding(spark, path, schema)
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_label", F.lit(enc).alias("encoding"))


def q_land_csv(spark, sf):
    """Customer files of two encodings and two column orders, landed as one table."""
    from ledgerlake.sources.landing import land_csv

    base = scratch(spark, "landing")
    label = F.concat(F.col("c_name"), F.lit(" Céleste")).alias("c_label")
    cust = fixture.table(spark, sf, "customer").select("c_custkey", label, "c_nationkey", "c_mktsegment")
    for encoding, part in (("UTF-8", 0), ("ISO-8859-1", 1)):
        some = cust.filter(F.col("c_nationkey") % 2 == part).drop("c_nationkey")
        some = some if part else some.select("c_label", "c_custkey")
        some.write.option("header", True).option("encoding", encoding).csv(f"{base}/raw/{encoding}")
    done = land_csv(spark, [f"{base}/raw/UTF-8", f"{base}/raw/ISO-8859-1"], f"{base}/landed", ["c_custkey", "c_label", "Region"])
    back = spark.read.parquet(done.parquet)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_label", "c_mktsegment", F.col("_encoding").alias("encoding"),
                       F.lit(", ".join(done.missing)).alias("missing"), F.lit(done.rows).cast("long").alias("landed_rows"))


#: Two columns that name a row of a mart, and its headline number.
MART_LABELS = {
    "sales_trend": ("Order_Year", "Order_Month", "Total_Sales"),
    "category_performance": ("Category", "Sub-Category", "Total_Sales"),
    "regional_performance": ("Region", "State", "Total_Sales"),
    "loss_making_products": ("Category", "Product Name", "Total_Loss"),
    "discount_impact": ("Discount_Bucket", "Discount_Bucket", "Total_Sales"),
    "executive_kpis": ("Order_Year", "Order_Year", "Total_Sales"),
}


def q_ordered_marts(spark, sf):
    """All six marts, published in their order and read back with their positions."""
    store = Store(spark, base_path=scratch(spark, "ordered"))
    silver = stored_rows(silver_from_tables(spark, sf).select(*[col(c) for c in dashboard.MART_COLUMNS]))
    parts = []
    for name, fn in marts.MARTS.items():
        mart = fn(silver)
        publish_mart(store, mart, name, partition_by=marts.MART_PARTITION[name], created_at=FIXED_BATCH_TIME, order=marts.total_order(mart, name))
        a, b, value = MART_LABELS[name]
        parts.append(read_mart(store, name).select(
            F.lit(name).alias("mart"), F.col("_position").alias("position"), col(a).cast("string").alias("label"),
            col(b).cast("string").alias("label2"), col(value).alias("value")))
    return files.union_by_name(parts)


def filtered_mart(name: str) -> Query:
    """A mart under the year, region and category filters."""
    return _silver(lambda s: marts.MARTS[name](dashboard.filter_silver(s, FILTER_YEARS, FILTER_REGIONS, FILTER_CATEGORIES)))


def q_null_recheck(spark, sf):
    """NULLs left in the cleaned rows' columns (none where a default or a gate applies)."""
    return clean.null_profile(clean_rows(text_bronze(spark, sf)), max_null_pct=Thresholds().max_null_pct)


def q_split_reps(spark, sf):
    """The reps that the split gives, with the sales rows of their region."""
    raw = fixture.raw_sales(spark, sf, defects=False)
    reps = prep.split_sources(raw, reps_rows=fixture.FIXTURE_SALESPEOPLE)["salesperson"]
    rows = raw.groupBy("Region").agg(F.count(F.lit(1)).alias("rows"))
    return reps.join(rows, "Region", "left")


def q_preview(spark, sf):
    """The five largest sales, some columns of them."""
    raw = fixture.raw_sales(spark, sf, defects=False)
    top = raw.orderBy(col("Sales").desc(), col("Order ID"), col("Product ID"), col("Quantity"))
    return columns.preview(top, 5, ["Order ID", "Product ID", "Sales", "No Such Column"])


def q_parquet_roundtrip(spark, sf):
    s = silver_from_tables(spark, sf)
    path = scratch(spark, "parquet")
    write_table(s, path, partition_by="Order_Year")
    back = files.read_parquet(spark, path)
    return marts.executive_kpis(back)


def q_table_roundtrip(spark, sf):
    store = Store(spark, base_path=scratch(spark, "store"))
    b = bronze_from_tables(spark, sf)
    store.write(b, "bronze", "orders_raw", partition_by="Source_Year")
    return store.read("bronze", "orders_raw").groupBy("Source_Year").agg(F.count(F.lit(1)).alias("rows"))


def q_csv_text_read(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    path = scratch(spark, "csvtext")
    export_csv(raw, path)
    text = files.read_csv(spark, path)  # header only: every column is a string
    return text.groupBy("Source_Year").agg(F.count(F.lit(1)).alias("rows"))


def q_catalog_roundtrip(spark, sf):
    store = Store(spark, base_path=scratch(spark, "catalog"), use_catalog=True, prefix="q" + uuid.uuid4().hex[:10])
    store.create_databases()
    from ledgerlake.plans.pipeline import order_buckets

    b = bronze_from_tables(spark, sf)
    store.write(b, "bronze", "orders_raw", partition_by="Source_Year", bucket_by=order_buckets(store))
    back = files.read_table(spark, store.location("bronze", "orders_raw"))
    return back.groupBy("Source_Year").agg(F.count(F.lit(1)).alias("rows"))


def q_csv_pipeline_kpis(spark, sf):
    """Files in, KPIs out: yearly CSV folders + returns + reps CSV -> gates -> bronze -> silver -> KPIs.

    The files are compressed, and both the rows that are written and those that are read are joined a part of the
    orders at a time: what is shuffled for a part is gone before the next.
    """
    from ledgerlake.config import MANDATORY_COLS

    base = scratch(spark, "csvpipe")
    parts = fixture.parts(spark, sf)
    for part in parts:
        raw = fixture.raw_text(spark, sf, part)
        # keep the text exactly as produced (the CSV writer trims spaces by default)
        with shuffles_freed(spark):
            (raw.drop("Source_Year").write.mode("append" if part[0] else "overwrite").option("header", True).option("compression", "gzip")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .partitionBy("Source_File").csv(f"{base}/orders"))
    export_csv(fixture.returns_source(spark, sf), f"{base}/returns", compression="gzip")
    export_csv(fixture.salespeople(spark), f"{base}/salesperson", single_file=True)
    files.require_sources(spark, [f"{base}/orders", f"{base}/returns", f"{base}/salesperson"])
    cols = [c for c in raw.columns if c not in ("Source_Year", "Source_File")]
    orders = files.read_yearly(spark, [f"{base}/orders/*/"], files.text_schema(cols), required=MANDATORY_COLS)
    orders = orders.withColumn("Source_File", F.substring_index(F.col("Source_File"), "=", -1))
    returns = files.read_csv(spark, f"{base}/returns")
    reps = files.read_csv(spark, f"{base}/salesperson").withColumn("Target_Sales", F.col("Target_Sales").try_cast("int"))
    with dealt_rows("Order ID", len(parts), orders, returns) as dealt:
        bronze = [build_bronze(o, r, reps, batch_time=FIXED_BATCH_TIME) for o, r in dealt]
        silver = [build_silver(b, silver_time=FIXED_BATCH_TIME).select(*[col(c) for c in marts.KPI_COLUMNS]) for b in bronze]
        silver = stored_parts(silver)
    return marts.executive_kpis(silver)


def q_publish_mart(spark, sf):
    store = Store(spark, base_path=scratch(spark, "gold"))
    k = marts.executive_kpis(silver_from_tables(spark, sf))
    publish_mart(store, k, "executive_kpis", created_at=FIXED_BATCH_TIME, csv_base=scratch(spark, "goldcsv"))
    return store.read("gold", "executive_kpis")


def q_multi_year_scan(spark, sf):
    raw = fixture.raw_sales(spark, sf)
    base = scratch(spark, "yearly")
    raw.drop("Source_Year").write.mode("overwrite").option("header", True).partitionBy("Source_File").csv(base)
    schema = files.text_schema([c for c in raw.columns if c not in ("Source_Year", "Source_File")])
    df = files.read_yearly(spark, [f"{base}/*/"], schema, required=["Order ID", "Sales", "Region"])
    df = df.withColumn("Source_File", F.substring_index(F.col("Source_File"), "=", -1))
    return df.groupBy("Source_Year", "Source_File").agg(
        F.count(F.lit(1)).alias("rows"), marts.round_money_sum(col("Sales").try_cast("double")).alias("Total_Sales"))


def q_schema_gate(spark, sf):
    """Required columns: present or not, and non-NULL values of the present ones (one pass)."""
    raw = fixture.raw_sales(spark, sf)
    need = ["Order ID", "Order Date", "Sales", "Profit", "Discount", "Category", "Region", "Postal Code", "Country"]
    miss = set(files.missing_columns(raw, need))
    have = [c for c in need if c not in miss]
    counts = raw.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(have)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c not in miss).alias("present"),
                     (F.col(f"n{have.index(c)}") if c in have else F.lit(None).cast("bigint")).alias("non_null"))
            for c in need]
    return counts.select(F.inline(F.array(*rows)))


def q_sources_gate(spark, sf):
    """Each source: present (visible files) and its row count."""
    from ledgerlake.sinks.writers import path_has_files

    names = ["lineitem", "orders", "customer", "part", "nation", "region", "missing_table"]
    parts = []
    for n in names:
        path = f"{sf.rstrip('/')}/{n}.parquet"
        if path_has_files(spark, path):
            parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(n).alias("source"), F.lit(True).alias("present"), "rows"))
        else:
            parts.append(spark.range(1).select(F.lit(n).alias("source"), F.lit(False).alias("present"),
                                               F.lit(None).cast("bigint").alias("rows")))
    return files.union_by_name(parts)


def q_verify_tables(spark, sf):
    store = Store(spark, base_path=scratch(spark, "verify"))
    # stored once: each mart would replay the joins and the cleaning
    s = stored_rows(silver_from_tables(spark, sf).select(*[col(c) for c in dashboard.MART_COLUMNS]))
    for name in ["sales_trend", "discount_impact", "executive_kpis"]:
        store.write(marts.MARTS[name](s), "gold", name)
    return verify_tables(store, "gold", list(marts.MARTS))


def q_shape_profile(spark, sf):
    return files.shape(fixture.raw_sales(spark, sf)).select("rows", "columns")


def q_retention_gate(spark, sf):
    b = bronze_from_tables(spark, sf)
    return retention(b, build_silver(b, silver_time=FIXED_BATCH_TIME))


def q_dq_report(spark, sf):
    rep = quality.validation_report(suite(spark, sf), VALIDATION_TIME, coverage=FIXTURE_COVERAGE)
    return quality.ordered_report(rep)


def q_pipeline_end_to_end(spark, sf):
    from ledgerlake.plans.pipeline import run_all

    store = Store(spark, base_path=scratch(spark, "pipeline"))
    res = run_all(store, fixture.raw_sales(spark, sf), fixture.returns_source(spark, sf), fixture.salespeople(spark),
                  batch_time=FIXED_BATCH_TIME, coverage=FIXTURE_COVERAGE, order_ids=fixture.order_ids(spark, sf))
    return res.report


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name, fn in marts.MARTS.items():
        q[name] = _silver(fn)
    q.update(
        {
            "total_loss": _silver(marts.total_loss),
            "silver_by_year": _silver(marts.silver_by_year),
            "silver_by_category": _silver(marts.silver_by_category),
            "silver_by_region": _silver(marts.silver_by_region),
            "derived_sanity": _silver(marts.derived_sanity),
            "inline_stats": _silver(marts.inline_stats),
            # dashboard datasets
            "kpi_cards": _mart("executive_kpis", dashboard.kpi_cards),
            "monthly_series": _mart("sales_trend", dashboard.monthly_series),
            "category_bars": _mart("category_performance", dashboard.category_bars),
            "region_target_status": _mart("regional_performance", dashboard.region_target_status),
            "salesperson_performance": _mart("regional_performance", dashboard.salesperson_performance),
            "discount_margin": _mart("discount_impact", dashboard.discount_margin),
            "top_loss_severity": _mart("loss_making_products", dashboard.top_loss_severity),
            **{f"filtered_{name}": filtered_mart(name) for name in marts.MARTS},
            "filtered_kpis": _silver(lambda s: dashboard.filtered_kpis(s, FILTER_YEARS, FILTER_REGIONS)),
            # derived columns
            "derived_columns": q_derived_columns,
            "discount_buckets": q_discount_buckets,
            "returned_enrichment": q_returned_enrichment,
            # joins
            "join_returns_left": q_join_returns_left,
            "join_returns_hot": q_join_returns_hot,
            "hot_order_kpis": q_hot_order_kpis,
            "join_rep_broadcast": q_join_rep_broadcast,
            "unmatched_regions": q_unmatched_regions,
            "row_inflation_guard": q_row_inflation_guard,
            "year_multiplier_lookup": q_year_multiplier_lookup,
            # dedup
            "dedup_deterministic": q_dedup_deterministic,
            "dedup_report": q_dedup_report,
            "duplicate_rate": q_duplicate_rate,
            "distinct_values": q_distinct_values,
            "returns_dedup": q_returns_dedup,
            # cleaning
            "drop_mandatory_nulls": q_drop_mandatory_nulls,
            "fill_defaults": q_fill_defaults,
            "case_null_default": q_case_null_default,
            "title_case": q_title_case,
            "parse_dates": q_parse_dates,
            "unparseable_dates": q_unparseable_dates,
            "coerce_types": q_coerce_types,
            "non_finite_sales": q_non_finite_sales,
            "clamp_discount": q_clamp_discount,
            "null_profile": q_null_profile,
            "null_recheck": q_null_recheck,
            "remove_invalid_sales": q_remove_invalid_sales,
            "distinct_standardization": q_distinct_standardization,
            "text_pipeline_kpis": q_text_pipeline_kpis,
            # filters
            "filter_null": q_filter_null,
            "filter_flag": q_filter_flag,
            "filter_threshold": q_filter_threshold,
            "filter_range_or": q_filter_range_or,
            "filter_consistency": q_filter_consistency,
            "filter_year_null_state": q_filter_year_null_state,
            "filter_casing": q_filter_casing,
            "filter_tolerance": q_filter_tolerance,
            # set operations
            "union_years": q_union_years,
            "append_sample": q_append_sample,
            "coverage_gap": q_coverage_gap,
            # windows
            "rank_in_category": q_rank_in_category,
            "rank_in_region": q_rank_in_region,
            "global_rank": q_global_rank,
            "global_rank_desc": q_global_rank_desc,
            "yoy_lag": q_yoy_lag,
            "yoy_strict": q_yoy_strict,
            "year_row_ids": q_year_row_ids,
            # projections and scalar functions
            "record_hash": q_record_hash,
            "const_columns": q_const_columns,
            "scalar_text": q_scalar_text,
            "scalar_date": q_scalar_date,
            "scalar_math": q_scalar_math,
            # sorts / limits
            "ordered_report": q_ordered_report,
            "top_20_losses": q_top_20_losses,
            # aggregates
            "mode_year": q_mode_year,
            "global_profile": q_global_profile,
            "conditional_counts": q_conditional_counts,
            # data preparation
            "shift_years": q_shift_years,
            "scale_years": q_scale_years,
            "expand_years": q_expand_years,
            "seeded_sample": q_seeded_sample,
            "exact_sample": q_exact_sample,
            "generate_years": q_generate_years,
            "random_label": q_random_label,
            "inject_defects": q_inject_defects,
            "defect_audit": q_defect_audit,
            "split_sources": q_split_sources,
            "split_orders": q_split_orders,
            "split_reps": q_split_reps,
            # sources and sinks
            "csv_roundtrip": q_csv_roundtrip,
            "encoding_read": q_encoding_read,
            "land_csv": q_land_csv,
            "ordered_marts": q_ordered_marts,
            "preview": q_preview,
            "parquet_roundtrip": q_parquet_roundtrip,
            "table_roundtrip": q_table_roundtrip,
            "publish_mart": q_publish_mart,
            "csv_text_read": q_csv_text_read,
            "csv_pipeline_kpis": q_csv_pipeline_kpis,
            "catalog_roundtrip": q_catalog_roundtrip,
            "multi_year_scan": q_multi_year_scan,
            "schema_gate": q_schema_gate,
            "sources_gate": q_sources_gate,
            "verify_tables": q_verify_tables,
            "shape_profile": q_shape_profile,
            # quality suite
            "dq_category_1": dq_category(CAT1),
            "dq_category_2": dq_category(CAT2),
            "dq_category_3": dq_category(CAT3),
            "dq_report": q_dq_report,
            "retention_gate": q_retention_gate,
            "pipeline_end_to_end": q_pipeline_end_to_end,
        }
    )
    return q
