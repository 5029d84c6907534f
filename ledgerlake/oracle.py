"""DuckDB SQL for the correctness gate: the same results, written as plain SQL.

The driver registers the parquet tables as views and runs each string next to
our Spark query. Rules that keep both engines bit-identical:
* ``sround(x, n)`` reproduces Spark's ``round`` on DOUBLE (half-up on the
  shortest decimal text of the value);
* money sums are DECIMAL sums cast to DOUBLE; averages are such a sum divided
  by the count, in DOUBLE;
* ``initcap`` is spelled out (lower-case, upper-case the first letter of each
  space-separated word);
* NULL ordering is always explicit.
"""

from __future__ import annotations

from ledgerlake.config import (
    DISCOUNT_BUCKET_OVERFLOW,
    DISCOUNT_BUCKETS,
    FILL_DEFAULTS,
    INJECT_CASE_PCT,
    INJECT_DISCOUNT_PCT,
    INJECT_DUPLICATE_PCT,
    INJECT_NULL_PCT,
    MANDATORY_COLS,
    NOT_RETURNED,
    RANDOM_SEED,
    RETURN_REASONS,
    RETURN_SAMPLE_PCT,
)
from ledgerlake.plans.bronze import ENRICH_COLUMNS
from ledgerlake.plans.flow import FIXED_BATCH_TIME, FIXED_SILVER_TIME
from ledgerlake.sources import fixture


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def sround(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def initcap(expr: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({expr}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def title(expr: str) -> str:
    return initcap(f"trim({expr})")


def money_sum(expr: str, n: int = 2) -> str:
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(24,6))), {n}) AS DOUBLE)"


def exact_avg(expr: str) -> str:
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(24,6))) AS DOUBLE) / NULLIF(CAST(COUNT({expr}) AS DOUBLE), 0))"


def pct(num: str, den: str, n: int = 2) -> str:
    return sround(f"({num}) / NULLIF({den}, 0) * 100", n)


def loss_count(expr: str = '"Is_Loss"') -> str:
    return f"CAST(SUM(CAST({expr} AS INTEGER)) AS BIGINT)"


def bucket(expr: str) -> str:
    (zero, zero_label), *rest = DISCOUNT_BUCKETS
    parts = [f"WHEN {expr} = {zero} THEN {lit(zero_label)}"]
    parts += [f"WHEN {expr} <= {b} THEN {lit(label)}" for b, label in rest]
    return "CASE " + " ".join(parts) + f" ELSE {lit(DISCOUNT_BUCKET_OVERFLOW)} END"


RAW_COLS = fixture.RAW_COLUMNS
BRONZE_DATA_COLS = RAW_COLS + ENRICH_COLUMNS


def _reasons_array() -> str:
    return "[" + ", ".join(lit(r) for r in RETURN_REASONS) + "]"


def _reps_values() -> str:
    rows = ", ".join(f"({lit(r)}, {lit(s)}, {t})" for r, s, t in fixture.FIXTURE_SALESPEOPLE)
    return f"SELECT * FROM (VALUES {rows}) AS t(\"Region\", \"Salesperson\", \"Target_Sales\")"


def cte_raw() -> str:
    f = fixture
    profit = (
        "CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"
        " - CAST(0.9 AS DECIMAL(2,1)) * CAST(l.l_quantity AS DECIMAL(9,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))"
        " AS DECIMAL(18,2)) AS DOUBLE)"
    )
    kc = '("Order ID" + _copy)'
    nulled = f'("Order ID" % {f.NULL_EVERY} = 0)'
    return f"""
cust AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
clean_sales AS (
  SELECT l.l_orderkey AS "Order ID", CAST(o.o_orderdate AS DATE) AS "Order Date", CAST(l.l_shipdate AS DATE) AS "Ship Date",
    o.o_orderpriority AS "Ship Mode", o.o_custkey AS "Customer ID", c.c_name AS "Customer Name", c.c_mktsegment AS "Segment",
    c.n_name AS "State", {initcap('c.r_name')} AS "Region", l.l_partkey AS "Product ID", p.p_type AS "Category",
    p.p_brand AS "Sub-Category", p.p_name AS "Product Name", l.l_extendedprice AS "Sales",
    CAST(l.l_quantity AS INTEGER) AS "Quantity", l.l_discount AS "Discount", {profit} AS "Profit",
    CAST(year(o.o_orderdate) AS INTEGER) AS "Source_Year", 'sales_' || CAST(year(o.o_orderdate) AS VARCHAR) AS "Source_File"
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN cust c ON o.o_custkey = c.c_custkey
),
copies AS (
  SELECT s.*, 0 AS _copy FROM clean_sales s
  UNION ALL
  SELECT s.*, 1 AS _copy FROM clean_sales s WHERE "Order ID" % {f.DUPLICATE_EVERY} = 0
),
raw AS (
  SELECT {", ".join(_raw_select(c, kc, nulled) for c in RAW_COLS)}
  FROM copies
)"""


def _raw_select(c: str, kc: str, nulled: str) -> str:
    f = fixture
    if c == "Region":
        return (f"CASE WHEN {kc} % {f.CASE_EVERY} = 0 THEN upper(\"Region\") WHEN {kc} % {f.CASE_EVERY} = 1 "
                f"THEN lower(\"Region\") ELSE \"Region\" END AS \"Region\"")
    if c == "Discount":
        return f"CASE WHEN {kc} % {f.DISCOUNT_EVERY} = 0 THEN \"Discount\" * 10 ELSE \"Discount\" END AS \"Discount\""
    if c in f.NULLED_COLUMNS:
        return f"CASE WHEN {nulled} THEN NULL ELSE {q(c)} END AS {q(c)}"
    return q(c)


def cte_rawtext() -> str:
    """All-text raw rows plus the text-level defects (mirrors fixture.text_sales)."""
    d = fixture.TEXT_DEFECTS
    k = '"Order ID"'

    def every(name):
        return f"({k} % {d[name]} = 0)"

    cols = []
    for c in RAW_COLS:
        if c in ("Order Date", "Ship Date"):
            base = f"strftime({q(c)}, '%-m/%-d/%Y')"
        else:
            base = f"CAST({q(c)} AS VARCHAR)"
        if c == "Sales":
            base = f"CASE WHEN {every('bad_sales_text')} THEN 'n/a' WHEN {every('zero_sales')} THEN '0' ELSE {base} END"
        elif c == "Order Date":
            base = (f"CASE WHEN {every('bad_order_date')} THEN '13/45/' || CAST(year(\"Order Date\") AS VARCHAR) "
                    f"ELSE {base} END")
        elif c == "Profit":
            base = f"CASE WHEN {every('null_profit')} THEN NULL ELSE {base} END"
        elif c == "Region":
            base = f"CASE WHEN {every('padded_region')} THEN '  ' || lower(\"Region\") || ' ' ELSE {base} END"
        elif c == "Quantity":
            base = f"CASE WHEN {every('bad_quantity')} THEN 'x' ELSE {base} END"
        elif c == "Discount":
            base = f"CASE WHEN {every('empty_discount')} THEN '' ELSE {base} END"
        cols.append(f"{base} AS {q(c)}")
    return f"rawtext AS (SELECT {', '.join(cols)} FROM raw)"


def cte_returns() -> str:
    return f"""ret AS (
  SELECT l_orderkey AS "Order ID", {_reasons_array()}[((l_orderkey * 31 + l_linenumber) % 5) + 1] AS "Return Reason"
  FROM lineitem WHERE l_returnflag = 'R'
),
ret_d AS (SELECT "Order ID", min("Return Reason") AS "Return Reason", TRUE AS "Is_Returned" FROM ret GROUP BY "Order ID"),
ret_dt AS (SELECT CAST("Order ID" AS VARCHAR) AS "Order ID", "Return Reason", "Is_Returned" FROM ret_d),
reps AS ({_reps_values()})"""


def bronze_select(src: str, ret: str, name: str, text: bool = False, batch_time: str = FIXED_BATCH_TIME) -> str:
    if text:
        sales_txt = 'CAST(r."Sales" AS VARCHAR)'
    else:
        sales_txt = 'CAST(CAST(r."Sales" AS DECIMAL(24,6)) AS VARCHAR)'
    parts = ", ".join(['CAST(r."Order ID" AS VARCHAR)', 'CAST(r."Product ID" AS VARCHAR)', sales_txt,
                       'CAST(r."Source_Year" AS VARCHAR)'])
    raw_cols = ", ".join(f"r.{q(c)}" for c in RAW_COLS)
    return f"""{name} AS (
  SELECT {raw_cols},
    coalesce(d."Return Reason", {lit(NOT_RETURNED)}) AS "Return Reason",
    coalesce(d."Is_Returned", FALSE) AS "Is_Returned",
    p."Salesperson", p."Target_Sales",
    CAST({lit(batch_time)} AS TIMESTAMP) AS "_ingestion_timestamp",
    strftime(CAST({lit(batch_time)} AS TIMESTAMP), '%Y%m%d_%H%M%S') AS "_batch_id",
    'BRONZE' AS "_source_layer",
    md5(concat_ws('|', {parts})) AS "_record_hash"
  FROM {src} r LEFT JOIN {ret} d ON r."Order ID" = d."Order ID" LEFT JOIN reps p ON r."Region" = p."Region"
)"""


def cte_bronze(batch_time: str = FIXED_BATCH_TIME) -> str:
    return f"""{cte_raw()},
{cte_returns()},
{bronze_select("raw", "ret_d", "bronze", batch_time=batch_time)}"""


TEXT_PRESENT = ["Region", "Category", "Sub-Category", "Segment", "Ship Mode", "State"]


def silver_chain(src: str, p: str, text: bool = False, silver_time: str = FIXED_SILVER_TIME) -> str:
    """CTEs {p}dedup ... {p}silver from bronze-shaped ``src``."""
    gap = " OR ".join(f"{q(c)} IS NULL" for c in MANDATORY_COLS)
    order = ", ".join([f"CASE WHEN {gap} THEN 1 ELSE 0 END"] + [f"{q(c)} ASC NULLS LAST" for c in BRONZE_DATA_COLS])
    not_null = " AND ".join(f"{q(c)} IS NOT NULL" for c in MANDATORY_COLS)
    fills = ", ".join(
        f"coalesce({q(c)}, {lit(v)}) AS {q(c)}" for c, v in FILL_DEFAULTS.items() if c in BRONZE_DATA_COLS
    )
    texts = ", ".join(f"{title(q(c))} AS {q(c)}" for c in TEXT_PRESENT)
    if text:
        typed = (f"SELECT * REPLACE ("
                 f"CAST(try_strptime(\"Order Date\", '%m/%d/%Y') AS DATE) AS \"Order Date\", "
                 f"CAST(try_strptime(\"Ship Date\", '%m/%d/%Y') AS DATE) AS \"Ship Date\", "
                 f"try_cast(\"Sales\" AS DOUBLE) AS \"Sales\", try_cast(\"Profit\" AS DOUBLE) AS \"Profit\", "
                 f"try_cast(\"Discount\" AS DOUBLE) AS \"Discount\", try_cast(\"Quantity\" AS INTEGER) AS \"Quantity\") "
                 f"FROM {p}texted")
    else:
        typed = f"SELECT * FROM {p}texted"
    return f"""{p}dedup AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Order ID", "Product ID", "Source_Year" ORDER BY {order}) AS _rn FROM {src}
  ) WHERE _rn = 1
),
{p}nn AS (SELECT * FROM {p}dedup WHERE {not_null}),
{p}filled AS (SELECT * REPLACE ({fills}) FROM {p}nn),
{p}texted AS (SELECT * REPLACE ({texts}) FROM {p}filled),
{p}typed0 AS ({typed}),
{p}typed AS (
  SELECT * REPLACE (least(greatest("Discount", 0.0), 1.0) AS "Discount") FROM {p}typed0 WHERE "Sales" > 0
),
{p}silver AS (
  SELECT *,
    CASE WHEN "Sales" != 0 THEN {sround('"Profit" / "Sales" * 100', 2)} ELSE 0.0 END AS "Profit_Margin_Pct",
    {sround('"Sales" * "Discount"', 2)} AS "Discount_Amount",
    "Profit" < 0 AS "Is_Loss",
    CAST(year("Order Date") AS INTEGER) AS "Order_Year",
    CAST(month("Order Date") AS INTEGER) AS "Order_Month",
    CAST(quarter("Order Date") AS INTEGER) AS "Order_Quarter",
    CAST(greatest("Ship Date" - "Order Date", 0) AS INTEGER) AS "Shipping_Days",
    CAST({lit(silver_time)} AS TIMESTAMP) AS "_silver_timestamp"
  FROM {p}typed
)"""


def cte_silver(silver_time: str = FIXED_SILVER_TIME) -> str:
    return f"""{cte_bronze()},
{silver_chain("bronze", "", silver_time=silver_time)}"""


def with_silver(select: str) -> str:
    return "WITH " + cte_silver() + "\n" + select


# --- marts -------------------------------------------------------------------

SALES_TREND = f"""
SELECT *, CASE WHEN "Total_Sales" != 0 THEN {pct('"Total_Profit"', '"Total_Sales"')} ELSE 0.0 END AS "Profit_Margin_Pct"
FROM (
  SELECT "Order_Year", "Order_Month", "Order_Quarter",
    {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
    COUNT(DISTINCT "Order ID") AS "Total_Orders", CAST(SUM("Quantity") AS BIGINT) AS "Total_Quantity",
    {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount", {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Margin_Pct",
    {loss_count()} AS "Loss_Count"
  FROM silver GROUP BY "Order_Year", "Order_Month", "Order_Quarter"
)"""

CATEGORY = f"""
SELECT *, CAST(rank() OVER (PARTITION BY "Category" ORDER BY "Total_Sales" DESC NULLS LAST) AS INTEGER) AS "Sales_Rank"
FROM (
  SELECT *, {pct('"Total_Profit"', '"Total_Sales"')} AS "Profit_Margin_Pct", {pct('"Loss_Count"', '"Total_Orders"')} AS "Loss_Rate_Pct"
  FROM (
    SELECT "Category", "Sub-Category",
      {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
      COUNT(DISTINCT "Order ID") AS "Total_Orders", CAST(SUM("Quantity") AS BIGINT) AS "Total_Quantity",
      {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount", {loss_count()} AS "Loss_Count",
      {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Margin_Pct"
    FROM silver GROUP BY "Category", "Sub-Category"
  )
)"""

REGIONAL = f"""
SELECT *, CAST(rank() OVER (PARTITION BY "Region" ORDER BY "Total_Sales" DESC NULLS LAST) AS INTEGER) AS "Region_Sales_Rank"
FROM (
  SELECT *, {pct('"Total_Profit"', '"Total_Sales"')} AS "Profit_Margin_Pct",
    CASE WHEN "Target_Sales" > 0 THEN {pct('"Total_Sales"', '"Target_Sales"')} ELSE 0.0 END AS "Sales_vs_Target_Pct",
    {pct('"Loss_Count"', '"Total_Orders"')} AS "Loss_Rate_Pct"
  FROM (
    SELECT "Region", "State", "Salesperson", "Target_Sales",
      {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
      COUNT(DISTINCT "Order ID") AS "Total_Orders", CAST(SUM("Quantity") AS BIGINT) AS "Total_Quantity",
      {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount", {loss_count()} AS "Loss_Count",
      {sround(exact_avg('"Shipping_Days"'), 1)} AS "Avg_Shipping_Days"
    FROM silver GROUP BY "Region", "State", "Salesperson", "Target_Sales"
  )
)"""

LOSS_PRODUCTS = f"""
SELECT *, CAST(rank() OVER (ORDER BY "Total_Loss" ASC NULLS FIRST) AS BIGINT) AS "Loss_Rank"
FROM (
  SELECT *, {sround('"Total_Loss" / NULLIF("Loss_Transactions", 0)', 2)} AS "Loss_Per_Transaction"
  FROM (
    SELECT "Category", "Sub-Category", "Product Name",
      {money_sum('"Profit"')} AS "Total_Loss", COUNT(DISTINCT "Order ID") AS "Loss_Transactions",
      {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount", {money_sum('"Sales"')} AS "Total_Sales",
      {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Loss_Margin",
      {sround(exact_avg('"Shipping_Days"'), 1)} AS "Avg_Shipping_Days"
    FROM silver WHERE "Is_Loss" GROUP BY "Category", "Sub-Category", "Product Name"
  )
)"""

DISCOUNT = f"""
SELECT *, {pct('"Total_Profit"', '"Total_Sales"')} AS "Profit_Margin_Pct",
  {pct('"Loss_Transactions"', '"Total_Orders"')} AS "Loss_Rate_Pct"
FROM (
  SELECT {bucket('"Discount"')} AS "Discount_Bucket",
    {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
    COUNT(DISTINCT "Order ID") AS "Total_Orders",
    {sround(exact_avg('"Sales"'), 2)} AS "Avg_Order_Sales", {sround(exact_avg('"Profit"'), 2)} AS "Avg_Order_Profit",
    {loss_count()} AS "Loss_Transactions", {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount"
  FROM silver GROUP BY 1
)"""


def _growth(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} IS NOT NULL AND {prev} != 0 THEN {sround(f'({cur} - {prev}) / {prev} * 100', 2)} ELSE NULL END"


KPIS = f"""
SELECT * EXCLUDE ("Prev_Year_Sales", "Prev_Year_Profit"),
  {_growth('"Total_Sales"', '"Prev_Year_Sales"')} AS "YoY_Sales_Growth_Pct",
  {_growth('"Total_Profit"', '"Prev_Year_Profit"')} AS "YoY_Profit_Growth_Pct"
FROM (
  SELECT *, {pct('"Total_Profit"', '"Total_Sales"')} AS "Profit_Margin_Pct",
    {pct('"Loss_Transactions"', '"Total_Transactions"')} AS "Loss_Rate_Pct",
    {pct('"Returned_Orders"', '"Total_Orders"')} AS "Return_Rate_Pct",
    lag("Total_Sales") OVER (ORDER BY "Order_Year" ASC NULLS FIRST) AS "Prev_Year_Sales",
    lag("Total_Profit") OVER (ORDER BY "Order_Year" ASC NULLS FIRST) AS "Prev_Year_Profit"
  FROM (
    SELECT "Order_Year", {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
      COUNT(DISTINCT "Order ID") AS "Total_Orders", CAST(SUM("Quantity") AS BIGINT) AS "Total_Units_Sold",
      {sround(exact_avg('"Sales"'), 2)} AS "Avg_Order_Value", {sround(exact_avg('"Discount"'), 4)} AS "Avg_Discount",
      {sround(exact_avg('"Shipping_Days"'), 2)} AS "Avg_Shipping_Days", {loss_count()} AS "Loss_Transactions",
      COUNT("Order ID") AS "Total_Transactions", {loss_count('"Is_Returned"')} AS "Returned_Orders",
      {money_sum('"Discount_Amount"')} AS "Total_Discount_Given"
    FROM silver GROUP BY "Order_Year"
  )
)"""

TOTAL_LOSS = f"""SELECT {money_sum('"Profit"')} AS "Total_Loss_Amount" FROM silver WHERE "Is_Loss" """

SILVER_BY_YEAR = f"""
SELECT "Order_Year", COUNT(*) AS "Total_Rows", COUNT(DISTINCT "Order ID") AS "Unique_Orders",
  {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
  {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Margin_Pct",
  CAST(SUM(CASE WHEN "Is_Loss" THEN 1 ELSE 0 END) AS BIGINT) AS "Loss_Count"
FROM silver GROUP BY "Order_Year" """

SILVER_BY_CATEGORY = f"""
SELECT "Category", COUNT(*) AS "Total_Rows", {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit",
  {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Margin_Pct"
FROM silver GROUP BY "Category" """

SILVER_BY_REGION = f"""
SELECT "Region", COUNT(*) AS "Total_Rows", {money_sum('"Sales"')} AS "Total_Sales", {money_sum('"Profit"')} AS "Total_Profit"
FROM silver GROUP BY "Region" """

DERIVED_SANITY = f"""
SELECT MIN("Profit_Margin_Pct") AS "Min_Margin", MAX("Profit_Margin_Pct") AS "Max_Margin",
  {exact_avg('"Profit_Margin_Pct"')} AS "Avg_Margin",
  MIN("Shipping_Days") AS "Min_Ship_Days", MAX("Shipping_Days") AS "Max_Ship_Days",
  {exact_avg('"Shipping_Days"')} AS "Avg_Ship_Days",
  CAST(SUM(CASE WHEN "Is_Loss" THEN 1 ELSE 0 END) AS BIGINT) AS "Total_Loss_Records",
  MIN("Order_Year") AS "Min_Year", MAX("Order_Year") AS "Max_Year"
FROM silver"""

INLINE_STATS = f"""
SELECT COUNT(*) FILTER (WHERE "Is_Loss") AS "Loss_Records",
  {sround(exact_avg('"Profit_Margin_Pct"'), 2)} AS "Avg_Margin_Pct",
  {sround(exact_avg('"Shipping_Days"'), 1)} AS "Avg_Shipping_Days",
  COUNT(*) FILTER (WHERE "Is_Returned") AS "Returned_Records"
FROM silver"""


MART_CTES = {
    "trend": SALES_TREND,
    "category": CATEGORY,
    "regional": REGIONAL,
    "loss": LOSS_PRODUCTS,
    "discount": DISCOUNT,
    "kpis": KPIS,
}


def build(select: str, *extra: str, marts_needed: tuple[str, ...] = (), text: bool = False, csv: bool = False) -> str:
    """WITH <raw/bronze/silver chain>[, text chain][, csv chain][, marts][, extra] <select>."""
    ctes = [cte_silver()]
    if text or csv:
        ctes.append(cte_rawtext())
        ctes.append(bronze_select("rawtext", "ret_dt", "tbronze", text=True))
        ctes.append(silver_chain("tbronze", "t", text=True, silver_time=FIXED_BATCH_TIME))
    if csv:
        # a CSV reader turns an empty field into NULL
        nulled = ", ".join(f"NULLIF({q(c)}, '') AS {q(c)}" for c in RAW_COLS)
        ctes.append(f"rawcsv AS (SELECT {nulled} FROM rawtext)")
        ctes.append(bronze_select("rawcsv", "ret_dt", "cbronze", text=True))
        ctes.append(silver_chain("cbronze", "c", text=True, silver_time=FIXED_BATCH_TIME))
    for m in marts_needed:
        ctes.append(f"{m} AS ({MART_CTES[m]})")
    ctes.extend(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + select


def on_source(sql_text: str, source: str) -> str:
    """Re-point a query written against ``silver`` to another relation."""
    return sql_text.replace("FROM silver", f"FROM {source}")


KEYS = '"Order ID", "Product ID", "Source_Year"'


def _kpi_cards() -> str:
    return build("""SELECT "Order_Year", "Total_Sales", "Total_Profit", "Profit_Margin_Pct", "YoY_Sales_Growth_Pct",
  "YoY_Profit_Growth_Pct" FROM kpis WHERE "Order_Year" = (SELECT max("Order_Year") FROM kpis)""", marts_needed=("kpis",))


def _status_case(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'No Target' WHEN {x} >= 100 THEN 'Met' WHEN {x} >= 80 THEN 'Near' "
            f"ELSE 'Below' END")


def _region_target() -> str:
    return build(f"""SELECT *, {_status_case('"Sales_vs_Target_Pct"')} AS "Target_Status" FROM (
  SELECT *, CASE WHEN "Target_Sales" > 0 THEN {pct('"Region_Sales"', '"Target_Sales"')} END AS "Sales_vs_Target_Pct"
  FROM (SELECT "Region", "Salesperson", "Target_Sales", {money_sum('"Total_Sales"')} AS "Region_Sales",
          COUNT(*) AS "States" FROM regional GROUP BY 1, 2, 3))""", marts_needed=("regional",))


def _salesperson() -> str:
    return build(f"""SELECT *, {pct('"Total_Profit"', '"Total_Sales"')} AS "Profit_Margin_Pct" FROM (
  SELECT "Region", "Salesperson", {money_sum('"Total_Sales"')} AS "Total_Sales", {money_sum('"Total_Profit"')} AS "Total_Profit",
    CAST(SUM("Total_Orders") AS BIGINT) AS "Total_Orders", CAST(SUM("Loss_Count") AS BIGINT) AS "Loss_Count",
    COUNT(*) AS "States" FROM regional GROUP BY 1, 2)""", marts_needed=("regional",))


def _top_loss() -> str:
    share = sround('"Total_Loss" / NULLIF(tot, 0) * 100', 2)
    return build(f"""SELECT "Category", "Sub-Category", "Product Name", "Total_Loss", "Loss_Rank", "Loss_Share_Pct",
  CASE WHEN "Loss_Share_Pct" >= 5 THEN 'Critical' WHEN "Loss_Share_Pct" >= 1 THEN 'High' ELSE 'Moderate' END AS "Severity"
FROM (
  SELECT t.*, {share} AS "Loss_Share_Pct" FROM
    (SELECT * FROM loss ORDER BY "Total_Loss" ASC NULLS FIRST, "Category", "Sub-Category", "Product Name" LIMIT 20) t,
    (SELECT {money_sum('"Total_Loss"')} AS tot FROM loss) g
)""", marts_needed=("loss",))


def _filtered_kpis() -> str:
    from ledgerlake.registry import FILTER_REGIONS, FILTER_YEARS

    yrs = ", ".join(str(y) for y in FILTER_YEARS)
    regs = ", ".join(lit(r) for r in FILTER_REGIONS)
    f = f"fsilver AS (SELECT * FROM silver WHERE \"Order_Year\" IN ({yrs}) AND \"Region\" IN ({regs}))"
    return build(on_source(KPIS, "fsilver"), f)


HOT_RAW = """hotraw AS (SELECT * REPLACE (CASE WHEN "Order ID" % 3 = 0 THEN 1 ELSE "Order ID" END AS "Order ID") FROM raw)"""


def _hot_order_kpis() -> str:
    return build(on_source(KPIS, "hsilver"), HOT_RAW, bronze_select("hotraw", "ret_d", "hbronze"), silver_chain("hbronze", "h"))


def _filtered(select: str) -> str:
    from ledgerlake.registry import FILTER_CATEGORIES, FILTER_REGIONS, FILTER_YEARS

    inside = lambda c, values: f"{q(c)} IN ({', '.join(lit(v) for v in values)})"
    f = f"fsilver AS (SELECT * FROM silver WHERE {inside('Order_Year', FILTER_YEARS)} AND {inside('Region', FILTER_REGIONS)} AND {inside('Category', FILTER_CATEGORIES)})"
    return build(on_source(select, "fsilver"), f)


MART_CTE_NAMES = {"sales_trend": "trend", "category_performance": "category", "regional_performance": "regional",
                  "loss_making_products": "loss", "discount_impact": "discount", "executive_kpis": "kpis"}


def _ordered_marts() -> str:
    from ledgerlake.plans.marts import MART_ORDER
    from ledgerlake.registry import MART_LABELS

    parts = []
    for name, (a, b, value) in MART_LABELS.items():
        lead = ", ".join(f"{q(c)} {'DESC NULLS LAST' if down else 'ASC NULLS FIRST'}" for c, down in MART_ORDER[name])
        ties = {"sales_trend": "Order_Quarter", "category_performance": '"Category", "Sub-Category"',
                "regional_performance": '"Region", "State", "Salesperson", "Target_Sales"',
                "loss_making_products": '"Category", "Sub-Category", "Product Name"', "discount_impact": "1", "executive_kpis": "1"}[name]
        parts.append(f"""SELECT {lit(name)} AS "mart", row_number() OVER (ORDER BY {lead}, {ties}) AS "position",
  CAST({q(a)} AS VARCHAR) AS "label", CAST({q(b)} AS VARCHAR) AS "label2", {q(value)} AS "value" FROM {MART_CTE_NAMES[name]}""")
    return build("\nUNION ALL\n".join(parts), marts_needed=tuple(MART_CTES))


def _land_csv() -> str:
    return """SELECT c_custkey, c_name || ' Céleste' AS c_label, CASE WHEN c_nationkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN c_nationkey % 2 = 1 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS "encoding", 'Region' AS missing,
  (SELECT COUNT(*) FROM customer) AS landed_rows FROM customer"""


def _split_reps() -> str:
    return build("""SELECT p."Region", p."Salesperson", p."Target_Sales", lower(replace(p."Salesperson", ' ', '.')) || '@example.com' AS "Email", n AS "rows"
FROM reps p LEFT JOIN (SELECT "Region", COUNT(*) AS n FROM clean_sales GROUP BY 1) s ON p."Region" = s."Region" """)


def _multipliers_values() -> str:
    from ledgerlake.config import YEAR_MULTIPLIERS

    rows = ", ".join(f"({y}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))"
                     for y, (a, b, c) in YEAR_MULTIPLIERS.items())
    return f"mult AS (SELECT * FROM (VALUES {rows}) AS t(mult_year, m_sales, m_profit, m_qty))"


def _count_distinct_keys(cols: list[str]) -> str:
    return "COUNT(DISTINCT struct_pack(" + ", ".join(f"k{i} := {q(c)}" for i, c in enumerate(cols)) + "))"


def _dedup_report(src: str, key: list[str]) -> str:
    return build(f"""SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
  {sround('(rows_before - rows_after) / NULLIF(rows_before, 0) * 100', 2)} AS removed_pct
FROM (SELECT COUNT(*) AS rows_before, {_count_distinct_keys(key)} AS rows_after FROM {src})""")


def _null_profile(src: str, cols: list[str], max_null_pct: float = 5.0) -> str:
    parts = [f"SELECT {lit(c)} AS \"column\", COUNT(*) FILTER (WHERE {q(c)} IS NULL) AS null_count, COUNT(*) AS total FROM {src}"
             for c in cols]
    pct = sround("null_count / NULLIF(total, 0) * 100", 2)
    return build(f"SELECT \"column\", null_count, {pct} AS null_pct, {pct} > {max_null_pct} AS over_limit FROM (\n"
                 + "\nUNION ALL\n".join(parts) + ")", text=True)


def _distinct_std(src: str, cols: list[str]) -> str:
    parts = [f"SELECT {lit(c)} AS \"column\", COUNT(DISTINCT {q(c)}) AS distinct_before, "
             f"COUNT(DISTINCT {title(q(c))}) AS distinct_after FROM {src}" for c in cols]
    return build("\nUNION ALL\n".join(parts), text=True)


def _mode_year(src: str, date_col: str = '"Order Date"') -> str:
    return (f"(SELECT y FROM (SELECT CAST(year({date_col}) AS INTEGER) AS y, COUNT(*) AS c FROM {src} GROUP BY 1) "
            f"ORDER BY c DESC, y ASC LIMIT 1)")


def _bround(expr: str, n: int) -> str:
    return f"CAST(round_even(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _global_profile(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts += [f"MIN({q(c)}) AS \"min_{c}\"", f"MAX({q(c)}) AS \"max_{c}\"", f"{exact_avg(q(c))} AS \"avg_{c}\"",
                  f"COUNT({q(c)}) AS \"count_{c}\""]
    return build("SELECT " + ", ".join(parts) + " FROM silver")


def _conditional_counts(flags: list[str]) -> str:
    parts = []
    for f in flags:
        parts += [f"CAST(SUM(CAST({q(f)} AS INTEGER)) AS BIGINT) AS \"{f}_sum\"",
                  f"COUNT(*) FILTER (WHERE {q(f)}) AS \"{f}_count_if\"",
                  f"CAST(SUM(CASE WHEN {q(f)} = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS \"{f}_case_sum\""]
    return build("SELECT \"Order_Year\", " + ", ".join(parts) + " FROM silver GROUP BY \"Order_Year\"")


def _row_ids() -> str:
    others = [c for c in RAW_COLS if c not in ("Order ID", "Source_Year")]
    order = ", ".join(['"Order ID" ASC NULLS FIRST'] + [f"{q(c)} ASC NULLS FIRST" for c in others])
    return build(f"""SELECT *, CAST("Source_Year" - 1994 AS BIGINT) * 1000000000000
  + row_number() OVER (PARTITION BY "Source_Year" ORDER BY {order}) AS "Row ID" FROM clean_sales""")


def _seeded(seed: int, buckets: int, *more: str) -> str:
    """The bucket of a row (mirrors functions.hashing.hash_bucket over the default key)."""
    parts = ", ".join([lit(str(seed))] + [f"CAST({c} AS VARCHAR)" for c in ('"Order ID"', '"Product ID"', *more)])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT) % {buckets})"


def _inject_defects(seed: int = 2019) -> str:
    share = lambda fraction: int(round(fraction * 10000))
    changes = [
        f'CASE WHEN {_seeded(seed, 10000)} < {share(INJECT_NULL_PCT)} THEN NULL ELSE {q(c)} END AS {q(c)}' for c in ("Ship Mode", "Customer Name")
    ] + [
        f'CASE WHEN {_seeded(seed + 1, 10000, "_copy")} < {share(INJECT_CASE_PCT)} THEN upper("Region") ELSE "Region" END AS "Region"',
        f'CASE WHEN {_seeded(seed + 2, 10000, "_copy")} < {share(INJECT_DISCOUNT_PCT)} THEN "Discount" * 10 ELSE "Discount" END AS "Discount"',
    ]
    return build(f"""SELECT * EXCLUDE (_copy) REPLACE ({", ".join(changes)}) FROM (
  SELECT *, 0 AS _copy FROM clean_sales
  UNION ALL SELECT *, 1 AS _copy FROM clean_sales WHERE {_seeded(seed, 10000)} < {share(INJECT_DUPLICATE_PCT)})""")


def _returns_sample() -> str:
    label = f'{_reasons_array()}[{_seeded(RANDOM_SEED + 1, len(RETURN_REASONS))} + 1]'
    return build(f"""SELECT "Order ID", {label} AS "Return Reason" FROM clean_sales
WHERE {_seeded(RANDOM_SEED, 10000)} < {int(round(RETURN_SAMPLE_PCT * 10000))}""")


def _shift_years() -> str:
    m = _mode_year("clean_sales")
    return build(f"""SELECT {KEYS},
  CAST("Order Date" + to_months(CAST((2019 - {m}) * 12 AS INTEGER)) AS DATE) AS "Order Date",
  CAST("Ship Date" + to_months(CAST((2019 - {m}) * 12 AS INTEGER)) AS DATE) AS "Ship Date"
FROM clean_sales""")


def _scale_years() -> str:
    return build(f"""SELECT r."Order ID", r."Product ID", r."Source_Year",
  {_bround('r."Sales" * coalesce(m.m_sales, 1.0)', 2)} AS "Sales",
  {_bround('r."Profit" * coalesce(m.m_profit, 1.0)', 2)} AS "Profit",
  CAST({_bround('CAST(r."Quantity" AS DOUBLE) * coalesce(m.m_qty, 1.0)', 0)} AS INTEGER) AS "Quantity",
  r.mult_year_key
FROM (SELECT *, "Source_Year" + 24 AS mult_year_key FROM clean_sales) r LEFT JOIN mult m ON r.mult_year_key = m.mult_year""",
                 _multipliers_values())


def _expand_years() -> str:
    m = _mode_year("clean_sales")
    return build(f"""SELECT r."Order ID", r."Product ID",
  CAST(r."Order Date" + to_months(CAST((y.y - {m}) * 12 AS INTEGER)) AS DATE) AS "Order Date",
  CAST(r."Ship Date" + to_months(CAST((y.y - {m}) * 12 AS INTEGER)) AS DATE) AS "Ship Date",
  y.y AS "Source_Year", 'sales_' || CAST(y.y AS VARCHAR) AS "Source_File"
FROM clean_sales r, (VALUES (2019), (2020), (2021), (2022), (2023)) AS y(y)""")


def _hash60(*parts: str) -> str:
    text = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '\\N')" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)"


def _exact_sample(fraction: float = 0.10) -> str:
    every = [f'CAST({q(c)} AS VARCHAR)' for c in RAW_COLS]
    order = f"{_hash60(lit('42'), *KEYS.split(', '))}, {_hash60(lit('43'), *every)}"
    return build(f"""SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS _rn FROM clean_sales)
WHERE _rn <= (SELECT round_even({fraction} * COUNT(*), 0) FROM clean_sales)""")


def _generate_years() -> str:
    base_cols = [c for c in RAW_COLS if c not in ("Source_Year", "Source_File")]
    order = ", ".join(f"{q(c)} ASC NULLS FIRST" for c in ["Order ID", *[c for c in base_cols if c != "Order ID"]])
    m = _mode_year("clean_sales")
    hit = lambda kind, *more: f"row_number() OVER (PARTITION BY y ORDER BY {_hash60(lit(kind), 'y', '_seq', *more)})"
    shifted = lambda c: f"CAST({q(c)} + to_months(CAST((y - {m}) * 12 AS INTEGER)) AS DATE)"
    upper = 'CASE WHEN _case <= round_even(0.03 * (n + _twice), 0) THEN upper("Region") ELSE "Region" END'
    discount = 'CASE WHEN _disc <= round_even(0.01 * (n + _twice), 0) THEN "Discount" * 10 ELSE "Discount" END'
    return build(f"""SELECT y AS "Source_Year", COUNT(*) AS "rows", COUNT(DISTINCT id) AS "ids", MIN(id) AS first_id, MAX(id) AS last_id,
  MIN("Order Date") AS first_date, MAX("Ship Date") AS last_ship_date,
  COUNT(*) FILTER (WHERE _null <= round_even(0.02 * n, 0)) AS null_ship_modes,
  COUNT(*) FILTER (WHERE _null <= round_even(0.02 * n, 0)) AS null_customers,
  COUNT(*) FILTER (WHERE "Region" = upper("Region")) AS upper_regions, COUNT(*) FILTER (WHERE "Discount" > 0.1) AS large_discounts,
  {money_sum('"Sales"')} AS sales, {money_sum('"Profit"')} AS profit, {money_sum('"Discount"')} AS discounts,
  CAST(SUM("Quantity") AS BIGINT) AS quantity, CAST(SUM(id) FILTER (WHERE "Region" = upper("Region")) AS BIGINT) AS upper_region_ids
FROM (
  SELECT y, n, _null, (y - 2018)::BIGINT * greatest(10000, CAST(pow(10, length(CAST(n AS VARCHAR))) AS BIGINT)) + _seq AS id,
    {shifted("Order Date")} AS "Order Date", {shifted("Ship Date")} AS "Ship Date", {upper} AS "Region", {discount} AS "Discount",
    {_bround('"Sales" * m_sales', 2)} AS "Sales", {_bround('"Profit" * m_profit', 2)} AS "Profit",
    CAST({_bround('CAST("Quantity" AS DOUBLE) * m_qty', 0)} AS INTEGER) AS "Quantity"
  FROM (
    SELECT *, {hit("case", "_copy")} AS _case, {hit("discount", "_copy")} AS _disc FROM (
      SELECT *, unnest(CASE WHEN _double <= _twice THEN [0, 1] ELSE [0] END) AS _copy FROM (
        SELECT *, {hit("null")} AS _null, {hit("copy")} AS _double, greatest(1, CAST(floor(n * 0.01) AS BIGINT)) AS _twice
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS _seq, COUNT(*) OVER () AS n FROM clean_sales),
          (SELECT mult_year AS y, m_sales, m_profit, m_qty FROM mult)
      )
    )
  )
) GROUP BY y""", _multipliers_values())


def _scalar_text() -> str:
    return build(f"""SELECT {KEYS}, upper("Region") AS region_upper, lower("Category") AS category_lower,
  {initcap('"Product Name"')} AS product_title, concat_ws('|', "Region", "State", "Segment") AS geo_key,
  CAST(length("Product Name") AS INTEGER) AS name_length,
  regexp_extract("Source_File", 'sales_(\\d{{4}})', 1) AS file_year FROM silver""")


def _scalar_date() -> str:
    return build(f"""SELECT {KEYS}, strftime("Order Date", '%m/%d/%Y') AS order_text,
  CAST("Order Date" + INTERVAL 12 MONTH AS DATE) AS next_year_date,
  CAST("Ship Date" - "Order Date" AS INTEGER) AS raw_days,
  CAST(dayofweek("Order Date") + 1 AS INTEGER) AS weekday,
  last_day("Order Date") AS month_end FROM silver""")


def _scalar_math() -> str:
    return build(f"""SELECT {KEYS}, {sround('"Sales" * CAST(1.005 AS DOUBLE)', 2)} AS sales_up_half_up,
  {_bround('"Sales" * CAST(1.005 AS DOUBLE)', 2)} AS sales_up_half_even,
  abs("Profit") AS abs_profit, greatest("Profit", 0.0) AS profit_floor,
  least("Discount", CAST(0.05 AS DOUBLE)) AS discount_cap,
  "Profit" / NULLIF("Quantity" - "Quantity", 0) AS div_by_zero FROM silver""")


def _verify_tables() -> str:
    written = {"sales_trend": "trend", "discount_impact": "discount", "executive_kpis": "kpis"}
    from ledgerlake.config import MART_NAMES

    parts = []
    for name in MART_NAMES:
        if name in written:
            parts.append(f"SELECT {lit(name)} AS \"table\", TRUE AS \"exists\", (SELECT COUNT(*) FROM {written[name]}) AS \"rows\"")
        else:
            parts.append(f"SELECT {lit(name)} AS \"table\", FALSE AS \"exists\", CAST(NULL AS BIGINT) AS \"rows\"")
    return build("\nUNION ALL\n".join(parts), marts_needed=("trend", "discount", "kpis"))


# --- quality suite measures -------------------------------------------------------

def _dq_base() -> list[str]:
    """Measure CTE over bronze / silver / marts (mirrors plans.quality)."""
    from ledgerlake.config import DUPLICATE_CHECK_KEY

    dec = "DECIMAL(24,6)"
    nulls = ", ".join(f"COUNT(*) FILTER (WHERE {q(c)} IS NULL) AS null_{i}" for i, c in enumerate(MANDATORY_COLS))
    exp_margin = f"CASE WHEN \"Sales\" != 0 THEN {sround('\"Profit\" / \"Sales\" * 100', 2)} ELSE 0.0 END"
    exp_amt = sround('"Sales" * "Discount"', 2)
    return [f"""sm AS (
  SELECT COUNT(*) AS silver_rows,
    CAST(SUM(CAST("Sales" AS {dec})) AS DOUBLE) AS silver_sales,
    CAST(SUM(CAST("Profit" AS {dec})) AS DOUBLE) AS silver_profit,
    COUNT(*) FILTER (WHERE "Sales" <= 0) AS invalid_sales,
    {nulls},
    {_count_distinct_keys(DUPLICATE_CHECK_KEY)} AS unique_keys,
    COUNT(*) FILTER (WHERE "Order Date" IS NULL) AS bad_date_0,
    COUNT(*) FILTER (WHERE "Ship Date" IS NULL) AS bad_date_1,
    COUNT(*) FILTER (WHERE "Quantity" <= 0) AS invalid_qty,
    COUNT(*) FILTER (WHERE "Region" != {initcap('"Region"')}) AS bad_case,
    COUNT(*) FILTER (WHERE "Discount" < 0 OR "Discount" > 1) AS bad_discount,
    COUNT(*) FILTER (WHERE abs("Profit_Margin_Pct" - ({exp_margin})) > 0.01) AS margin_errors,
    COUNT(*) FILTER (WHERE abs("Discount_Amount" - ({exp_amt})) > 0.01) AS discount_errors,
    COUNT(*) FILTER (WHERE ("Profit" < 0 AND "Is_Loss" = FALSE) OR ("Profit" >= 0 AND "Is_Loss" = TRUE)) AS loss_flag_errors,
    COUNT(*) FILTER (WHERE "Shipping_Days" < 0) AS negative_shipping
  FROM silver
)""", f"""bm AS (
  SELECT COUNT(*) AS bronze_rows, CAST(SUM(CAST("Sales" AS {dec})) AS DOUBLE) AS bronze_sales,
    CAST(SUM(CAST("Profit" AS {dec})) AS DOUBLE) AS bronze_profit FROM bronze
)"""]


def _text(pattern: str, *values: str) -> str:
    """Report text: values put into a pattern of '{:,}' (thousands), '{:,.2f}' (money) and '{:.2f}' (percent) fields."""
    return f"format({', '.join([lit(pattern), *values])})" if values else lit(pattern)


def _check(name: str, status: str, measure: str, actual: str) -> str:
    return f"SELECT {lit(name)} AS check_name, {status} AS status, CAST({measure} AS DOUBLE) AS measure, {actual} AS actual FROM bm, sm"


def _pf(cond: str, bad: str = "FAIL") -> str:
    return f"CASE WHEN {cond} THEN 'PASS' ELSE '{bad}' END"


def _dq1() -> str:
    from ledgerlake.config import Thresholds

    th = Thresholds()
    ret = "(CASE WHEN bronze_rows > 0 THEN silver_rows / bronze_rows * 100 ELSE 0.0 END)"
    dup = "(CASE WHEN silver_rows > 0 THEN (silver_rows - unique_keys) / silver_rows * 100 ELSE 0.0 END)"
    rows = [
        _check("Row Retention Bronze→Silver", _pf(f"{ret} >= {th.min_retention_pct}"), ret,
               _text("{:.2f}% ({:,}/{:,} rows)", f"CAST({ret} AS DOUBLE)", "silver_rows", "bronze_rows")),
        _check("Mandatory Columns Present", "'PASS'", "0.0", "'All present'"),
    ]
    rows += [_check(f"Null Check: {c}", _pf(f"null_{i} = 0"), f"null_{i}", _text("{:,} nulls", f"null_{i}")) for i, c in enumerate(MANDATORY_COLS)]
    rows.append(_check("Duplicate Rate After Cleaning", _pf(f"{dup} <= {th.max_duplicate_pct}"), dup,
                       _text("{:.2f}% ({:,} rows)", f"CAST({dup} AS DOUBLE)", "(silver_rows - unique_keys)")))
    for i, c in enumerate(["Order Date", "Ship Date"]):
        rows.append(_check(f"Date Validity: {c}", _pf(f"bad_date_{i} = 0", "WARN"), f"bad_date_{i}", _text("{:,} unparseable dates", f"bad_date_{i}")))
    for key, name, unit in [("invalid_sales", "Sales > 0", "invalid sales"), ("invalid_qty", "Quantity > 0", "invalid quantities"),
                            ("bad_case", "Region Title Case", "inconsistent values"), ("bad_discount", "Discount Range [0, 1]", "invalid discounts")]:
        rows.append(_check(name, _pf(f"{key} = 0"), key, _text("{:,} " + unit, key)))
    return "\nUNION ALL\n".join(rows)


def _dq2() -> str:
    from ledgerlake.config import Thresholds
    from ledgerlake.registry import FIXTURE_COVERAGE

    th = Thresholds()
    rows = []
    for what, b, s_ in [("Sales", "bronze_sales", "silver_sales"), ("Profit", "bronze_profit", "silver_profit")]:
        bb, ss = f"coalesce({b}, 0.0)", f"coalesce({s_}, 0.0)"
        var = f"(CASE WHEN {bb} != 0 THEN abs({ss} - {bb}) / abs({bb}) * 100 ELSE 0.0 END)"
        rows.append(_check(f"{what} Total Reconciliation", _pf(f"{var} <= {th.max_variance_pct}"), var,
                           _text("Bronze=${:,.2f} | Silver=${:,.2f} | Variance={:.2f}%", bb, ss, f"CAST({var} AS DOUBLE)")))
    for key, name, unit in [("margin_errors", "Profit Margin Calculation", "calculation errors"), ("discount_errors", "Discount Amount Calculation", "calculation errors"),
                            ("loss_flag_errors", "Is_Loss Flag Accuracy", "incorrect flags"), ("negative_shipping", "Shipping Days >= 0", "negative values")]:
        rows.append(_check(name, _pf(f"{key} = 0"), key, _text("{:,} " + unit, key)))
    first = FIXTURE_COVERAGE.years[0]
    later = len(FIXTURE_COVERAGE.years) - 1
    yoy = (f"(SELECT COUNT(*) FILTER (WHERE \"Order_Year\" = {first} AND \"YoY_Sales_Growth_Pct\" IS NULL) AS f, "
           f"COUNT(*) FILTER (WHERE \"Order_Year\" > {first} AND \"YoY_Sales_Growth_Pct\" IS NOT NULL) AS v FROM kpis) y")
    rows.append(f"SELECT 'YoY Growth Calculation' AS check_name, {_pf(f'y.f = 1 AND y.v = {later}', 'WARN')} AS status, "
                f"CAST(y.v AS DOUBLE) AS measure, '{first} null=' || CASE WHEN y.f = 1 THEN 'True' ELSE 'False' END || ' | valid=' || y.v || '/{later}' AS actual FROM {yoy}")
    rows.append(_check("All 7 Derived Columns Present", "'PASS'", "0.0", "'All present'"))
    return "\nUNION ALL\n".join(rows)


def _dq3() -> str:
    from ledgerlake.config import MART_NAMES, Thresholds
    from ledgerlake.registry import FIXTURE_COVERAGE as cov

    th = Thresholds()
    rel = {"sales_trend": "trend", "category_performance": "category", "regional_performance": "regional",
           "loss_making_products": "loss", "discount_impact": "discount", "executive_kpis": "kpis"}
    rows = []
    for name in MART_NAMES:
        rows.append(f"SELECT {lit('Gold Table: ' + name)} AS check_name, {_pf('n > 0')} AS status, "
                    f"CAST(n AS DOUBLE) AS measure, {_text('{:,} rows', 'n')} AS actual FROM (SELECT COUNT(*) AS n FROM {rel[name]})")

    def coverage(name, values, mart, column, bad="FAIL"):
        vals = ", ".join(f"({i}, {lit(v)})" for i, v in enumerate(values))
        miss = (f"(SELECT COUNT(*) AS n, string_agg(CAST(v AS VARCHAR), ', ' ORDER BY i) AS names FROM (VALUES {vals}) AS e(i, v) WHERE NOT EXISTS "
                f"(SELECT 1 FROM {mart} m WHERE m.{q(column)} = e.v))")
        rows.append(f"SELECT {lit(name)} AS check_name, {_pf('n = 0', bad)} AS status, CAST(n AS DOUBLE) AS measure, "
                    f"'Found ' || ({len(values)} - n) || '/{len(values)} expected | Missing: ' || coalesce(names, 'None') AS actual FROM {miss}")

    coverage("Sales Trend Years Coverage", cov.years, "trend", "Order_Year")
    coverage(f"All {len(cov.regions)} Regions Present", cov.regions, "regional", "Region")
    coverage(f"All {len(cov.categories)} Categories Present", cov.categories, "category", "Category")
    rows.append("SELECT 'Loss Products Have Negative Profit' AS check_name, " + _pf("n = 0") +
                f" AS status, CAST(n AS DOUBLE) AS measure, {_text('{:,} products | {:,} invalid', 'r', 'n')} AS actual "
                "FROM (SELECT COUNT(*) FILTER (WHERE \"Total_Loss\" >= 0) AS n, COUNT(*) AS r FROM loss)")
    coverage("Discount Buckets Complete", cov.buckets, "discount", "Discount_Bucket", "WARN")
    coverage(f"KPIs Cover All {len(cov.years)} Years", cov.years, "kpis", "Order_Year")
    ss, gg = "coalesce(sm.silver_sales, 0.0)", "coalesce(g.gold_sales, 0.0)"
    var = f"(CASE WHEN {ss} != 0 THEN abs({gg} - {ss}) / abs({ss}) * 100 ELSE 0.0 END)"
    rows.append(f"SELECT 'Gold vs Silver Sales Match' AS check_name, {_pf(f'{var} <= {th.max_variance_pct}')} AS status, "
                f"CAST({var} AS DOUBLE) AS measure, {_text('Silver=${:,.2f} | Gold=${:,.2f} | Variance={:.2f}%', ss, gg, f'CAST({var} AS DOUBLE)')} AS actual FROM sm, "
                f"(SELECT CAST(SUM(CAST(\"Total_Sales\" AS DECIMAL(24,6))) AS DOUBLE) AS gold_sales FROM kpis) g")
    return "\nUNION ALL\n".join(rows)


ALL_MARTS = ("trend", "category", "regional", "loss", "discount", "kpis")


def _report(validation_time: str) -> str:
    """The whole report, texts included."""
    from ledgerlake.plans.quality import check_specs
    from ledgerlake.registry import FIXTURE_COVERAGE

    specs = ", ".join(f"({lit(cat)}, {lit(name)}, {lit(layer)}, {lit(exp)})"
                      for cat, name, layer, exp in check_specs(cov=FIXTURE_COVERAGE))
    body = f"({_dq1()})\nUNION ALL\n({_dq2()})\nUNION ALL\n({_dq3()})"
    return build(f"""SELECT s.category, d.check_name, d.status, s.expected, d.actual, s.layer, {lit(validation_time)} AS validation_time
FROM ({body}) d JOIN (VALUES {specs}) AS s(category, check_name, layer, expected) ON d.check_name = s.check_name""",
                 *_dq_base(), marts_needed=ALL_MARTS)


def _dq_rows(body: str) -> str:
    return f"SELECT check_name, status, measure FROM (\n{body}\n)"


def _ordered_report() -> str:
    from ledgerlake.plans.quality import check_specs
    from ledgerlake.registry import FIXTURE_COVERAGE

    specs = ", ".join(f"({lit(cat)}, {lit(name)}, {lit(layer)}, {lit(exp)})"
                      for cat, name, layer, exp in check_specs(cov=FIXTURE_COVERAGE))
    body = f"({_dq1()})\nUNION ALL\n({_dq2()})\nUNION ALL\n({_dq3()})"
    return build(f"""SELECT s.category, d.check_name, d.status, s.expected, s.layer
FROM ({body}) d JOIN (VALUES {specs}) AS s(category, check_name, layer, expected) ON d.check_name = s.check_name""",
                 *_dq_base(), marts_needed=ALL_MARTS)


def oracle_queries() -> dict[str, str]:
    from ledgerlake.registry import EXPECTED_REGIONS_WIDE, VALIDATION_TIME

    on_silver = {
        "sales_trend": SALES_TREND,
        "category_performance": CATEGORY,
        "regional_performance": REGIONAL,
        "loss_making_products": LOSS_PRODUCTS,
        "discount_impact": DISCOUNT,
        "executive_kpis": KPIS,
        "total_loss": TOTAL_LOSS,
        "silver_by_year": SILVER_BY_YEAR,
        "silver_by_category": SILVER_BY_CATEGORY,
        "silver_by_region": SILVER_BY_REGION,
        "derived_sanity": DERIVED_SANITY,
        "inline_stats": INLINE_STATS,
    }
    out = {k: with_silver(v) for k, v in on_silver.items()}
    text_cols = [c for c in ["Region", "Category", "Sub-Category", "Segment", "Ship Mode", "State", "City", "Country"]
                 if c in RAW_COLS]
    not_null = " AND ".join(f"{q(c)} IS NOT NULL" for c in MANDATORY_COLS)
    exp_regions = ", ".join(f"({lit(r)})" for r in EXPECTED_REGIONS_WIDE)
    out.update({
        "kpi_cards": _kpi_cards(),
        "monthly_series": build("""SELECT "Order_Year", "Order_Month", printf('%04d-%02d', "Order_Year", "Order_Month") AS "Period",
  "Total_Sales", "Total_Profit", "Profit_Margin_Pct" FROM trend""", marts_needed=("trend",)),
        "category_bars": build("""SELECT "Category", "Sub-Category", "Total_Sales", "Total_Profit", "Profit_Margin_Pct",
  "Sales_Rank" FROM category""", marts_needed=("category",)),
        "region_target_status": _region_target(),
        "salesperson_performance": _salesperson(),
        "discount_margin": build("""SELECT "Discount_Bucket", "Total_Sales", "Profit_Margin_Pct", "Loss_Rate_Pct" FROM discount""",
                                 marts_needed=("discount",)),
        "top_loss_severity": _top_loss(),
        "filtered_kpis": _filtered_kpis(),
        **{f"filtered_{k}": _filtered(MART_CTES[v]) for k, v in MART_CTE_NAMES.items()},
        "land_csv": _land_csv(),
        "ordered_marts": _ordered_marts(),
        "split_reps": _split_reps(),
        "preview": build("""SELECT "Order ID", "Product ID", "Sales" FROM clean_sales
ORDER BY "Sales" DESC, "Order ID", "Product ID", "Quantity" LIMIT 5"""),
        "derived_columns": build(f"""SELECT {KEYS}, "Profit_Margin_Pct", "Discount_Amount", "Is_Loss", "Order_Year",
  "Order_Month", "Order_Quarter", "Shipping_Days" FROM silver"""),
        "discount_buckets": build(f"""SELECT {KEYS}, "Discount", {bucket('"Discount"')} AS "Discount_Bucket" FROM silver"""),
        "returned_enrichment": build(f"""SELECT {KEYS}, "Is_Returned", "Return Reason" FROM bronze"""),
        "join_returns_left": build(f"""SELECT coalesce(d."Is_Returned", FALSE) AS "Is_Returned",
  coalesce(d."Return Reason", {lit(NOT_RETURNED)}) AS "Return Reason", COUNT(*) AS "rows"
FROM raw r LEFT JOIN ret_d d ON r."Order ID" = d."Order ID" GROUP BY 1, 2"""),
        "join_returns_hot": build(f"""SELECT r."Order ID" = 1 AS "hot", coalesce(d."Is_Returned", FALSE) AS "Is_Returned",
  coalesce(d."Return Reason", {lit(NOT_RETURNED)}) AS "Return Reason", COUNT(*) AS "rows",
  COUNT(*) FILTER (WHERE r."Order ID" = 1) AS "kept_in_place"
FROM hotraw r LEFT JOIN ret_d d ON r."Order ID" = d."Order ID" GROUP BY 1, 2, 3""", HOT_RAW),
        "hot_order_kpis": _hot_order_kpis(),
        "join_rep_broadcast": build("""SELECT r."Region", p."Salesperson", p."Target_Sales", COUNT(*) AS "rows"
FROM raw r LEFT JOIN reps p ON r."Region" = p."Region" GROUP BY 1, 2, 3"""),
        "unmatched_regions": build("""SELECT COUNT(*) FILTER (WHERE "Salesperson" IS NULL) AS unmatched_rows FROM bronze"""),
        "row_inflation_guard": build("""SELECT rows_before, rows_after, rows_after != rows_before AS inflated
FROM (SELECT (SELECT COUNT(*) FROM raw) AS rows_before, (SELECT COUNT(*) FROM bronze) AS rows_after)"""),
        "year_multiplier_lookup": build(f"""SELECT y."Order_Year", y."Total_Sales", coalesce(m.m_sales, 1.0) AS m_sales
FROM (SELECT "Order_Year", {money_sum('"Sales"')} AS "Total_Sales", "Order_Year" + 24 AS mult_year FROM silver
      GROUP BY "Order_Year") y LEFT JOIN mult m ON y.mult_year = m.mult_year""", _multipliers_values()),
        "dedup_deterministic": build("""SELECT * EXCLUDE ("_ingestion_timestamp", "_batch_id", "_source_layer") FROM dedup"""),
        "dedup_report": _dedup_report("bronze", ["Order ID", "Product ID", "Source_Year"]),
        "duplicate_rate": _dedup_report("silver", ["Order ID", "Product ID", "Order_Year"]),
        "distinct_values": build("""SELECT DISTINCT "Region" FROM bronze"""),
        "returns_dedup": build("""SELECT "Order ID", min("Return Reason") AS "Return Reason", TRUE AS "Is_Returned" FROM ret GROUP BY 1"""),
        "drop_mandatory_nulls": build(f"SELECT * FROM rawtext WHERE {not_null}", text=True),
        "fill_defaults": build(f"""SELECT {KEYS}, coalesce("Ship Mode", 'Standard Class') AS "Ship Mode",
  coalesce("Customer Name", 'Unknown Customer') AS "Customer Name", coalesce("Salesperson", 'Unassigned') AS "Salesperson",
  coalesce("Return Reason", 'Not Returned') AS "Return Reason", coalesce("Target_Sales", 0) AS "Target_Sales" FROM tbronze""",
                               text=True),
        "case_null_default": build("""SELECT "Is_Returned", "Return Reason", COUNT(*) AS "rows" FROM bronze GROUP BY 1, 2"""),
        "title_case": build(f"SELECT {KEYS}, " + ", ".join(f"{title(q(c))} AS {q(c)}" for c in text_cols) + " FROM rawtext",
                            text=True),
        "parse_dates": build(f"""SELECT {KEYS}, CAST(try_strptime("Order Date", '%m/%d/%Y') AS DATE) AS "Order Date",
  CAST(try_strptime("Ship Date", '%m/%d/%Y') AS DATE) AS "Ship Date" FROM rawtext""", text=True),
        "unparseable_dates": build("""SELECT COUNT(*) FILTER (WHERE try_strptime("Order Date", '%m/%d/%Y') IS NULL) AS bad_order_dates,
  COUNT(*) FILTER (WHERE try_strptime("Ship Date", '%m/%d/%Y') IS NULL) AS bad_ship_dates FROM rawtext""", text=True),
        "coerce_types": build(f"""SELECT {KEYS}, try_cast("Sales" AS DOUBLE) AS "Sales", try_cast("Profit" AS DOUBLE) AS "Profit",
  try_cast("Discount" AS DOUBLE) AS "Discount", try_cast("Quantity" AS INTEGER) AS "Quantity" FROM rawtext""", text=True),
        "non_finite_sales": build(f"""SELECT "Source_Year", COUNT(*) AS "rows", COUNT(*) - COUNT(v) AS lost_sales,
  {money_sum('v')} AS "Total_Sales", {sround(exact_avg('v'), 2)} AS "Avg_Sales"
FROM (SELECT "Source_Year", CASE WHEN "Order ID" % 11 >= 4 THEN "Sales" END AS v FROM raw) GROUP BY 1"""),
        "clamp_discount": build(f"""SELECT {KEYS}, least(greatest(try_cast("Discount" AS DOUBLE), 0.0), 1.0) AS "Discount"
FROM rawtext""", text=True),
        "null_profile": _null_profile("rawtext", RAW_COLS),
        "null_recheck": _null_profile("ttyped", BRONZE_DATA_COLS),
        "remove_invalid_sales": build(f"""SELECT {KEYS}, try_cast("Sales" AS DOUBLE) AS "Sales" FROM rawtext
WHERE try_cast("Sales" AS DOUBLE) > 0""", text=True),
        "distinct_standardization": _distinct_std("rawtext", text_cols),
        "text_pipeline_kpis": build(on_source(KPIS, "tsilver"), text=True),
        "csv_pipeline_kpis": build(on_source(KPIS, "csilver"), csv=True),
        "filter_null": build(f"""SELECT {KEYS}, "Ship Mode" FROM raw WHERE "Ship Mode" IS NULL"""),
        "filter_flag": build(f"""SELECT {KEYS}, "Profit" FROM silver WHERE "Is_Loss" """),
        "filter_threshold": build(f"""SELECT {KEYS}, "Discount" FROM raw WHERE "Discount" >= 0.5"""),
        "filter_range_or": build(f"""SELECT {KEYS}, "Discount" FROM raw WHERE "Discount" < 0.0 OR "Discount" > 0.5"""),
        "filter_consistency": build(f"""SELECT {KEYS} FROM (SELECT * REPLACE ("Is_Loss" != ("Order ID" % 37 = 0) AS "Is_Loss") FROM silver)
WHERE ("Profit" < 0 AND "Is_Loss" = FALSE) OR ("Profit" >= 0 AND "Is_Loss" = TRUE)"""),
        "filter_year_null_state": build("""SELECT "Order_Year" FROM (
  SELECT * REPLACE (CASE WHEN "Order_Year" % 2 = 1 THEN "YoY_Sales_Growth_Pct" END AS "YoY_Sales_Growth_Pct") FROM kpis)
WHERE ("Order_Year" = 1995 AND "YoY_Sales_Growth_Pct" IS NOT NULL)
  OR ("Order_Year" > 1995 AND "YoY_Sales_Growth_Pct" IS NULL)""", marts_needed=("kpis",)),
        "filter_casing": build(f"""SELECT {KEYS}, "Region" FROM bronze WHERE "Region" != {initcap('"Region"')}"""),
        "filter_tolerance": build(f"""SELECT {KEYS}, "Profit_Margin_Pct" FROM silver
WHERE abs("Profit_Margin_Pct" - {sround('"Profit" / "Sales" * 100', 1)}) > 0.01"""),
        "union_years": build("""SELECT * REPLACE (CASE WHEN "Source_Year" <= 1997 THEN NULL ELSE "Segment" END AS "Segment") FROM raw"""),
        "append_sample": build("""SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE "Order ID" % 101 = 0"""),
        "coverage_gap": build(f"""SELECT e."Region" FROM (VALUES {exp_regions}) AS e("Region")
WHERE NOT EXISTS (SELECT 1 FROM regional r WHERE r."Region" = e."Region")""", marts_needed=("regional",)),
        "rank_in_category": build(f"""SELECT *, CAST(rank() OVER (PARTITION BY "Category" ORDER BY "Total_Sales" DESC NULLS LAST) AS INTEGER)
  AS "Sales_Rank" FROM (SELECT "Category", "Product Name", {money_sum('"Sales"')} AS "Total_Sales" FROM silver GROUP BY 1, 2)"""),
        "rank_in_region": build(f"""SELECT *, CAST(rank() OVER (PARTITION BY "Region" ORDER BY "Total_Sales" DESC NULLS LAST) AS INTEGER)
  AS "State_Rank" FROM (SELECT "Region", "State", {money_sum('"Sales"')} AS "Total_Sales" FROM silver GROUP BY 1, 2)"""),
        "global_rank": build(f"""SELECT {KEYS}, "Profit", CAST(rank() OVER (ORDER BY "Profit" ASC NULLS FIRST) AS BIGINT) AS "Profit_Rank"
FROM silver"""),
        "global_rank_desc": build(f"""SELECT {KEYS}, "Sales", CAST(rank() OVER (ORDER BY "Sales" DESC NULLS LAST) AS BIGINT) AS "Sales_Rank"
FROM silver"""),
        "yoy_lag": build(f"""SELECT *, {_growth('"Total_Sales"', '"Prev_Sales"')} AS "Growth_Pct" FROM (
  SELECT *, lag("Total_Sales") OVER (PARTITION BY "Region" ORDER BY "Order_Year" ASC NULLS FIRST) AS "Prev_Sales"
  FROM (SELECT "Region", "Order_Year", {money_sum('"Sales"')} AS "Total_Sales" FROM silver GROUP BY 1, 2))"""),
        "yoy_strict": build("""SELECT "Order_Year", "Total_Sales",
  lag("Total_Sales") OVER (ORDER BY "Order_Year" ASC NULLS FIRST) AS "Prev_Row_Sales",
  last_value("Total_Sales") OVER (ORDER BY "Order_Year" ASC NULLS FIRST RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS "Prev_Year_Sales"
FROM kpis WHERE "Order_Year" != 1997""", marts_needed=("kpis",)),
        "year_row_ids": _row_ids(),
        "record_hash": build(f"""SELECT {KEYS}, "Sales", "_record_hash" FROM bronze"""),
        "const_columns": build(f"""SELECT "Order_Year", COUNT(*) AS "Total_Rows", 'GOLD' AS "_layer", 1 AS "_version",
  TRUE AS "_is_final", CAST({lit(FIXED_BATCH_TIME)} AS TIMESTAMP) AS "_created_at",
  CAST({lit(FIXED_BATCH_TIME)} AS TIMESTAMP) AS "_batch_time",
  strftime(CAST({lit(FIXED_BATCH_TIME)} AS TIMESTAMP), '%Y%m%d_%H%M%S') AS "_batch_id"
FROM silver GROUP BY "Order_Year" """),
        "scalar_text": _scalar_text(),
        "scalar_date": _scalar_date(),
        "scalar_math": _scalar_math(),
        "top_20_losses": build("""SELECT * FROM loss ORDER BY "Total_Loss" ASC NULLS FIRST, "Category", "Sub-Category", "Product Name"
LIMIT 20""", marts_needed=("loss",)),
        "mode_year": build(f"SELECT {_mode_year('raw')} AS \"Modal_Year\""),
        "global_profile": _global_profile(["Sales", "Profit", "Discount", "Quantity"]),
        "conditional_counts": _conditional_counts(["Is_Loss", "Is_Returned"]),
        "shift_years": _shift_years(),
        "scale_years": _scale_years(),
        "expand_years": _expand_years(),
        "exact_sample": _exact_sample(),
        "generate_years": _generate_years(),
        "seeded_sample": build(f"SELECT * FROM clean_sales WHERE {_seeded(RANDOM_SEED, 10000)} < 1000"),
        "random_label": build(f"""SELECT {KEYS}, {_reasons_array()}[{_seeded(RANDOM_SEED, len(RETURN_REASONS))} + 1] AS "Return Reason"
FROM clean_sales"""),
        "inject_defects": _inject_defects(),
        "split_sources": _returns_sample(),
        "split_orders": build("SELECT " + ", ".join(q(c) for c in RAW_COLS if c not in ("Source_Year", "Source_File")) + " FROM clean_sales"),
        "csv_roundtrip": build("SELECT * FROM raw"),
        "defect_audit": build(f"""SELECT *, total_rows - unique_keys AS duplicate_rows FROM (
  SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE "Ship Mode" IS NULL) AS "null_Ship_Mode",
    COUNT(*) FILTER (WHERE "Customer Name" IS NULL) AS "null_Customer_Name",
    {_count_distinct_keys(["Order ID", "Product ID"])} AS unique_keys,
    COUNT(DISTINCT "Region") AS distinct_regions,
    COUNT(*) FILTER (WHERE try_cast("Discount" AS DOUBLE) > 1.0) AS bad_discounts FROM raw)"""),
        "encoding_read": build("""SELECT c_custkey, c_name || ' Céleste' AS c_label, 'ISO-8859-1' AS "encoding" FROM customer"""),
        "parquet_roundtrip": build("SELECT * FROM kpis", marts_needed=("kpis",)),
        "table_roundtrip": build("""SELECT "Source_Year", COUNT(*) AS "rows" FROM bronze GROUP BY 1"""),
        "catalog_roundtrip": build("""SELECT "Source_Year", COUNT(*) AS "rows" FROM bronze GROUP BY 1"""),
        "csv_text_read": build("""SELECT CAST("Source_Year" AS VARCHAR) AS "Source_Year", COUNT(*) AS "rows" FROM raw GROUP BY 1"""),
        "publish_mart": build(f"""SELECT *, 'executive_kpis' AS "_gold_table", CAST({lit(FIXED_BATCH_TIME)} AS TIMESTAMP) AS "_created_at"
FROM kpis""", marts_needed=("kpis",)),
        "multi_year_scan": build(f"""SELECT "Source_Year", "Source_File", COUNT(*) AS "rows", {money_sum('"Sales"')} AS "Total_Sales"
FROM raw GROUP BY 1, 2"""),
        "schema_gate": build("""SELECT * FROM (VALUES
  ('Order ID', TRUE, (SELECT COUNT("Order ID") FROM raw)), ('Order Date', TRUE, (SELECT COUNT("Order Date") FROM raw)),
  ('Sales', TRUE, (SELECT COUNT("Sales") FROM raw)), ('Profit', TRUE, (SELECT COUNT("Profit") FROM raw)),
  ('Discount', TRUE, (SELECT COUNT("Discount") FROM raw)), ('Category', TRUE, (SELECT COUNT("Category") FROM raw)),
  ('Region', TRUE, (SELECT COUNT("Region") FROM raw)), ('Postal Code', FALSE, CAST(NULL AS BIGINT)),
  ('Country', FALSE, CAST(NULL AS BIGINT))) AS t("column", present, non_null)"""),
        "sources_gate": build("""SELECT * FROM (VALUES ('lineitem', TRUE, (SELECT COUNT(*) FROM lineitem)),
  ('orders', TRUE, (SELECT COUNT(*) FROM orders)), ('customer', TRUE, (SELECT COUNT(*) FROM customer)),
  ('part', TRUE, (SELECT COUNT(*) FROM part)), ('nation', TRUE, (SELECT COUNT(*) FROM nation)),
  ('region', TRUE, (SELECT COUNT(*) FROM region)), ('missing_table', FALSE, CAST(NULL AS BIGINT)))
  AS t(source, present, "rows")"""),
        "verify_tables": _verify_tables(),
        "shape_profile": build(f"SELECT COUNT(*) AS \"rows\", {len(RAW_COLS)} AS \"columns\" FROM raw"),
        "retention_gate": build(f"""SELECT bronze_rows, silver_rows,
  CASE WHEN bronze_rows > 0 THEN {sround('silver_rows / bronze_rows * 100', 2)} ELSE 0.0 END AS retention_pct
FROM (SELECT (SELECT COUNT(*) FROM bronze) AS bronze_rows, (SELECT COUNT(*) FROM silver) AS silver_rows)"""),
        "dq_category_1": build(_dq_rows(_dq1()), *_dq_base()),
        "dq_category_2": build(_dq_rows(_dq2()), *_dq_base(), marts_needed=("kpis",)),
        "dq_category_3": build(_dq_rows(_dq3()), *_dq_base(), marts_needed=ALL_MARTS),
        "dq_report": _report(VALIDATION_TIME),
        "pipeline_end_to_end": _report(FIXED_BATCH_TIME),
        "ordered_report": _ordered_report(),
    })
    return out
