"""Declarative data-quality suite (DQ1a-DQ6).

Every check is a measure (an aggregate expression) plus a rule that turns the
measure into PASS / FAIL / WARN. All measures of all layers are computed in
ONE aggregate over a tagged union of narrow projections of bronze, silver and
the marts, in one job instead of one job per check. Each table is scanned
once, plus one narrow scan of silver's key columns for the duplicate count
(a DISTINCT of its own branch, so the main aggregate stays a plain partial +
final aggregate). The single result row is unpivoted into report rows with ``inline``;
the report never passes through the driver.

A report of some categories reads only what their checks need: building a check notes the measures it
uses, building a measure the inputs and columns (``Trace``).

Checks on the schema (mandatory / derived columns present) are decided on the
driver from ``df.columns`` (no job).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.config import (
    CAT1,
    CAT2,
    CAT3,
    DERIVED_COLS,
    DUPLICATE_CHECK_KEY,
    LAYER_GOLD,
    LAYER_SILVER,
    MANDATORY_COLS,
    MART_NAMES,
    STATUS_ORDER,
    Coverage,
    Thresholds,
)
from ledgerlake.functions.text import col

REPORT_SCHEMA = StructType(
    [
        StructField("category", StringType()),
        StructField("check_name", StringType()),
        StructField("status", StringType()),
        StructField("expected", StringType()),
        StructField("actual", StringType()),
        StructField("layer", StringType()),
        StructField("validation_time", StringType()),
    ]
)

DEC = "decimal(24,6)"
BRONZE_COLUMNS = ["Sales", "Profit"]  # what the checks read of bronze, beside its number of rows
# integer branch tags of the tagged union (cheaper to compare than text)
TAG = {"B": 0, "S": 1, "K": 2, **{name: 10 + i for i, name in enumerate(MART_NAMES)}}


@dataclass
class Check:
    """One report row: how to compute it from the measure row."""

    category: str
    name: str
    layer: str
    expected: str
    status: Column
    actual: Column
    measure: Column


class Trace(list):
    """A list that keeps with each item what was noted since the item before."""

    def __init__(self):
        super().__init__()
        self.needs: list[set] = []
        self._noted: set = set()

    def note(self, what) -> None:
        self._noted.add(what)

    def append(self, item) -> None:
        super().append(item)
        self.needs.append(self._noted)
        self._noted = set()


def _n(c: Column) -> Column:
    """Thousands-separated integer text."""
    return F.format_number(c.cast("double"), 0)


def _money(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def _pf(ok: Column, bad: str = "FAIL") -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit(bad))


def _missing_list(flags: list[tuple[str, Column]]) -> Column:
    """Array of labels whose 'found' flag is false (order kept)."""
    return F.array_compact(F.array(*[F.when(~found, F.lit(label)) for label, found in flags]))


def check_specs(th: Thresholds = Thresholds(), cov: Coverage = Coverage()) -> list[tuple[str, str, str, str]]:
    """(category, check_name, layer, expected) of every check, in report order.

    Pure Python (no Spark): the single source of the report's names and
    expectation texts, also used to write the SQL oracle.

    FIXED VALUES: the check names and expectation texts below must equal the
    reproduced report's, so they are listed plainly, in report order.
    """
    yrs = cov.years
    span = f"{yrs[0]}-{yrs[-1]}" if yrs else ""
    first = yrs[0] if yrs else None
    specs = [
        (CAT1, "Row Retention Bronze→Silver", LAYER_SILVER, f">= {th.min_retention_pct}% retention"),
        (CAT1, "Mandatory Columns Present", LAYER_SILVER, f"All {len(MANDATORY_COLS)} mandatory cols"),
    ]
    specs += [(CAT1, f"Null Check: {c}", LAYER_SILVER, "0 nulls") for c in MANDATORY_COLS]
    specs += [
        (CAT1, "Duplicate Rate After Cleaning", LAYER_SILVER, f"<= {th.max_duplicate_pct}% duplicates"),
        (CAT1, "Date Validity: Order Date", LAYER_SILVER, "All dates parseable"),
        (CAT1, "Date Validity: Ship Date", LAYER_SILVER, "All dates parseable"),
        (CAT1, "Sales > 0", LAYER_SILVER, "All Sales > 0"),
        (CAT1, "Quantity > 0", LAYER_SILVER, "All Quantity > 0"),
        (CAT1, "Region Title Case", LAYER_SILVER, "All regions in Title Case"),
        (CAT1, "Discount Range [0, 1]", LAYER_SILVER, "All Discount in [0, 1]"),
        (CAT2, "Sales Total Reconciliation", LAYER_SILVER, f"Variance <= {th.max_variance_pct}%"),
        (CAT2, "Profit Total Reconciliation", LAYER_SILVER, f"Variance <= {th.max_variance_pct}%"),
        (CAT2, "Profit Margin Calculation", LAYER_SILVER, "Margin = (Profit/Sales)*100"),
        (CAT2, "Discount Amount Calculation", LAYER_SILVER, "Discount_Amount = Sales × Discount"),
        (CAT2, "Is_Loss Flag Accuracy", LAYER_SILVER, "Is_Loss = True where Profit < 0"),
        (CAT2, "Shipping Days >= 0", LAYER_SILVER, "All Shipping_Days >= 0"),
        (CAT2, "YoY Growth Calculation", LAYER_GOLD,
         f"{first}=null, {first + 1 if first else ''}-{yrs[-1] if yrs else ''} have YoY%"),
        (CAT2, "All 7 Derived Columns Present", LAYER_SILVER, f"All {len(DERIVED_COLS)} derived columns"),
    ]
    specs += [(CAT3, f"Gold Table: {name}", LAYER_GOLD, "Table exists with rows") for name in MART_NAMES]
    specs += [
        (CAT3, "Sales Trend Years Coverage", LAYER_GOLD, f"Years {span} all present"),
        (CAT3, f"All {len(cov.regions)} Regions Present", LAYER_GOLD, ", ".join(cov.regions)),
        (CAT3, f"All {len(cov.categories)} Categories Present", LAYER_GOLD, ", ".join(cov.categories)),
        (CAT3, "Loss Products Have Negative Profit", LAYER_GOLD, "All Total_Loss < 0"),
        (CAT3, "Discount Buckets Complete", LAYER_GOLD, f"{len(cov.buckets)} buckets"),
        (CAT3, f"KPIs Cover All {len(yrs)} Years", LAYER_GOLD, f"{len(yrs)} years: {span}"),
        (CAT3, "Gold vs Silver Sales Match", LAYER_GOLD, f"Variance <= {th.max_variance_pct}%"),
    ]
    return specs


@dataclass
class SuiteInputs:
    bronze: DataFrame
    silver: DataFrame
    gold: dict[str, DataFrame | None] = field(default_factory=dict)


def _tagged_union(inp: SuiteInputs, used: set[tuple[str, str | None]]) -> DataFrame:
    """Narrow projections of the used (branch, column)s, tagged, unioned by name."""
    parts = []
    for branch, tag in TAG.items():
        cols = sorted(c for b, c in used if b == branch and c)
        if not any(b == branch for b, _ in used):
            continue
        if branch == "B":
            parts.append(inp.bronze.select(F.lit(tag).alias("_t"), *[col(c).try_cast("double").alias(f"b_{c.lower()}") for c in cols]))
        elif branch == "S":
            parts.append(inp.silver.select(F.lit(tag).alias("_t"), *[col(c).alias("s:" + c) for c in cols]))
        elif branch == "K":
            # distinct keys as their own branch: the main aggregate then needs no
            # DISTINCT (several DISTINCTs would make Spark expand every row)
            keys = inp.silver.select(*[col(k) for k in DUPLICATE_CHECK_KEY]).distinct()
            parts.append(keys.select(F.lit(tag).alias("_t")))
        else:
            parts.append(inp.gold[branch].select(F.lit(tag).alias("_t"), *[col(c).alias(f"{branch}:{c}") for c in cols]))
    if not parts:
        return inp.silver.sparkSession.createDataFrame([], "_t int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _checks(inp: SuiteInputs, th: Thresholds, cov: Coverage) -> Trace:
    """(name, aggregate) of every measure; ``needs`` has the (branch, column)s that each reads."""
    m = Trace()

    def is_(branch: str) -> Column:
        m.note((branch, None))
        return F.col("_t") == F.lit(TAG[branch])

    s_have = set(inp.silver.columns)

    def s(c):
        m.note(("S", c))
        return F.col(f"`s:{c}`")

    def g(name, c):
        m.note((name, c))
        return F.col(f"`{name}:{c}`")

    def b(c):
        m.note(("B", c))
        return F.col(f"b_{c.lower()}")

    def add(name, expr):
        m.append((name, expr))

    add("bronze_rows", F.count_if(is_("B")))
    add("silver_rows", F.count_if(is_("S")))
    add("bronze_sales", F.sum(F.when(is_("B"), b("Sales").try_cast(DEC))).cast("double"))
    add("bronze_profit", F.sum(F.when(is_("B"), b("Profit").try_cast(DEC))).cast("double"))
    if "Sales" in s_have:
        add("silver_sales", F.sum(F.when(is_("S"), s("Sales").try_cast(DEC))).cast("double"))
        add("invalid_sales", F.count_if((is_("S")) & (s("Sales") <= 0)))
    if "Profit" in s_have:
        add("silver_profit", F.sum(F.when(is_("S"), s("Profit").try_cast(DEC))).cast("double"))
    for i, c in enumerate(MANDATORY_COLS):
        if c in s_have:
            add(f"null_{i}", F.count_if((is_("S")) & s(c).isNull()))
    if all(k in s_have for k in DUPLICATE_CHECK_KEY):
        add("unique_keys", F.count_if(is_("K")))
    for i, c in enumerate(["Order Date", "Ship Date"]):
        if c in s_have:
            add(f"bad_date_{i}", F.count_if((is_("S")) & s(c).isNull()))
    if "Quantity" in s_have:
        add("invalid_qty", F.count_if((is_("S")) & (s("Quantity") <= 0)))
    if "Region" in s_have:
        add("bad_case", F.count_if((is_("S")) & (s("Region") != F.initcap(s("Region")))))
    if "Discount" in s_have:
        add("bad_discount", F.count_if((is_("S")) & ((s("Discount") < 0) | (s("Discount") > 1))))
    if {"Sales", "Profit", "Profit_Margin_Pct"} <= s_have:
        expected_margin = F.when(s("Sales") != 0, F.round(F.try_divide(s("Profit"), s("Sales")) * 100, 2)).otherwise(F.lit(0.0))
        add("margin_errors", F.count_if((is_("S")) & (F.abs(s("Profit_Margin_Pct") - expected_margin) > 0.01)))
    if {"Sales", "Discount", "Discount_Amount"} <= s_have:
        expected_amt = F.round(s("Sales") * s("Discount"), 2)
        add("discount_errors", F.count_if((is_("S")) & (F.abs(s("Discount_Amount") - expected_amt) > 0.01)))
    if {"Profit", "Is_Loss"} <= s_have:
        wrong = ((s("Profit") < 0) & (s("Is_Loss") == F.lit(False))) | ((s("Profit") >= 0) & (s("Is_Loss") == F.lit(True)))
        add("loss_flag_errors", F.count_if((is_("S")) & wrong))
    if "Shipping_Days" in s_have:
        add("negative_shipping", F.count_if((is_("S")) & (s("Shipping_Days") < 0)))

    gold = {k: v for k, v in inp.gold.items() if v is not None}
    for name in MART_NAMES:
        if name in gold:
            add(f"rows:{name}", F.count_if(is_(name)))
    first_year = cov.years[0] if cov.years else None
    if "executive_kpis" in gold and {"Order_Year", "YoY_Sales_Growth_Pct"} <= set(gold["executive_kpis"].columns):
        k = "executive_kpis"
        add("yoy_first_null", F.count_if(is_(k) & (g(k, "Order_Year") == F.lit(first_year)) & g(k, "YoY_Sales_Growth_Pct").isNull()))
        add("yoy_later_valid", F.count_if(is_(k) & (g(k, "Order_Year") > F.lit(first_year)) & g(k, "YoY_Sales_Growth_Pct").isNotNull()))
        add("gold_sales", F.sum(F.when(is_(k), g(k, "Total_Sales").try_cast(DEC))).cast("double"))
    if "loss_making_products" in gold:
        add("loss_not_negative", F.count_if((is_("loss_making_products")) & (g("loss_making_products", "Total_Loss") >= 0)))

    def found_flags(mart, column, values, prefix):
        flags = []
        if mart in gold and column in gold[mart].columns:
            for i, v in enumerate(values):
                key = f"{prefix}{i}"
                add(key, F.count_if((is_(mart)) & (g(mart, column) == F.lit(v))) > 0)
                flags.append((str(v), key))
        return flags

    found_flags("sales_trend", "Order_Year", cov.years, "cy")
    found_flags("regional_performance", "Region", cov.regions, "cr")
    found_flags("category_performance", "Category", cov.categories, "cc")
    found_flags("discount_impact", "Discount_Bucket", cov.buckets, "cb")
    found_flags("executive_kpis", "Order_Year", cov.years, "ck")
    return m


def measures(inp: SuiteInputs, thresholds: Thresholds = Thresholds(), coverage: Coverage = Coverage(), names: set[str] | None = None) -> DataFrame:
    """The one-row measure frame (one job when evaluated); only the named measures and what they read, if given."""
    m = _checks(inp, thresholds, coverage)
    wanted = [(item, needs) for item, needs in zip(m, m.needs, strict=True) if names is None or item[0] in names]
    used = set().union(*[needs for _, needs in wanted])
    if not wanted:
        return inp.silver.sparkSession.range(1).select(F.lit(0).alias("no_measure"))
    return _tagged_union(inp, used).agg(*[expr.alias(name) for (name, expr), _ in wanted])


def _build_checks(inp: SuiteInputs, th: Thresholds, cov: Coverage, present: set[str]) -> Trace:
    """Report rows as expressions over the measure row (columns named as in ``measures``); ``needs`` has the measures of each.

    The 'actual' texts (e.g. "98.94% (59,945/60,586 rows)", "3 nulls") follow
    the reproduced report's wording (fixed values).
    """
    out = Trace()
    s_have = set(inp.silver.columns)
    gold = {k: v for k, v in inp.gold.items() if v is not None}
    exp_of = {name: expected for _, name, _, expected in check_specs(th, cov)}

    def m(name):
        out.note(name)
        return F.col(f"`{name}`")

    # --- category 1 ---------------------------------------------------------
    ret = F.when(m("bronze_rows") > 0, m("silver_rows") / m("bronze_rows") * 100).otherwise(F.lit(0.0))
    out.append(Check(CAT1, "Row Retention Bronze→Silver", LAYER_SILVER, exp_of["Row Retention Bronze→Silver"],
                     _pf(ret >= th.min_retention_pct),
                     F.format_string("%.2f%% (%s/%s rows)", ret, _n(m("silver_rows")), _n(m("bronze_rows"))), ret))
    missing = [x for x in MANDATORY_COLS if x not in s_have]
    out.append(Check(CAT1, "Mandatory Columns Present", LAYER_SILVER, exp_of["Mandatory Columns Present"],
                     F.lit("PASS" if not missing else "FAIL"),
                     F.lit("All present" if not missing else f"Missing: {missing}"), F.lit(float(len(missing)))))
    for i, name in enumerate(MANDATORY_COLS):
        if f"null_{i}" in present:
            v = m(f"null_{i}")
            out.append(Check(CAT1, f"Null Check: {name}", LAYER_SILVER, exp_of[f"Null Check: {name}"], _pf(v == 0),
                             F.concat(_n(v), F.lit(" nulls")), v.cast("double")))
    if "unique_keys" in present:
        dup = m("silver_rows") - m("unique_keys")
        dup_pct = F.when(m("silver_rows") > 0, dup / m("silver_rows") * 100).otherwise(F.lit(0.0))
        out.append(Check(CAT1, "Duplicate Rate After Cleaning", LAYER_SILVER, exp_of["Duplicate Rate After Cleaning"],
                         _pf(dup_pct <= th.max_duplicate_pct),
                         F.format_string("%.2f%% (%s rows)", dup_pct, _n(dup)), dup_pct))
    for i, name in enumerate(["Order Date", "Ship Date"]):
        if f"bad_date_{i}" in present:
            v = m(f"bad_date_{i}")
            out.append(Check(CAT1, f"Date Validity: {name}", LAYER_SILVER, exp_of[f"Date Validity: {name}"], _pf(v == 0, "WARN"),
                             F.concat(_n(v), F.lit(" unparseable dates")), v.cast("double")))
    for key, name, exp, unit in [("invalid_sales", "Sales > 0", "All Sales > 0", " invalid sales"),
                                 ("invalid_qty", "Quantity > 0", "All Quantity > 0", " invalid quantities"),
                                 ("bad_case", "Region Title Case", "All regions in Title Case", " inconsistent values"),
                                 ("bad_discount", "Discount Range [0, 1]", "All Discount in [0, 1]", " invalid discounts")]:
        if key in present:
            v = m(key)
            out.append(Check(CAT1, name, LAYER_SILVER, exp_of[name], _pf(v == 0), F.concat(_n(v), F.lit(unit)), v.cast("double")))

    # --- category 2 ---------------------------------------------------------
    for what, bkey, skey in [("Sales", "bronze_sales", "silver_sales"), ("Profit", "bronze_profit", "silver_profit")]:
        if skey in present:
            b = F.coalesce(m(bkey), F.lit(0.0))
            s = F.coalesce(m(skey), F.lit(0.0))
            var = F.when(b != 0, F.abs(s - b) / F.abs(b) * 100).otherwise(F.lit(0.0))
            out.append(Check(CAT2, f"{what} Total Reconciliation", LAYER_SILVER, exp_of[f"{what} Total Reconciliation"],
                             _pf(var <= th.max_variance_pct),
                             F.format_string("Bronze=%s | Silver=%s | Variance=%.2f%%", _money(b), _money(s), var), var))
    for key, name, exp, unit in [("margin_errors", "Profit Margin Calculation", "Margin = (Profit/Sales)*100", " calculation errors"),
                                 ("discount_errors", "Discount Amount Calculation", "Discount_Amount = Sales × Discount", " calculation errors"),
                                 ("loss_flag_errors", "Is_Loss Flag Accuracy", "Is_Loss = True where Profit < 0", " incorrect flags"),
                                 ("negative_shipping", "Shipping Days >= 0", "All Shipping_Days >= 0", " negative values")]:
        if key in present:
            v = m(key)
            out.append(Check(CAT2, name, LAYER_SILVER, exp_of[name], _pf(v == 0), F.concat(_n(v), F.lit(unit)), v.cast("double")))
    first = cov.years[0] if cov.years else None
    later = max(len(cov.years) - 1, 0)
    if "yoy_first_null" in present:
        ok = (m("yoy_first_null") == 1) & (m("yoy_later_valid") == later)
        last = cov.years[-1] if cov.years else None
        out.append(Check(CAT2, "YoY Growth Calculation", LAYER_GOLD, exp_of["YoY Growth Calculation"],
                         _pf(ok, "WARN"),
                         F.format_string(f"{first} null=%s | valid=%s/{later}",
                                         F.when(m("yoy_first_null") == 1, F.lit("True")).otherwise(F.lit("False")),
                                         m("yoy_later_valid")),
                         m("yoy_later_valid").cast("double")))
    else:
        out.append(Check(CAT2, "YoY Growth Calculation", LAYER_GOLD, "executive_kpis table exists", F.lit("FAIL"),
                         F.lit("Table not found"), F.lit(None).cast("double")))
    missing_d = [x for x in DERIVED_COLS if x not in s_have]
    out.append(Check(CAT2, "All 7 Derived Columns Present", LAYER_SILVER, exp_of["All 7 Derived Columns Present"],
                     F.lit("PASS" if not missing_d else "FAIL"),
                     F.lit("All present" if not missing_d else f"Missing: {missing_d}"), F.lit(float(len(missing_d)))))

    # --- category 3 ---------------------------------------------------------
    for name in MART_NAMES:
        if name in gold:
            v = m(f"rows:{name}")
            out.append(Check(CAT3, f"Gold Table: {name}", LAYER_GOLD, exp_of[f"Gold Table: {name}"], _pf(v > 0),
                             F.concat(_n(v), F.lit(" rows")), v.cast("double")))
        elif name in inp.gold:
            out.append(Check(CAT3, f"Gold Table: {name}", LAYER_GOLD, "Table exists with rows", F.lit("FAIL"),
                             F.lit("Table missing"), F.lit(None).cast("double")))

    def coverage_check(prefix, values, name, exp, bad="FAIL"):
        keys = [f"{prefix}{i}" for i in range(len(values))]
        if not keys or keys[0] not in present:
            return
        miss = _missing_list([(str(v), m(k)) for v, k in zip(values, keys)])
        n_miss = F.size(miss)
        out.append(Check(CAT3, name, LAYER_GOLD, exp_of[name], _pf(n_miss == 0, bad),
                         F.format_string("Found %s/%s expected | Missing: %s", F.lit(len(values)) - n_miss,
                                         F.lit(len(values)),
                                         F.when(n_miss == 0, F.lit("None")).otherwise(F.array_join(miss, ", "))),
                         n_miss.cast("double")))

    yrs = cov.years
    span = f"{yrs[0]}-{yrs[-1]}" if yrs else ""
    coverage_check("cy", yrs, "Sales Trend Years Coverage", f"Years {span} all present")
    coverage_check("cr", cov.regions, f"All {len(cov.regions)} Regions Present", ", ".join(cov.regions))
    coverage_check("cc", cov.categories, f"All {len(cov.categories)} Categories Present", ", ".join(cov.categories))
    if "loss_not_negative" in present:
        v = m("loss_not_negative")
        out.append(Check(CAT3, "Loss Products Have Negative Profit", LAYER_GOLD, exp_of["Loss Products Have Negative Profit"], _pf(v == 0),
                         F.format_string("%s products | %s invalid", _n(m("rows:loss_making_products")), _n(v)),
                         v.cast("double")))
    coverage_check("cb", cov.buckets, "Discount Buckets Complete", f"{len(cov.buckets)} buckets", "WARN")
    coverage_check("ck", yrs, f"KPIs Cover All {len(yrs)} Years", f"{len(yrs)} years: {span}")
    if "gold_sales" in present and "silver_sales" in present:
        s = F.coalesce(m("silver_sales"), F.lit(0.0))
        gsum = F.coalesce(m("gold_sales"), F.lit(0.0))
        var = F.when(s != 0, F.abs(gsum - s) / F.abs(s) * 100).otherwise(F.lit(0.0))
        out.append(Check(CAT3, "Gold vs Silver Sales Match", LAYER_GOLD, exp_of["Gold vs Silver Sales Match"],
                         _pf(var <= th.max_variance_pct),
                         F.format_string("Silver=%s | Gold=%s | Variance=%.2f%%", _money(s), _money(gsum), var), var))
    return out


def validation_report(inp: SuiteInputs, validation_time: str, thresholds: Thresholds = Thresholds(),
                      coverage: Coverage = Coverage(), with_measure: bool = False, categories: list[str] | None = None) -> DataFrame:
    """Report rows as a DataFrame (category, check_name, status, expected, actual, layer, validation_time).

    ``with_measure`` adds the numeric value each status was decided on. With ``categories`` only
    their checks are reported, and only the inputs and columns that these need are read.
    """
    present = {name for name, _ in _checks(inp, thresholds, coverage)}
    all_checks = _build_checks(inp, thresholds, coverage, present)
    wanted = [(ch, needs) for ch, needs in zip(all_checks, all_checks.needs, strict=True) if categories is None or ch.category in categories]
    mrow = measures(inp, thresholds, coverage, set().union(*[needs for _, needs in wanted]))
    fields = []
    for ch, _ in wanted:
        parts = [
            F.lit(ch.category).alias("category"),
            F.lit(ch.name).alias("check_name"),
            ch.status.alias("status"),
            F.lit(ch.expected).alias("expected"),
            ch.actual.alias("actual"),
            F.lit(ch.layer).alias("layer"),
            F.lit(validation_time).alias("validation_time"),
        ]
        if with_measure:
            parts.append(ch.measure.cast("double").alias("measure"))
        fields.append(F.struct(*parts))
    return mrow.select(F.inline(F.array(*fields)))


def status_rank(status: Column) -> Column:
    """FAIL < WARN < PASS, for ordering (OR3)."""
    expr = None
    for i, s in enumerate(STATUS_ORDER, start=1):
        expr = F.when(status == s, F.lit(i)) if expr is None else expr.when(status == s, F.lit(i))
    return expr


def ordered_report(report: DataFrame) -> DataFrame:
    """Report sorted FAIL -> WARN -> PASS, then category, then check name (DQ4/OR3)."""
    return report.orderBy(status_rank(F.col("status")), F.col("category"), F.col("check_name"))
