from pyspark.sql import functions as F

from ledgerlake.config import Coverage
from ledgerlake.plans import marts, quality
from ledgerlake.plans.bronze import build_bronze
from ledgerlake.plans.silver import build_silver
from tests import frames


def _inputs(spark, silver_tweak=None):
    rows = [{"Order ID": str(i), "Product ID": f"P{i % 7}", "Region": ["East", "West", "Central", "South"][i % 4],
             "Category": ["Furniture", "Office Supplies", "Technology"][i % 3],
             "Order Date": f"{1 + i % 12}/{1 + i % 28}/{2019 + i % 5}", "Ship Date": f"{1 + i % 12}/{1 + i % 28}/{2019 + i % 5}",
             "Discount": str([0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.6][i % 7]),
             "Profit": str(-3.0 if i % 5 == 0 else 4.0), "Source_Year": 2019 + i % 5}
            for i in range(200)]
    b = build_bronze(frames.orders(spark, rows), frames.returns(spark, [("3", "Wrong Item")]), frames.reps(spark),
                     batch_time="2024-01-01 00:00:00")
    s = build_silver(b, silver_time="2024-01-01 00:00:00")
    if silver_tweak is not None:
        s = silver_tweak(s)
    return quality.SuiteInputs(b, s, marts.build_gold(s))


def _report(spark, inp):
    rep = quality.validation_report(inp, "t0", coverage=Coverage(), with_measure=True)
    return {r.check_name: r for r in rep.collect()}


def test_clean_data_passes_all_37_checks(spark):
    rep = _report(spark, _inputs(spark))
    assert len(rep) == 37
    bad = {k: (v.status, v.actual) for k, v in rep.items() if v.status != "PASS"}
    assert bad == {}


def test_injected_defects_are_counted_exactly(spark):
    def tweak(s):
        oid = F.col("`Order ID`").cast("int")
        return s.withColumns({
            "Order Date": F.when(oid < 3, F.lit(None).cast("date")).otherwise(F.col("`Order Date`")),
            "Shipping_Days": F.when(oid.between(10, 13), F.lit(-1)).otherwise(F.col("Shipping_Days")),
            "Region": F.when(oid.between(20, 24), F.lit("EAST")).otherwise(F.col("Region")),
            "Discount": F.when(oid.between(30, 35), F.lit(1.5)).otherwise(F.col("Discount")),
            "Is_Loss": F.when(oid.between(40, 46), ~F.col("Is_Loss")).otherwise(F.col("Is_Loss")),
        })

    rep = _report(spark, _inputs(spark, tweak))
    assert (rep["Date Validity: Order Date"].status, rep["Date Validity: Order Date"].measure) == ("WARN", 3.0)
    assert (rep["Null Check: Order Date"].status, rep["Null Check: Order Date"].measure) == ("FAIL", 3.0)
    assert (rep["Shipping Days >= 0"].status, rep["Shipping Days >= 0"].measure) == ("FAIL", 4.0)
    assert (rep["Region Title Case"].status, rep["Region Title Case"].measure) == ("FAIL", 5.0)
    assert (rep["Discount Range [0, 1]"].status, rep["Discount Range [0, 1]"].measure) == ("FAIL", 6.0)
    assert (rep["Is_Loss Flag Accuracy"].status, rep["Is_Loss Flag Accuracy"].measure) == ("FAIL", 7.0)
    assert rep["Discount Amount Calculation"].measure == 6.0


def test_missing_mart_and_coverage(spark):
    inp = _inputs(spark)
    inp.gold["executive_kpis"] = None
    rep = quality.validation_report(inp, "t0", coverage=Coverage(regions=["East", "North"]), with_measure=True)
    rows = {r.check_name: r for r in rep.collect()}
    assert rows["Gold Table: executive_kpis"].actual == "Table missing"
    assert rows["YoY Growth Calculation"].status == "FAIL"
    assert rows["All 2 Regions Present"].status == "FAIL" and "North" in rows["All 2 Regions Present"].actual
    ordered = [r.status for r in quality.ordered_report(rep).collect()]
    assert ordered == sorted(ordered, key=["FAIL", "WARN", "PASS"].index)


def test_a_category_reads_only_what_it_needs(spark, tmp_dir):
    """Dependencies follow from the checks: category 1 needs no mart and one bronze branch without columns."""
    from ledgerlake.config import CAT1, CAT2, CAT3
    from ledgerlake.plans import quality
    from ledgerlake.registry import FIXTURE_COVERAGE, VALIDATION_TIME, suite
    from tests.conftest import SF_SMALL

    inp = suite(spark, SF_SMALL)
    whole = {r.check_name: tuple(r) for r in quality.validation_report(inp, VALIDATION_TIME, coverage=FIXTURE_COVERAGE, with_measure=True).collect()}
    assert len(whole) == 37
    some = {}
    for category in (CAT1, CAT2, CAT3):
        rep = quality.validation_report(inp, VALIDATION_TIME, coverage=FIXTURE_COVERAGE, with_measure=True, categories=[category])
        plan = rep._jdf.queryExecution().executedPlan().toString()
        if category == CAT1:
            scans = [line for line in plan.splitlines() if "FileScan" in line]
            assert len(scans) == 3 and "Total_Loss" not in plan and "Profit_Margin_Pct" not in plan
        some |= {r.check_name: tuple(r) for r in rep.collect()}
    assert some == whole
