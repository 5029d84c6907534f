import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clean, dedup, joins
from ledgerlake.plans.bronze import build_bronze
from ledgerlake.plans.silver import RetentionError, build_silver, retention_gate
from tests import frames


def test_text_in_number_column_and_nan(spark):
    df = frames.orders(spark, [{"Sales": "abc", "Quantity": "2.5"}, {"Sales": "NaN"}, {"Sales": "12.5"}])
    out = clean.coerce_types(df).select("Sales", "Quantity").collect()
    assert out[0].Sales is None and out[0].Quantity == 2  # the fraction is dropped
    assert out[1].Sales is None
    assert out[2].Sales == 12.5 and out[2].Quantity == 2


def test_fill_defaults_keeps_text_postal_code(spark):
    df = frames.orders(spark, [{"Postal Code": None, "Ship Mode": None}])
    r = clean.fill_defaults(df).first()
    assert r["Postal Code"] == "00000" and r["Ship Mode"] == "Standard Class"


def test_keep_first_is_deterministic(spark):
    rows = [{"Region": "West", "Discount": "0.2"}, {"Region": "EAST", "Discount": "0.1"}, {"Region": "east", "Discount": "0.3"}]
    df = frames.orders(spark, rows)
    picks = set()
    for n in (1, 3, 7):
        r = dedup.keep_first(df.repartition(n), ["Order ID", "Product ID", "Source_Year"]).collect()
        assert len(r) == 1
        picks.add((r[0]["Region"], r[0]["Discount"]))
    assert picks == {("EAST", "0.1")}  # smallest over all columns (uppercase sorts first)


def test_keep_first_prefers_the_complete_copy(spark):
    df = frames.orders(spark, [{"Region": None, "City": "A"}, {"Region": "West", "City": "B"}, {"Region": "West", "City": None}])
    (r,) = dedup.keep_first(df, ["Order ID", "Product ID", "Source_Year"], complete=["Region"]).collect()
    assert (r["Region"], r["City"]) == ("West", "B")


def test_integer_columns_take_numeric_text(spark):
    texts = ["3.0", "3.7", " 3 ", "x", "1e20", "-2.9", "2147483647", "2147483648", "NaN", None]
    df = frames.orders(spark, [{"Order ID": str(i), "Quantity": t} for i, t in enumerate(texts)])
    got = {int(r["Order ID"]): r["Quantity"] for r in clean.coerce_types(df).collect()}
    assert [got[i] for i in range(len(texts))] == [3, 3, 3, None, None, -2, 2147483647, None, None, None]


def test_duplicate_returns_do_not_fan_out(spark):
    o = frames.orders(spark, [{"Order ID": "A"}, {"Order ID": "B"}])
    r = frames.returns(spark, [("A", "Wrong Item"), ("A", "Changed Mind")])
    out = joins.join_returns(o, r).orderBy("Order ID").collect()
    assert len(out) == 2
    assert out[0]["Return Reason"] == "Changed Mind" and out[0]["Is_Returned"] is True
    assert out[1]["Return Reason"] == "Not Returned" and out[1]["Is_Returned"] is False


def test_silver_edges(spark):
    rows = [
        {"Order ID": "1", "Region": "EAST"},                                   # no rep (case), then East
        {"Order ID": "2", "Region": " east "},                                 # trimmed + title-cased
        {"Order ID": "3", "Ship Date": "1/1/2019", "Order Date": "1/5/2019"},  # ship before order -> 0
        {"Order ID": "4", "Ship Date": None},                                  # NULL ship date -> 0
        {"Order ID": "5", "Sales": "0"},                                       # removed
        {"Order ID": "6", "Sales": "-1"},                                      # removed
        {"Order ID": "7", "Sales": None},                                      # mandatory NULL, dropped
        {"Order ID": "8", "Discount": "2.0"},                                  # clamped to 1.0
        {"Order ID": "9", "Discount": "-0.1"},                                 # clamped to 0.0
        {"Order ID": "10", "Order Date": "2/29/2019"},                         # NULL date, kept
        {"Order ID": "11", "Profit": "-5"},                                    # loss
    ]
    bronze = build_bronze(frames.orders(spark, rows), frames.returns(spark, [("11", "Defective Product")]),
                          frames.reps(spark), batch_time="2024-01-01 00:00:00")
    silver = {r["Order ID"]: r for r in build_silver(bronze, silver_time="2024-01-01 00:00:00").collect()}
    assert set(silver) == {"1", "2", "3", "4", "8", "9", "10", "11"}
    assert silver["1"]["Region"] == "East" and silver["1"]["Salesperson"] == "Unassigned" and silver["1"]["Target_Sales"] == 0
    assert silver["2"]["Region"] == "East" and silver["2"]["Salesperson"] == "Unassigned"
    assert silver["3"]["Shipping_Days"] == 0 and silver["4"]["Shipping_Days"] == 0
    assert silver["8"]["Discount"] == 1.0 and silver["9"]["Discount"] == 0.0
    assert silver["8"]["Discount_Amount"] == 100.0
    assert silver["10"]["Order Date"] is None and silver["10"]["Order_Year"] is None
    assert silver["11"]["Is_Loss"] is True and silver["11"]["Is_Returned"] is True
    assert silver["11"]["Profit_Margin_Pct"] == -5.0
    good = build_bronze(frames.orders(spark, [{"Order ID": str(i)} for i in range(40)]), frames.returns(spark, []),
                        frames.reps(spark))
    assert retention_gate(good, build_silver(good)) == 100.0
    try:
        retention_gate(bronze, build_silver(bronze))
        raise AssertionError("gate should raise")
    except RetentionError:
        pass


def test_null_profile_one_pass(spark):
    df = frames.orders(spark, [{"Ship Mode": None}, {"Ship Mode": None, "City": None}, {}])
    prof = {r["column"]: r["null_count"] for r in clean.null_profile(df).collect()}
    assert prof["Ship Mode"] == 2 and prof["City"] == 1 and prof["Sales"] == 0


def test_dedup_report_counts_null_keys(spark):
    df = frames.orders(spark, [{"Product ID": None}, {"Product ID": None}, {"Product ID": "P"}])
    r = dedup.dedup_report(df, ["Order ID", "Product ID", "Source_Year"]).first()
    assert (r.rows_before, r.rows_after, r.rows_removed) == (3, 2, 1)


def test_rep_join_exact_vs_normalized(spark):
    o = frames.orders(spark, [{"Order ID": "1", "Region": "EAST"}, {"Order ID": "2", "Region": " west "},
                              {"Order ID": "3", "Region": "Central"}])
    exact = {r["Order ID"]: r["Salesperson"] for r in joins.join_salespeople(o, frames.reps(spark)).collect()}
    assert exact == {"1": None, "2": None, "3": "Robert Smith"}
    fixed = {r["Order ID"]: r["Salesperson"]
             for r in joins.join_salespeople(o, frames.reps(spark), normalize_keys=True).collect()}
    assert fixed == {"1": "Alex Johnson", "2": "Maria Chen", "3": "Robert Smith"}


def test_a_region_with_two_reps_raises(spark):
    reps = frames.reps(spark)
    with pytest.raises(joins.DuplicateKeyError, match="Region"):
        joins.join_salespeople(frames.orders(spark, [{"Order ID": "1"}]), reps.union(reps.limit(1)))
