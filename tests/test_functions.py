import math

from pyspark.sql import functions as F

from ledgerlake.functions import clamp, discount_bucket, parse_date, record_hash, title_case
from ledgerlake.functions.numeric import exact_avg, round_money_sum
from ledgerlake.operators import clean


def one(spark, expr, schema, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr).collect()]


def test_round_half_up_on_decimal_text(spark):
    out = one(spark, F.round(F.col("x"), 2), "x double", [0.285, 1.005, -0.285, 2.675])
    assert out == [0.29, 1.01, -0.29, 2.68]


def test_parse_date_edges(spark):
    df = spark.createDataFrame([("2/29/2019",), ("13/45/2019",), (None,), ("1/3/2019",), ("01/03/2019",), ("2019-01-03",)],
                               "d string")
    out = [r[0] for r in df.select(parse_date(F.col("d"), df.schema["d"].dataType)).collect()]
    assert out[0] is None and out[1] is None and out[2] is None
    assert out[3] == out[4] and str(out[3]) == "2019-01-03"
    assert out[5] is None  # ISO text is not the configured format
    multi = [r[0] for r in df.select(parse_date(F.col("d"), df.schema["d"].dataType, ["M/d/yyyy", "yyyy-MM-dd"])).collect()]
    assert str(multi[5]) == "2019-01-03"


def test_title_case(spark):
    out = one(spark, title_case(F.col("r")), "r string", ["EAST", " east ", "st. paul-minneapolis", None])
    assert out == ["East", "East", "St. Paul-minneapolis", None]


def test_record_hash_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    r = df.select(record_hash(F.col("x"), F.col("y"), F.col("z")).alias("h1"),
                  record_hash(F.col("x"), F.col("z")).alias("h2")).first()
    assert r.h1 == r.h2


def test_discount_bucket_edges(spark):
    vals = [-0.1, 0.0, 0.1, 0.5, 0.51, 1.0, 2.0, None]
    out = one(spark, discount_bucket(F.col("d")), "d double", vals)
    assert out == ["2. 1-10%", "1. No Discount", "2. 1-10%", "6. 41-50%", "7. 51%+", "7. 51%+", "7. 51%+", "7. 51%+"]


def test_clamp_null_becomes_floor(spark):
    out = one(spark, clamp(F.col("d"), 0.0, 1.0), "d double", [-0.1, 0.3, 2.0, None])
    assert out == [0.0, 0.3, 1.0, 0.0]


def test_exact_sum_and_avg(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "x double")
    r = df.agg(round_money_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a")).first()
    assert r.s == 0.6 and math.isclose(r.a, 0.2)
    empty = df.filter("x > 10").agg(exact_avg(F.col("x")).alias("a")).first()
    assert empty.a is None


def test_values_no_sum_can_hold(spark):
    rows = [("Infinity",), ("-Infinity",), ("NaN",), ("1e20",), ("2.5",), ("1.5",), (None,)]
    text = spark.createDataFrame(rows, "Sales string")
    for df in (clean.coerce_types(text), text.selectExpr("cast(Sales as double) as Sales")):
        r = df.agg(round_money_sum(F.col("Sales")).alias("s"), exact_avg(F.col("Sales")).alias("a")).first()
        assert (r.s, r.a) == (4.0, 2.0)
    assert clean.coerce_types(text).filter("Sales is null").count() == 5
