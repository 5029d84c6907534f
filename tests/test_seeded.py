"""Seeded operators against a brute-force Python model."""

import hashlib

from pyspark.sql import functions as F

from ledgerlake.config import RETURN_REASONS
from ledgerlake.operators import prep


def bucket(seed, order_id, product_id, buckets=10000):
    return int(hashlib.md5(f"{seed}|{order_id}|{product_id}".encode()).hexdigest()[:8], 16) % buckets


def _frame(spark, n=3000):
    rows = [(i * 7 + 3, f"P-{i % 113}", float(i % 50), 0.1 * (i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "`Order ID` long, `Product ID` string, Sales double, Discount double")


def test_seeded_sample_brute_force(spark):
    df = _frame(spark)
    got = sorted(r["Order ID"] for r in prep.seeded_sample(df.repartition(5), 0.10, seed=42).collect())
    want = sorted(o for o, p, _, _ in [(i * 7 + 3, f"P-{i % 113}", 0, 0) for i in range(3000)] if bucket(42, o, p) < 1000)
    assert got == want and 200 < len(got) < 400


def test_random_label_brute_force(spark):
    df = _frame(spark, 400)
    got = {r["Order ID"]: r["Return Reason"] for r in prep.random_label(df, "Return Reason", RETURN_REASONS, seed=5).collect()}
    for i in range(400):
        o, p = i * 7 + 3, f"P-{i % 113}"
        assert got[o] == RETURN_REASONS[bucket(5, o, p, len(RETURN_REASONS))]


def test_inject_defects_brute_force(spark):
    df = _frame(spark).withColumn("Ship Mode", F.lit("First")).withColumn("Region", F.lit("West"))
    out = prep.inject_defects(df, seed=2019).collect()
    rows = [(i * 7 + 3, f"P-{i % 113}") for i in range(3000)]
    dup = sum(1 for o, p in rows if bucket(2019, o, p) < 100)
    nulls = sum(1 for o, p in rows if bucket(2019, o, p) < 200)
    assert len(out) == 3000 + dup
    # NULLs are injected before duplication, so a duplicated NULL row counts twice
    dup_nulls = sum(1 for o, p in rows if bucket(2019, o, p) < 100)
    assert sum(1 for r in out if r["Ship Mode"] is None) == nulls + dup_nulls
    upper = sum(1 for r in out if r["Region"] == "WEST")
    assert 0 < upper < 300
