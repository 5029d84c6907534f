import math

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "YoY_Sales_Growth_Pct" in df.columns and "Order_Year" in df.columns


def test_registry_and_oracle_keys():
    from __spark_entry__ import oracle_sql, queries

    q, o = queries(), oracle_sql()
    assert len(q) >= 90
    assert set(o) <= set(q)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", ["executive_kpis", "loss_making_products", "text_pipeline_kpis", "dedup_deterministic",
                                  "global_rank", "dq_category_1", "year_row_ids"])
def test_oracle_parity_small(spark, name):
    from __spark_entry__ import oracle_sql, queries

    sdf = queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(oracle_sql()[name])
    cols = sorted(sdf.columns)
    assert cols == sorted(rel.columns)
    si = [sdf.columns.index(c) for c in cols]
    oi = [rel.columns.index(c) for c in cols]
    s_rows = sorted((tuple(_norm(r[i]) for i in si) for r in sdf.collect()), key=repr)
    o_rows = sorted((tuple(_norm(r[i]) for i in oi) for r in rel.fetchall()), key=repr)
    assert s_rows == o_rows
