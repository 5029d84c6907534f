"""The SQL of the operators against the operators on tables with the cases that the given ones lack."""

import random

import duckdb
import numpy as np
import pytest

from ledgerlake.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r, g = random.Random(8), np.random.default_rng(8)
    words = ["".join(r.choices("abcdeÉ", k=r.randint(1, 5))) for _ in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one\ttwo"), (5, "ONE TWO three four")]
    for i in range(6, 120):
        text = " ".join(r.choices(words, k=r.randint(1, 150)))
        if i % 3 == 0:  # a copy with one word changed
            old = (rows[r.randrange(len(rows))][1] or "").split()
            text = " ".join(old[:1] + ["new"] + old[2:]).upper() if i % 2 else " ".join(old)
        rows.append((i, text))
    vectors = [(i, g.standard_normal(16)) for i in range(200)]
    vectors += [(200 + i, vectors[i % 7][1] * r.uniform(0.5, 2) + 0.05 * g.standard_normal(16)) for i in range(60)]
    vectors = [(i, [float(x) for x in v]) for i, v in vectors]
    vectors += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [float("inf")] + [1.0] * 15), (304, [None] + [1.0] * 15), (305, []), (306, vectors[0][1]), (307, [1.0])]
    path = str(tmp_path_factory.mktemp("oracles"))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, tables).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    if name != "op7_suffix_dedup":
        at = want.columns.index("component_id")
        assert sum(x[at] != x[0] for x in want.fetchall()) >= 20
