import numpy as np
import pytest

from ledgerlake.llm.embedding_dedup import near_vectors, plan, same_step


def brute(rows, share=0.9):
    ids, vecs = [], []
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ids.append(i)
            vecs.append(np.array(v, float) / np.linalg.norm(v))
    x = np.array(vecs)
    near = x @ x.T >= share
    root = {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = {i: 0 for i, _ in rows}
    for a, i in enumerate(ids):
        links[i] = int(near[a].sum()) - 1
        for b in np.flatnonzero(near[a]):
            p, q = find(i), find(ids[b])
            root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i, _ in rows}, near


@pytest.mark.parametrize("block", [512, 5])
def test_against_all_pairs(spark, block):
    r = np.random.default_rng(5)
    rows = []
    base = r.standard_normal((60, 32))
    for i in range(900):
        v = base[r.integers(60)] + r.standard_normal(32) * r.choice([0, 0.05, 0.2, 0.33, 0.45])
        rows.append((int(i * 3 + 1), [float(x) for x in v.astype(np.float32)]))
    rows += [(5000, rows[0][1]), (2, rows[0][1]), (5001, [0.0] * 32), (5002, None), (5003, [float("nan")] * 32), (5004, [None, *rows[0][1][1:]]), (5005, []), (5006, [float("inf"), *rows[1][1][1:]])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string").repartition(4)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in near_vectors(df, block=block).collect()}
    want, near = brute(rows)
    assert len(got) == len(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)
    assert all(got[i][:2] == (0, i) for i in range(5001, 5007)) and got[2][0] >= 2
    assert all(k == (c == i) for i, (_, c, k) in got.items())


def test_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((x.vec_id or 0, x.n_links, x.component_id) for x in near_vectors(df).collect())
    assert got == [(0, 0, None), (1, 2, 1), (1, 2, 1), (3, 2, 1), (4, 0, 4)]
    assert near_vectors(df.limit(0)).count() == 0
    k, tables = plan(10**6, 0.9, 2.5, 0.98)
    assert (1 - same_step(np.sqrt(0.2), 2.5) ** k) ** tables <= 0.02
