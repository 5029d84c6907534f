"""Nearest examples against all cosines, held-out accuracy, planted texts and odd input."""

import random

import numpy as np
import pytest

from ledgerlake.llm import toxicity
from ledgerlake.llm.toxicity import BlockMax, op13_toxicity, score, terms, train


def test_block_max_against_all_cosines():
    r = np.random.default_rng(1)
    size, n = 60, 700
    dense = r.random((n, size)) * (r.random((n, size)) < 0.08)
    dense[::7] = dense[0]  # ties
    dense[:, -1] = r.random(n) + 0.1
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    rows, ids = np.nonzero(dense)
    index = BlockMax(np.bincount(rows, minlength=n), ids, dense[rows, ids], size, block=16)
    count = r.integers(1, 4, n)
    for _ in range(150):
        q = r.random(size) * (r.random(size) < 0.1)
        q[-1] = r.choice([0, 0.5])
        if not q.any():
            continue
        q /= np.linalg.norm(q)
        got, cosine = index.nearest(np.flatnonzero(q), q[q > 0], count, 9)
        want = dense @ q
        order = np.argsort(-want, kind="stable")
        enough = min(np.searchsorted(np.cumsum(count[order]), 9), n - 1)
        least = want[order[enough]]
        # entries within rounding of the last one may or may not be in
        assert set(np.flatnonzero(want > max(least, 0) + 1e-9)) <= set(got.tolist()) <= set(np.flatnonzero(want >= least - 1e-9))
        assert np.abs(want[got] - cosine).max(initial=0) < 1e-12


def test_terms():
    assert terms("idiot") == ["idiot", "idio*"]
    assert terms("Worthlessness".lower())[1:] == ["wort*", "worth*", "worthl*", "worthle*"]
    assert terms("ab") == ["ab"]


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(5)
    plain = [f"w{c}{d}" for c in "aeiou" for d in "bdfgklmnprst"]
    text = lambda bad: " ".join(r.choice(["vilewordus", "vilewords", "Nastyish"]) if r.random() < bad else r.choice(plain) for _ in range(r.randint(20, 200))) + " vilewordus nastyish" * (bad > 0)
    rows = [(i, text(0.1 if i % 5 == 0 else 0), "clash") for i in range(600)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "12 !?", "x"), (1003, text(0.1), "x"), (1003, text(0), "x"), (1004, text(0) * 300, "x"), (None, text(0.1), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(401, None), (None, 1)], "doc_id long, toxic int")
    return docs, labels


def test_planted(planted):
    docs, labels = planted
    model = train(docs, labels)
    got = {}
    for x in score(docs, model).collect():
        got.setdefault(x.doc_id, []).append(x)
    assert all((got[i][0].score >= 0.3) == (i % 5 == 0) for i in range(600))
    assert sorted(x.score >= 0.3 for x in got[1003]) == [False, True] and got[1004][0].score < 0.3 and got[None][0].score >= 0.3
    assert all(got[i][0].score < 0.3 for i in (1000, 1001, 1002))
    for i in (0, 1):  # the score follows from its evidence
        n = t = toxicity.PULL
        t *= model.base
        for e in got[i][0].evidence:
            w = toxicity.NEAR / (toxicity.NEAR + 1 - e.cosine)
            n, t = n + w * e.examples, t + w * e.toxic
        assert got[i][0].score == pytest.approx(t / n)


def test_edges(planted):
    docs, labels = planted
    assert score(docs.limit(0), train(docs, labels)).count() == 0
    assert {x.score for x in score(docs, train(docs, labels.limit(0))).collect()} == {0.0}
    only_clean = train(docs, labels.filter("toxic = 0"))
    assert max(x.score for x in score(docs, only_clean).collect()) < 0.3


def test_held_out(spark):
    out = op13_toxicity(spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(x.predicted == x.toxic for x in rows) / len(rows)
    false = sum(x.predicted and not x.toxic for x in rows) / sum(not x.toxic for x in rows)
    assert right > 0.98 and false < 0.01
