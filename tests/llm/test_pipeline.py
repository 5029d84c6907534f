import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerlake.llm import pii
from ledgerlake.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_suffix_dedup import brute as repeats


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name.split()[0]}")
        out.append(docs)
    return out


def test_stages_against_brute_force(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[1:-1])
    docs, good, single, cut, clean, pieces = ([r.asDict() for r in s.collect()] for s in stages)
    assert 0 < len(good) < len(docs)
    root = groups([(d["doc_id"], d["text"]) for d in good])
    assert sorted(d["doc_id"] for d in single) == sorted(i for i, (_, r) in root.items() if r == i)
    left = repeats([(d["doc_id"], (d["text"] or "").encode()) for d in single], 100)
    assert {d["doc_id"]: d["text"] for d in cut} == {i: k.decode("utf-8", "ignore") for i, (_, _, k) in left.items()}
    assert all(d["n_chars"] == len(d["text"]) for d in cut)
    before = {d["doc_id"]: d for d in cut}
    for d in clean:
        old = before[d["doc_id"]]
        assert not pii.base_spans(d["text"])
        assert (d["text"] == old["text"]) == (not pii.find_in(pii.Tagger(pii.trained()), *_bytes(old["text"]))[0][1]) if re.search("[0-9@=]", old["text"]) else d["text"] == old["text"]
    whole = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert whole.get(p["doc_id"], 0) == p["start"] and len(p["ids"]) == 4 * p["length"]
        whole[p["doc_id"]] = p["start"] + p["length"]
    assert sorted(whole) == sorted(d["doc_id"] for d in clean)
    at = np.sort([p["sequence_id"] * 4096 + p["offset"] for p in pieces])
    assert at[0] == 0 and at[-1] < sum(p["length"] for p in pieces)


def _bytes(text):
    data = text.encode()
    return np.frombuffer(data, np.uint8), np.array([0, len(data)])


def test_odd_rows_go_through(spark):
    rows = [(None, "some words of a text here", "en", "a", 1), (None, None, None, None, None), (3, "", "en", "a", 0), (3, "x y z " * 60, "en", "b", 5), (3, "x y z " * 60, "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() == 4
    assert corpus_pipeline.packed(spark, docs, SF_SMALL).count() >= 4
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_clashing_columns_stay(spark):
    """Columns named like the stages' own keep their values."""
    rows = [(i, "x y z " * 60 if i > 2 else f"text number {i} of all that there are", "en", "a", 1, i * 10, "keep", 7, 8.0) for i in range(1, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ledger_key__ long, NULL__ string, th2 int, new_text__ double")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == names
    got = sorted(tuple(r)[5:] for r in docs.collect())
    assert got == [(10, "keep", 7, 8.0), (20, "keep", 7, 8.0), (30, "keep", 7, 8.0)]
    twice = docs.union(docs)  # ids that repeat
    for _, stage in corpus_pipeline.STAGES[1:3]:
        assert sorted({tuple(r)[5:] for r in stage(spark, twice, SF_SMALL).collect()}) == got


def test_mask():
    crf = pii.trained()
    texts = ["mail a.b@c.example.com now", None, "", 'token = "0123456789abcdef0123456789abcdef01234567" x', "10.0.0.1 and 4111 1111 1111 1111"]
    got = pii.masked(pa.array(texts), crf)
    assert got == ["mail <email> now", None, "", 'token = "<secret>" x', "<ip> and <card>"]
