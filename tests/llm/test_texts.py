"""Byte-level BPE, packing, languages, HTML, personal data and quality against libraries, brute force and planted cases."""

import base64
import random

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlake.llm import byte_bpe, html_extract, language_id, packing, pii, quality

R = random.Random(1)
BITS = ["a", "B", " ", " ", "\n", "é", "ß", "1", "中", "  ", "'s", "\x00", "\x1c", "\xa0", "=", "th", "ing", "😀", "İ", "Σ", "<|endoftext|>", "½", "."]
TEXTS = [None, "", " ", "the end", "a" * 3000] + ["".join(R.choices(BITS, k=R.randint(0, 120))) for _ in range(150)]
DOCS = [(i, t, f"s{i % 3}" if i % 7 else None, "clash") for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, source string, ids string").repartition(3)


def test_byte_bpe(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path).collect()}
    for i, t in enumerate(TEXTS):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == lib.encode_ordinary(t or "") and bytes(got[i].data) == (t or "").encode()
    m = byte_bpe.encoder(path, P.PATTERN).merges
    p = byte_bpe.Prefixes(m, b"the longest words of all")
    p.edit(4, 9, b"new ")
    p.append(b" end")
    assert p.last == byte_bpe.Prefixes(m, b"the new st words of all end").last


@pytest.mark.parametrize("weights", [None, {"s1": 0.6, "s2": 0.2}, {"s1": 0, "s2": 1}])
def test_packing(docs, weights):
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    want = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(TEXTS)}
    rows = packing.pack(packing.tokenize(docs, path, 2), window=64, chunk=16, bucket_tokens=500, weights=weights).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    got, at = {i: {} for i in want}, 0
    for r in rows:
        assert r.sequence_id * 64 + r.offset == at and r.offset + r.length <= 64 and r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
        at += r.length
    assert {i: [k for s in sorted(p) for k in p[s]] for i, p in got.items()} == want
    assert packing.pack(packing.tokenize(docs.limit(0), path, 2)).count() == 0


@pytest.mark.parametrize(("weights", "bucket"), [(None, 1 << 20), (None, 30_000), ({"a": 0.5, "b": 0.3}, 30_000)])
def test_mixture_of_windows(spark, weights, bucket):
    r = random.Random(4)
    shares = {"a": 0.34, **{f"q{i}": 0.03 for i in range(20)}, "b": 0.06}
    rows, doc = [], 0
    for s, share in shares.items():
        left = int(share * 200_000)
        while left > 0:
            n = min(left, r.choice([1, 20, 300, 5000]))
            rows.append((doc, s, n, b"\1\0" * n))
            doc, left = doc + 1, left - n
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, source string, n long, tokens binary"), weights=weights, bucket_tokens=bucket).toPandas()
    total = got.groupby("source").length.sum()
    assert got.length.sum() == sum(x[2] for x in rows)
    held = got.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0).iloc[:-1]
    if weights is None:
        want = total / total.sum() * 4096
        chunk = pd.Series({s: packing.chunks([w, 4096 - w], 4096)[0] for s, w in want.items()})
        assert ((held - want).abs() <= (2 if bucket > 1 << 16 else 3) * chunk + 1).all().all()  # a bucket of seven windows starts within one
    else:  # until a source runs dry: weights are shares of all tokens
        part = held.iloc[:10].mean() / 4096
        rest = 1 - total[["a", "b"]].sum() / total.sum()
        assert all(abs(part[k] - weights[k] / (0.8 + rest)) < 0.06 for k in weights)  # the small queues lag by a chunk each


def test_languages(spark):
    words = {"en": ["the", "and", "house", "with", "thing"], "de": ["und", "der", "nicht", "schön", "über"]}
    r = random.Random(2)
    text = lambda x, k=30: " ".join(r.choices(words[x], k=k))
    rows = [(i, text(x), x) for i in range(40) for x in words] + [(100, None, "en"), (101, "12 !?", "de"), (102, text("en", 20) + " " + text("de", 5), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(df, language_id.train(df)).collect()
    assert len(got) == len(rows)
    for (i, t, lang), g in zip(sorted(rows, key=str), sorted(got, key=lambda g: str(next(x for x in rows if x[0] == g.doc_id)))):
        assert 0 <= g.score <= 1
    by = {g.doc_id: g for g in got}
    assert by[100].lang_pred == by[101].lang_pred == "und" and by[102].lang_pred == "en" and 0.6 < by[102].score < 0.95
    assert sum(g.lang_pred == "de" for g in got) == 40
    assert language_id.predict(df, language_id.train(df.limit(0))).filter("lang_pred <> 'und'").count() == 0


def test_html(spark):
    page = '<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>First   <b>bold</b>\n text.<br><p>Second &copy; one.</article><footer>&copy; 2020 x</footer>'
    rows = [(1, "u", page), (2, "v", None), (3, None, ""), (None, "w", "<p>"), (1, "u", page)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(g.text for g in got) == ["", "", "", "A & B\n\nFirst bold text.\n\nSecond © one.", "A & B\n\nFirst bold text.\n\nSecond © one."]
    crf, right, total = html_extract.trained(), 0, 0
    for html, labels in html_extract.training_pages(60, seed=77):
        found = html_extract.features(html_extract.leaf_blocks(html))
        numbers = [crf.numbers(f) for f in found]
        y = crf.decode(crf.emissions(np.array([k for n in numbers for k in n]), np.array([len(n) for n in numbers])), np.array([len(found)]))
        right, total = right + int((y == np.array(labels)).sum()), total + len(labels)
    assert right >= 0.98 * total


def test_pii(spark):
    t = 'é x.y@a.example.com 10.0.0.300 1.2.3.4 and 4111-1111-1111-1111 or 4111111111111112 or +1 (743) 555-3824 token = "' + "0a1b2c3d" * 5 + '" end'
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame([(1, t), (2, None), (3, "")], "doc_id long, text string")).collect()}
    kinds = [s.split(":") for s in got[1].base.split(",")]
    assert [(k, t[int(a) : int(b)]) for k, a, b in kinds] == [("email", "x.y@a.example.com"), ("ip", "1.2.3.4"), ("card", "4111-1111-1111-1111"), ("phone", "+1 (743) 555-3824")]
    k, a, b = got[1].spans.split(",")[-1].split(":")
    assert k == "secret" and t[int(a) : int(b)] == "0a1b2c3d" * 5
    assert got[2].spans == got[3].base == ""


def test_quality_reads_long_texts_from_all_over(spark):
    edge = quality.STRETCHES * quality.SAMPLE_BYTES
    text = "".join(f"{i:08d}" for i in range(50_000))
    df = spark.createDataFrame([(1, "a" * edge), (2, "a" * (edge + 1)), (3, text), (4, "")], "doc_id long, t string").selectExpr("doc_id", "cast(t as binary) t")
    got = {r.doc_id: bytes(r.t) for r in df.select("doc_id", quality.stretches(df.t, df.doc_id).alias("t")).collect()}
    assert got[1] == b"a" * edge and got[2] == b"a" * edge and got[4] == b""
    part = [text.index(got[3][i : i + quality.SAMPLE_BYTES].decode()) for i in range(0, edge, quality.SAMPLE_BYTES)]
    assert len(got[3]) == edge and part == sorted(part) and part[0] < len(text) / 16 and part[-1] > len(text) * 0.9 - quality.SAMPLE_BYTES


def test_quality():
    r = random.Random(3)
    prose = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(r.randint(5, 80)))
    good, bad = [prose() for _ in range(150)], [prose().replace(" ", "$$$ ") for _ in range(150)]
    net = quality.Network().fit([x.encode() for x in good + bad], np.array([1.0] * 150 + [0.0] * 150, np.float32))
    fresh = [prose() for _ in range(50)] + [prose().replace(" ", "$$$ ") for _ in range(50)] + [""]
    data = b"".join(x.encode() for x in fresh)
    edges = np.cumsum([0] + [len(x.encode()) for x in fresh])
    s = net.scores(np.frombuffer(data, np.uint8), edges)
    assert (s[:50] > 0.5).mean() > 0.95 and (s[50:100] < 0.5).mean() > 0.95 and 0 <= s[100] <= 1
    alone = [net.scores(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0] for x in fresh[:100]]
    assert np.allclose(alone, s[:100], atol=1e-5)
