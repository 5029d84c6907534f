"""Token alignment against both libraries on whole texts and a plain two-pointer walk."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerlake.llm import alignment
from ledgerlake.llm.alignment import align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(texts):
    ta, tb = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    back = {v: k for k, v in json.load(open(A))["model"]["vocab"].items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    bytes_b = lambda k: bytes([int(tb.id_to_piece(k)[3:5], 16)]) if tb.is_byte(k) else tb.id_to_piece(k).replace("▁", " ").encode()
    rows, docs = [], Counter()
    for t in texts:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t, num_threads=1) if t else []
        xa, xb = [bytes(letters[c] for c in back[k]) for k in a], [bytes_b(k) for k in b]
        want = b" " + (t or "").encode()
        if not t or b"".join(xa) != want or b"".join(xb) != want:
            rows.append((0, 0, 0, [], ""))
            continue
        sa = [sum(map(len, xa[:i])) for i in range(len(a) + 1)] if len(a) < 2000 else None
        if sa is None:
            sa, s = [0], 0
            for x in xa:
                s += len(x)
                sa.append(s)
        sb, s = [0], 0
        for x in xb:
            s += len(x)
            sb.append(s)
        i = j = 0
        links, groups, ga, gb = [], [], [], []
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            ga.append(a[i]) if not ga or ga[-1][0] != i else None
            ga[-1] = (i, a[i])
            gb.append(b[j]) if not gb or gb[-1][0] != j else None
            gb[-1] = (j, b[j])
            ea, eb = sa[i + 1], sb[j + 1]
            i, j = i + (ea <= eb), j + (eb <= ea)
            if ea == eb:
                groups.append(",".join(str(k) for _, k in ga) + "|" + ",".join(str(k) for _, k in gb))
                ga, gb = [], []
        docs.update(set(links))
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    return [(na, nb, ng, len(li), sum(docs[x] == best[x[0]] for x in li), sum(docs[x] for x in li), h) for na, nb, ng, li, h in rows]


R = random.Random(3)
BITS = ["a", "B", " ", " ", "\n", "é", "ß", "1", "中", "  ", "'s", "\x00", "\t", "\xa0", "=", "th", "ing", "😀", "<s>", "Σ", "<|endoftext|>", "½", ".", "\r\n", ");", "nation", "<0x41>", "　", "\x85"]
TEXTS = [None, "", " ", "  ", "\n", "the end", "a ▁ b", "a" * 3000, "the end", "The House of the nation's largest words\nand so. On, it went"] + ["".join(R.choices(BITS, k=R.randint(0, 80))) for _ in range(200)]


def same(spark, texts):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, row int").repartition(4)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in align(df, A, B).collect()}
    want = brute(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i])


@pytest.mark.parametrize("rare", [1000, 1])
def test_odd_texts(spark, monkeypatch, rare):
    """With RARE 1 only pairs that all documents hold are frequent: the join does the rest."""
    monkeypatch.setattr(alignment, "RARE", rare)
    same(spark, TEXTS)


def test_documents(spark):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    same(spark, texts[:120])


def test_edges(spark):
    df = spark.createDataFrame([(None, "the end"), (5, "the end"), (5, "the end"), (6, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_a, r.n_links, r.n_best, r.count_sum) for r in align(df, A, B).collect())
    assert got == [(0, 2, 2, 2, 6), (5, 2, 2, 2, 6), (5, 2, 2, 2, 6), (6, 0, 0, 0, 0)]
    assert align(df.limit(0), A, B).count() == 0


def test_known_chunks_start_anew(spark, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN", 20)
    al = alignment.Aligner(A, B)
    texts = [t for t in TEXTS if t]
    want = brute(texts)
    import numpy as np

    for _ in range(2):
        for t, w in zip(texts, want, strict=True):
            data = np.frombuffer(t.encode(), np.uint8)
            numbers, counts, fine = al.texts(data, np.array([0, len(data)]))
            assert fine[0] == bool(w[0]) and (not fine[0] or al.chunks.sizes.data[numbers, :4].sum(axis=0).tolist() == list(w[:4]))
