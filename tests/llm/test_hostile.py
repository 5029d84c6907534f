"""Texts and pages made to be slow: a megabyte of each within seconds; patterns against plain second implementations."""

import random
import time

import pyarrow as pa
import pytest

from ledgerlake.llm import html_extract, pii

MB = 1_000_000


@pytest.fixture(scope="module")
def field():
    return pii.trained()


@pytest.fixture(scope="module")
def blocks_field():
    return html_extract.trained()


def second(text):
    """The base patterns by the plain regular expressions, one after the other."""
    out = []
    for kind, pattern in pii.PATTERNS.items():
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            fine = {
                "email": lambda: True,
                "ip": lambda m=m: all((p.lstrip("0") or "0") in {str(k) for k in range(256)} for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0,
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if fine:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(pii.PATTERNS).index(s[2])))


def test_base_spans_against_the_plain_patterns():
    r = random.Random(4)
    bits = [*"ab1.@-_%+ 9(", "1.2.3.4", "a@b.c", "+1 234567890", "4111 1111 1111 1111", "0255", "256"]
    found = 0
    for _ in range(20000):
        text = "".join(r.choices(bits, k=r.randint(1, 25)))
        want = second(text)
        assert pii.base_spans(text) == want
        found += len(want)
    assert found > 2000


TEXTS = {
    "zeros": "1.2.3." + "0" * MB, "figures": "7" * MB, "letters": "a" * MB + "@", "at": "@" * MB, "short mails": "a@" * (MB // 2), "key": "0f" * (MB // 2),
    "signs": "a" + "!" * MB + "b", "dots": "1." * (MB // 2), "mixed": "ab9" * (MB // 3), "bracketed": "x[at]" * (MB // 5), "spaces": "+1" + " " * MB, "colons": "1:" * (MB // 2), "name": "Mr. " + "A" * MB,
}


@pytest.mark.parametrize("name", list(TEXTS))
def test_long_texts(field, name):
    began = time.time()
    out = pii.masked(pa.array([TEXTS[name]]), field)
    assert time.time() - began < 15 and out[0]


PAGES = {
    "open tags": "<a " * (MB // 3), "long name": "<" + "a" * MB, "open quotes": '<a "' * (MB // 4 + 1) + ">", "far quote": "<a <b " * (MB // 10) + "\">'", "open comments": "<!--" * (MB // 4),
    "ends above": "<i><div>" + "<b>" * (MB // 10) + "</i>" * (MB // 10), "items": "<span>" * (MB // 20) + "<li></li>" * (MB // 20), "heads": "<head><body>" * (MB // 15) + "x",
    "references": "&#" + "9" * 10000 + "; &#" + "0" * 9000 + "65; x", "signs": "&" * MB, "nested": "<div>x" * 30000, "marks": "".join(f'<div class="c{"abcdefghij"[i % 10] * (i % 50)}q">x' for i in range(20000)),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_long_pages(blocks_field, name):
    began = time.time()
    out = html_extract.main_texts(blocks_field, [PAGES[name], "<p>The end of it all.</p>"])
    assert time.time() - began < 20 and len(out) == 2


def test_tokens_of_odd_markup():
    got = [(t, n, c, a) for t, n, c, a in html_extract.Tokens("a<b c='>'>d</b>< e<!-- x --><!y><br/>&lt;<p")]
    assert got == [("a", None, None, None), ("", "b", False, " c='>'"), ("d", None, None, None), ("", "b", True, ""), ("<", None, None, None), (" e", None, None, None),
                   ("", "br", False, "/"), ("&lt;", None, None, None), ("", "p", False, "")]
    assert html_extract.decoded("&#65;&#x42;&amp;&#" + "0" * 30 + "67;&#" + "9" * 5000 + ";") == "AB&C�"


def test_through_spark(spark):
    docs = spark.createDataFrame([(1, "1.2.3." + "0" * 6000, "x"), (2, None, "x"), (2, "mail a.b@c.de now", "x"), (None, "", "x")], "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, r.base) for r in pii.find(docs).collect())
    assert got == [(0, ""), (1, "ip:0:6006"), (2, ""), (2, "email:5:13")]
    assert pii.find(docs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "u", "<a " * 10000, "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_extract.extract(pages).collect()) == ["", ""] and html_extract.extract(pages.limit(0)).count() == 0
