"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A leaf block is a run of text with no block boundary inside. Each has features of its ancestors (tags,
words of class, id and role) and of its text; the field labels the blocks of a page as article or
not, and Viterbi finds the best labels. It is trained on labelled pages that training_pages() makes
by rule in many layouts.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import blocks, map_arrow, strings
from ledgerlake.llm.crf import Crf

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template iframe object svg math canvas head title select datalist audio video".split())
RAW = ("script", "style", "title", "textarea", "iframe", "noscript", "xmp")
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img button output".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"tbody"}}
STOPS = set("table ul ol dl article section div main body aside nav form".split())
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile("[>\"']")
LONG_REF = re.compile(r"&#([0-9]{20,});?")
ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAMES = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An open element: what features its subtree has from it and from the elements around it, shared where nothing is new."""

    __slots__ = ("inner", "marks", "name", "tags", "up")

    def __init__(self, name: str, marks: tuple[str, ...], above: Node | None, known):
        self.name, self.marks = name, marks
        new = {w for w in (f"up:{name}", *marks) if (known is None or w in known) and w not in ("up:html", "up:body")}
        self.up = above.up if above and new <= above.up else (above.up if above else frozenset()) | new
        self.tags = above.tags if above and name in above.tags else (above.tags if above else frozenset()) | ({name} & {"button", "form"})
        self.inner = name if name not in INLINE else above.inner if above else "none"


class Block:
    __slots__ = ("linked", "node", "parts", "whole")

    def __init__(self, node: Node | None):
        self.node, self.parts, self.linked, self.whole = node, [], 0, None

    def text(self) -> str:
        """The block's text; asked for once all parts are in."""
        if self.whole is None:
            self.whole = " ".join(decoded("".join(self.parts)).split())
        return self.whole


def decoded(text: str) -> str:
    """Character references decoded; those of very many figures too."""
    return html.unescape(LONG_REF.sub(lambda m: f"&#{m[1].lstrip('0')[:8] or '0'};", text))


def _marks(attrs: str) -> tuple[str, ...]:
    out = []
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role", "itemprop"):
            out += [f"in:{w}" for w in NAMES.findall(value)]
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            out.append("hidden")
    return tuple(out)


class Tokens:
    """The page's tags and texts in time that grows with its length, whatever is left open.

    Where a name ends and where the next ">" or quote stands is kept until the place is passed; a quote from which no
    tag closes is remembered, so that no later tag reads on from it.
    """

    def __init__(self, page: str):
        self.page, self.lost = page, set()
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.seen = {NAME_END: (1, 0), SPECIAL: (1, 0)}

    def _next(self, pattern: re.Pattern, pos: int) -> int:
        """The first place of the pattern from ``pos`` on, or the page's length."""
        a, b = self.seen[pattern]
        if not a <= pos <= b:
            m = pattern.search(self.page, pos)
            self.seen[pattern] = (pos, m.start() if m else len(self.page))
        return self.seen[pattern][1]

    def _close(self, pos: int) -> int:
        """Where the tag that is open at ``pos`` closes; -1 if it does not. What stands in quotes closes nothing."""
        page, track = self.page, []
        while pos <= self.last[">"]:
            at = self._next(SPECIAL, pos)
            if at >= len(page) or at in self.lost:
                break
            if page[at] == ">":
                return at
            track.append(at)
            if at >= self.last[page[at]]:
                break
            pos = page.find(page[at], at + 1) + 1
        self.lost.update(track)
        return -1

    def __iter__(self):
        """(text, None, None, None) or ("", name, whether it closes, attributes); comments and declarations are left out.

        A name sent back in is raw: nothing is markup before its closing tag.
        """
        page, pos = self.page, 0
        while pos < len(page):
            at = page.find("<", pos)
            if at != pos:
                at = len(page) if at < 0 else at
                yield page[pos:at], None, None, None
                pos = at
                continue
            if page.startswith("<!--", pos):
                end = page.find("-->", pos + 4)
                pos = len(page) if end < 0 else end + 3
                continue
            if page[pos + 1 : pos + 2] in ("!", "?") and pos + 1 < len(page):
                end = page.find(">", pos)
                pos = len(page) if end < 0 else end + 1
                continue
            closing = page.startswith("/", pos + 1)
            first = pos + 1 + closing
            if not (page[first : first + 1].isascii() and page[first : first + 1].isalpha()):
                yield "<", None, None, None
                pos += 1
                continue
            name_end = self._next(NAME_END, first)
            close = self._close(name_end)
            if close < 0 and self.last["<"] >= name_end:  # left open, and more markup follows: a sign
                yield "<", None, None, None
                pos += 1
                continue
            close = len(page) if close < 0 else close
            pos = min(close + 1, len(page))
            name = page[first:name_end].lower()
            raw = yield "", name, closing, page[name_end:close]
            if raw:
                m = re.compile(f"</{re.escape(raw)}", re.I | re.A).search(page, pos)
                pos = m.start() if m else len(page)


def leaf_blocks(page: str, known=None) -> list[Block]:
    """The page's runs of text between block boundaries; a stack of open elements stands for the DOM.

    With ``known`` only its features are kept of the elements, so that memory is bounded however deep and marked the page is.
    """
    stack: list[Node] = []
    where: dict[str, list[int]] = {}  # places of each name in the stack
    blocky: list[int] = []  # places of those that bound blocks
    quiet = 0  # silent ones
    out: list[Block] = []
    block: Block | None = None

    def push(name: str, marks: tuple[str, ...]) -> None:
        nonlocal quiet
        where.setdefault(name, []).append(len(stack))
        if name not in INLINE:
            blocky.append(len(stack))
        quiet += name in SILENT
        stack.append(Node(name, marks, stack[-1] if stack else None, known))

    def cut(at: int) -> list[Node]:
        nonlocal quiet
        gone = stack[at:]
        for node in reversed(gone):
            where[node.name].pop()
            if node.name not in INLINE:
                blocky.pop()
            quiet -= node.name in SILENT
        del stack[at:]
        return gone

    last = lambda names: max((where[n][-1] for n in names if where.get(n)), default=-1)
    tokens = iter(Tokens(page))
    token = next(tokens, None)
    while token is not None:
        text, name, closing, attrs = token
        raw = None
        if name is None:
            if not quiet and (block is not None or not text.isspace()):
                if block is None:
                    block = Block(stack[-1] if stack else None)
                    out.append(block)
                block.parts.append(text)
                if where.get("a"):
                    block.linked += len(text)
        else:
            if name not in INLINE:
                block = None
            if closing:
                at = last([name])
                if at >= 0 and (name not in INLINE or not blocky or blocky[-1] < at):
                    cut(at)
            else:
                if name in ENDS_P and last("p") >= 0:
                    cut(last("p"))
                if name in SAME and last(SAME[name]) > last(STOPS):
                    cut(last(SAME[name]))
                if name == "body" and (low := min((where[n][0] for n in ("head", "title") if where.get(n)), default=-1)) >= 0:
                    for node in [x for x in cut(low) if x.name not in ("head", "title")]:
                        push(node.name, node.marks)
                if name == "br" and block is not None:
                    block.parts.append(" ")
                if not (name in VOID or attrs.rstrip().endswith("/")):
                    push(name, _marks(attrs))
                    raw = name if name in RAW else None
        try:
            token = tokens.send(raw)
        except StopIteration:
            token = None
    return [b for b in out if b.text()]


WORDS = re.compile(r"©|\b(?:cookies?|copyright|rights reserved|subscribe|newsletter|sign up|log ?in|share|comments?|repl(?:y|ies)|advert\w*|sponsored|read more|related|menu|search|privacy|terms|accept|contact)\b", re.I)


def features(found: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(found):
        text = b.text()
        own = {f"tag:{b.node.inner if b.node else 'none'}"} | (b.node.up if b.node else set())
        n = len(text)
        own.add(f"size:{min(6, n.bit_length() // 2)}")
        own.add(f"links:{min(3, 4 * b.linked // max(1, n))}")
        own.add(f"stop:{text[-1] in '.!?:;\"»”)…'}")
        own |= {f"says:{w.lower()}" for w in WORDS.findall(text[:400])} if n < 400 else set()
        own.add("first" if i == 0 else "last" if i == len(found) - 1 else "amid")
        own.add("bias")
        if b.node and b.node.tags:
            own.add("formed")
        out.append(sorted(own))
    return out


def _prose(r: random.Random, low: int, high: int, stop: str = ".") -> str:
    words = ["".join(r.choice(["an", "er", "th", "on", "ti", "es", "la", "de", "ou", "be", "sch", "ción"]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + stop


def training_pages(n: int = 400, seed: int = 5) -> list[tuple[str, list[bool]]]:
    """Pages and, for each of their leaf blocks in order, whether it belongs to the article; made by rule."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        parts: list[tuple[str, bool | None]] = []  # html and its label; None: markup only
        mark = lambda s: parts.append((s, None))
        text = lambda s, y: parts.append((s, y))

        def links(tag_open, tag_close, item, k):
            mark(tag_open)
            for _ in range(k):
                mark(f"<{item}>" if item else "")
                mark('<a href="/x">')
                text(_prose(r, 1, 3, ""), False)
                mark("</a>")
                mark(f"</{item}>" if item else "<span></span><hr>")
            mark(tag_close)

        def noise(kind):
            if kind == "nav":
                c = r.choice(["", ' class="menu"', ' id="navigation"', ' class="navbar"'])
                r.choice([lambda: links(f"<nav{c}><ul>", "</ul></nav>", "li", r.randint(2, 7)), lambda: links('<div class="menu"><ul>', "</ul></div>", "li", r.randint(2, 7)), lambda: links('<ul id="nav">', "</ul>", "li", r.randint(2, 6)), lambda: links('<div class="breadcrumbs">', "</div>", "p", 3)])()
            elif kind == "header":
                mark(r.choice(["<header>", '<div class="header">', '<div id="masthead">']))
                mark(r.choice(["<h1>", "<p>", "<div>", "<h2>"]))
                text(_prose(r, 1, 5, ""), False)
                mark("</div>")
                if r.random() < 0.5:
                    links("<ul>", "</ul>", "li", 3)
                mark("</header></div>")
            elif kind == "footer":
                mark(r.choice(["<footer>", '<div class="footer">', '<div id="footer">']))
                mark(r.choice(["<p>", "", "<div>"]))
                text(r.choice(["&copy; ", "Copyright ", ""]) + _prose(r, 3, 20) + r.choice([" All rights reserved.", " &middot; x", ""]), False)
                mark("</p>")
                if r.random() < 0.4:
                    links("<ul>", "</ul>", "li", 3)
                mark("</footer></div>")
            elif kind == "side":
                mark(r.choice(["<aside>", '<div class="sidebar">', '<div id="side-bar">', '<section class="related">', '<div class="widget">']))
                mark("<h3>")
                text(r.choice(["Related", _prose(r, 1, 4, "")]), False)
                mark("</h3>")
                if r.random() < 0.6:
                    links("<ul>", "</ul>", "li", r.randint(2, 5))
                else:
                    mark("<p>")
                    text(_prose(r, 5, 40), False)
                    mark("</p>")
                mark("</aside></section></div>")
            elif kind == "ad":
                mark(r.choice(['<div class="ad">', '<div class="ads">', '<div class="advert banner">', '<div id="ad-top">', '<div class="sponsored promo">', '<ins class="advertisement">']))
                mark(r.choice(["", "<p>"]))
                text(_prose(r, 3, 30), False)
                mark("</p></ins></div>")
            elif kind == "notice":
                mark(r.choice(['<div class="cookie notice">', '<div class="cookie-banner">', '<div id="consent">', '<div class="alert" role="alert">', '<div class="popup modal" role="dialog">', '<div class="newsletter">']))
                mark("<p>")
                text(r.choice(["We use cookies. ", "Subscribe to our newsletter. ", "", "Notice: "]) + _prose(r, 4, 30), False)
                mark("</p>")
                mark("<button>")
                text(r.choice(["Accept", "OK", "Sign up"]), False)
                mark("</button></div>")
            elif kind == "form":
                mark(r.choice(["<form>", '<form class="search">', '<form id="login">']))
                mark("<label>")
                text(r.choice(["Search", "E-mail", _prose(r, 1, 3, "")]), False)
                mark('</label><input type="text"><p>')
                text(_prose(r, 2, 12), False)
                mark("</p></form>")
            elif kind == "comments":
                mark(r.choice(['<section class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="discussion replies">']))
                mark("<h3>")
                text(r.choice(["Comments", "3 replies", _prose(r, 1, 3, "")]), False)
                mark("</h3>")
                for _ in range(r.randint(1, 4)):
                    mark(r.choice(['<div class="comment">', '<article class="comment">', '<li class="reply">']))
                    mark("<p>")
                    text(_prose(r, 4, 60), False)
                    mark("</p></article></li></div>")
                mark("</section></ol></div>")

        for kind in r.sample(["nav", "header", "ad", "notice", "form"], r.randint(1, 4)):
            noise(kind)
        open_, close = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="content" role="main">', "</div>"), ('<div class="post entry">', "</div>"), ('<section class="article-body story">', "</section>"), ("<div>", "</div>"), ("<table><tr><td>", "</td></tr></table>"), ("", "")])
        mark(open_)
        if r.random() < 0.8:
            mark(r.choice(["<h1>", "<h2>", "<header><h1>"]) if open_ else "<h1>")
            text(_prose(r, 2, 12, r.choice(["", ".", "&amp;"])), True)
            mark("</h1></h2></header>")
        for _ in range(r.randint(1, 12)):
            kind = r.random()
            if kind < 0.05:  # lines that otherwise stand in footers and notices
                mark("<p>")
                text(r.choice(["All rights reserved.", "Copyright " + _prose(r, 1, 4), "Licensed under these terms.", "Read more on this below.", _prose(r, 3, 9) + " cookies."]), True)
                mark("</p>")
            elif kind < 0.75:
                mark(r.choice(["<p>", "<p><b>", '<p class="text">']))
                text(_prose(r, 1, 90, r.choice([".", ".", "", "!", "$$$"])) + r.choice(["", "<br>"]), True)
                if r.random() < 0.2:
                    text(' <a href="/y">' + _prose(r, 1, 3, "") + "</a> " + _prose(r, 3, 20), None)
                mark(r.choice(["</p>", "</p>", ""]))
            elif kind < 0.83:
                mark(r.choice(["<h2>", "<h3>"]))
                text(_prose(r, 1, 8, ""), True)
                mark("</h2></h3>")
            elif kind < 0.9:
                mark(r.choice(["<ul>", "<ol>"]))
                for _ in range(r.randint(1, 4)):
                    mark("<li>")
                    text(_prose(r, 1, 20), True)
                    mark("</li>")
                mark("</ul></ol>")
            elif kind < 0.95:
                mark(r.choice(["<blockquote>", "<pre>", "<figure><figcaption>"]))
                text(_prose(r, 3, 30), True)
                mark("</blockquote></pre></figcaption></figure>")
            elif open_:
                noise(r.choice(["ad", "notice", "side"]))
        if r.random() < 0.15 and "article" in open_:
            noise("comments")
        mark(close)
        for kind in r.sample(["side", "comments", "ad", "nav", "form"], r.randint(0, 3)):
            noise(kind)
        if r.random() < 0.85:
            noise("footer")
        body = "".join(p for p, _ in parts)
        labels = [y for _, y in parts if y is not None]
        page = f"<!DOCTYPE html><html><head><title>{_prose(r, 2, 6, '')}</title><script>var a='</p>';</script></head><body>{body}" + r.choice(["</body></html>", ""])
        if len(leaf_blocks(page)) == len(labels):
            out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def trained() -> Crf:
    table = []
    for page, labels in training_pages():
        table.append(list(zip(features(leaf_blocks(page)), ["article" if y else "other" for y in labels], strict=True)))
    return Crf(["other", "article"]).fit(table, rounds=150)


def main_texts(crf: Crf, pages: list[str]) -> list[str]:
    """The article blocks of each page, joined by two line ends."""
    out: list[str] = []
    for a, b in blocks([len(p) for p in pages], 1_000_000):
        found = [leaf_blocks(p, crf.names) for p in pages[a:b]]
        numbers = [crf.numbers(f) for blocks_ in found for f in features(blocks_)]
        lens = np.array([len(x) for x in found], np.int64)
        counts = np.array([len(x) for x in numbers], np.int64)
        labels = crf.decode(crf.emissions(np.array([k for x in numbers for k in x], np.int64), counts), lens)
        at = 0
        for blocks_ in found:
            mine = labels[at : at + len(blocks_)]
            at += len(blocks_)
            out.append("\n\n".join(x.text() for x, y in zip(blocks_, mine, strict=True) if y))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", crf: Crf | None = None) -> DataFrame:
    """(page_id, url, text) of every row; null html is empty. Rows are independent: repeated and null ids stay as they are.

    An empty table gives an empty result, other columns are ignored. Pages of any length and nesting are read whole, in
    time and memory that grow with their length, also where tags, quotes or comments never close.
    """
    crf = crf or trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(main_texts(crf, strings(batch.column(2))), pa.string())], names=["page_id", "url", "text"])

    return map_arrow(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("h")), run, "page_id long, url string, text string")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
