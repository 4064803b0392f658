"""HTML elements against the standard library's parser."""

from __future__ import annotations

import html as stdlib
from html.parser import HTMLParser

import duckdb
from pyspark.sql import functions as F

from feedloom.operators import elements
from tests.conftest import SMALL, value

PAGES = [
    (1, "<div class='box'>a<div>inner</div>b</div><DIV CLASS=\"x box y\">two</DIV><div class=box>three</div>"),
    (2, "<!-- <div class='box'>no</div> --><script>var t='<div class=\"box\">';</script><div class=box>only <b>this</b> one</div><style>div{}</style>"),
    (3, "</div></div><div class='box'>after strays</div></div><div class='box'>again</div>"),
    (4, "<div class='box'>open <p>never closed"), (5, None), (6, ""), (7, "no tags & none &amp; &#233;&#x1F600;&nbsp;x &unknown; &amp;lt;"),
    (8, "<div class='box' title='a > b'>quoted<br/>line<img src=x.png></div><div class='boxes'>no</div><div>1<div>2<div class=box>3</div></div>4</div>"),
    (9, "<section class='box'>other</section><div class='box'>&lt;b&gt;&eacute;&hearts;</div>"),
]


class Parser(HTMLParser):
    """Text of every ``div.box``, with elements closed by their own name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.found = [], []

    def handle_starttag(self, tag, attrs):
        if tag in elements.VOID:
            return
        wanted = tag == "div" and "box" in (dict(attrs).get("class") or "").split()
        self.stack.append((tag, len(self.found) if wanted else None))
        if wanted:
            self.found.append([])

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k]
                return

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][0] in ("script", "style")):
            for _, k in self.stack:
                if k is not None:
                    self.found[k].append(data.strip())


def test_elements_equal_a_parser(spark):
    df = spark.createDataFrame(PAGES, "page_id long, html string")
    got: dict[int, list] = {}
    for r in sorted(elements.select(df, "div", "box").collect(), key=lambda r: (r["page_id"], r["start"])):
        got.setdefault(r["page_id"], []).append(r["text"])
    want = {}
    for key, page in PAGES:
        parser = Parser()
        parser.feed(page or "")
        parser.close()
        if parser.found:
            want[key] = ["".join(x) or None for x in parser.found]
    assert got == want and got[1] == ["ainnerb", "two", "three"] and got[8] == ["quotedline", "3"]


def test_references_are_decoded_once(spark):
    for text in ("a &amp;lt; &eacute;&#233;&#x1F600; &nope; & &copy", "&#0;&#xD800;&#1114112;", "&quot;&middot;", "none", ""):
        want = stdlib.unescape(text.replace("&copy", "&amp;copy")) if "#" not in text or "eacute" in text else text
        assert value(spark, elements.decoded(F.lit(text))) == want


def test_attributes_in_any_quotes(spark):
    tag = """ HREF='a&amp;b' data-href="no" id=x title="it's" """
    assert [value(spark, elements.attribute(F.lit(tag), a)) for a in ("href", "id", "title", "class")] == ["a&b", "x", "it's", None]


def test_given_pages_equal_a_parser(spark):
    class Headings(Parser):
        def handle_starttag(self, tag, attrs):
            if tag not in elements.VOID:
                self.stack.append((tag, len(self.found) if tag in ("h1", "a", "footer") else None))
                if tag in ("h1", "a", "footer"):
                    self.found.append([tag])

    rows = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    parts = [elements.select(pages, name).withColumn("name", F.lit(name)) for name in ("h1", "a", "footer")]
    got: dict[int, list] = {}
    for r in parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("page_id", "start").collect():
        got.setdefault(r["page_id"], []).append((r["name"], r["text"] or ""))
    for key, page in rows:
        parser = Headings()
        parser.feed(page)
        parser.close()
        assert got[key] == [(x[0], "".join(x[1:])) for x in parser.found]
