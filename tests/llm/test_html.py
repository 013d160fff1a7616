import re
from html.parser import HTMLParser

import pytest

from tidemark.llm.html_text import extracted_rows, visible_text

from .conftest import SF

CASES = [
    ("<p>a<p>b  c<br>d</p>x<div>y</div>z", "a\n\nb c\nd\n\nx\ny\nz"),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>after", "- one\n- two\n  - in\n- three\n\nafter"),
    ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<ul><li>a<br>b<li>c</ul>", "- a\n  b\n- c"),
    ("<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>apple<td>12<tr><td colspan=2>wide cell here<tr><td>x<br>y<td>1</table>tail",
     "Cap\n\nName   N\napple  12\nwide cell here\nx      1\ny\n\ntail"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>z</table>", "a        z\nin  ner"),
    ("<div style='display:none'>no</div>a<span hidden>no</span> b<script>if(a<b)</script><style>p{}</style>c", "a bc"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b></div>", "yes"),
    ("<details><summary>S</summary>body</details><details open><summary>T</summary>body</details>", "S\nT\nbody"),
    ("<select><option>a<option selected>b</select>", "b"),
    ("<pre> keep\n  this </pre>d", " keep\n  this\n\nd"),
    ("a &amp; b &lt; c < d <e", "a & b < c < d"),
    ("<!-- x", ""), ("", ""), ("<<<<<", "<<<<<"), ("<li>x<li>y", "- x\n- y"), ("<p>a</div>b</span>c", "abc"),
    ("<b>bold</b><i>it</i> <a href='x'>l</a>,", "boldit l,"), ("<h1>T</h1><p>a</p><p>b</p>", "T\n\na\n\nb"),
    ("<head><title>t</title><meta><body>x", "x"), ("<p title='a>b'>c", "c"), ("<td>loose", "loose"),
    ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\nb\nc\nd"), ("&nbsp;x&copy;", "x©"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_layout(page, text):
    assert visible_text(page) == text


def test_odd_pages_end_in_time():
    assert visible_text("<div>" * 50_000 + "deep") == "deep"
    assert visible_text("<a \"" * 20_001 + ">x") == "x"
    assert visible_text("<b>x</b> " * 50_000).count("x") == 50_000
    assert visible_text("<p>" * 100_000) == "" and visible_text("</p>" * 100_000) == ""


class _Words(HTMLParser):
    """Words of all visible text nodes, by another parser."""

    def __init__(self):
        super().__init__()
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.out += data.split()


def test_no_visible_word_is_lost(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extracted_rows(pages).collect():
        other = _Words()
        other.feed(html[r["page_id"]])
        got = re.sub(r"(?m)^- ", "", r["text"]).split()
        assert "".join(got) == "".join(other.out)
        assert r["n_chars"] == len(r["text"]) and r["n_lines"] == len(r["text"].split("\n"))


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, "<p>x", "b"), (2, "", "c"), (2, "", "c"), (3, "<p>y " * 50_000, "d")],
                               "page_id long, html string, text string")
    rows = sorted(map(tuple, extracted_rows(df).filter("page_id is null or page_id < 3").collect()), key=repr)
    assert rows == sorted([(1, None, 0, 0), (None, "x", 1, 1), (2, "", 0, 0), (2, "", 0, 0)], key=repr)
    assert extracted_rows(df).count() == 5 and extracted_rows(df.filter("1 = 0")).collect() == []


@pytest.mark.parametrize("page, text", [
    ("<p title=don't>visible one</p><p>it's here</p>", "visible one\n\nit's here"),
    ("""<p title = "a>b" x='c>d' y=e"f>g</p>h"i""", 'g\n\nh"i'),
    ("İ<SCRIPT>a</SCRIPT>b<STYLE>c</STYLE>d", "İbd"),
])
def test_quotes_in_tags_and_raw_ends_keep_visible_text(page, text):
    assert visible_text(page) == text
