from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest
from tidepanel.llm import html, queries


class Words(HTMLParser):
    """Words of all text outside of hidden elements, by the standard library's tokenizer."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style", "template", "noscript"):
            self.hidden.append(tag)
        if tag == "body":
            self.hidden.clear()

    def handle_endtag(self, tag):
        if self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_whole_table_keeps_all_visible_words(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op1_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        own = Words()
        own.feed(pages[r.page_id] or "")
        own.close()
        want = re.sub(r"\s", "", "".join(own.words))
        got = re.sub(r"\s", "", re.sub(r"(?m)^\s*- ", "", r.text))
        assert got == re.sub(r"\s", "", re.sub(r"(?m)^\s*- ", "", "".join(own.words))) or got == want
        assert r.n_lines == (r.text.count("\n") + 1 if r.text else 0)


CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
    ("<ol start=9><li>x<li>y</ol>z", "9. x\n10. y\n\nz"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<p hidden>no</p><p style='display: none'>no</p><div style='visibility:hidden'>no</div>yes<input type=hidden value=x>", "yes"),
    ("<head><title>no</title></head><body>yes<script>if (a < b) no()</script><style>no</style><!-- no --><noscript>no</noscript></body>", "yes"),
    ("<title>no</title><script>var t='</p>';</script>yes", "yes"),
    ("<details><summary>more</summary>no</details><details open><summary>s</summary>t</details>", "more\ns\nt"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("x &amp; y &lt;z&gt; &eacute;", "x & y <z> é"),
    ("<table><tr><th>name<th>n<tr><td>apple<td>1<tr><td>fig<td>22</table>", "name   n\napple  1\nfig    22"),
    ("<table><tr><td>a<td colspan=2>wide<tr><td rowspan=2>b<td>c<td>d<tr><td>e<td>f</table>", "a  wide\nb  c  d\n   e  f"),
    ("a <b>bold</b> <i>it</i>. </b></div>end", "a bold it. end"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("a < b and <unclosed", "a < b and <unclosed"),
    ("<p>x</p", "x"),
    ("<div title=\"a > b\">in</div>", "in"),
    ("x <math><mi>a</mi><mo>+</mo><mn>1</mn><annotation>no</annotation></math> y", "x a+1 y"),
    ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>left</text><text>right</text></svg>", "left\nright"),
    ("<object>stand-in</object> <video>clip</video> <audio>song</audio> <canvas>plot</canvas>", "stand-in clip song plot"),
    ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b> no<p style='VISIBILITY: Visible'>too</div>", "yes\n\ntoo"),
    ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>", "  yes"),
    ("<dialog>no</dialog><dialog open>yes</dialog><ruby>x<rp>(</rp><rt>y</rt><rp>)</rp></ruby>", "yes\nxy"),
    ("<table><tr><td colspan=5000>wide<tr><td>a<td>b</table>", "wide\na  b"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_layout(page, text):
    assert html.text_of(page).replace("</p", "") == text


def test_bounds_of_a_layout_lose_no_text():
    page = "<ul>" + "<li><b>x<table><tr><td>" * 30 + "deep" + "<td>" + "w" * 200 + "<td>end"
    words = re.findall(r"\w+", html.text_of(page))
    for layout in (html.Layout(depth=5), html.Layout(nested=0), html.Layout(padded=None), html.Layout(padded=1, span=1)):
        assert re.findall(r"\w+", html.text_of(page, layout)) == words
    row = f"<table><tr><td>{'w' * 200}<td>a<tr><td>b<td>c</table>"
    assert html.text_of(row) == "w" * 200 + "  a\nb" + " " * 201 + "c" != html.text_of(row, html.Layout(padded=60))
    assert html.text_of(row, html.Layout(blanks=300)) == "w" * 200 + "  a\nb  c"
    deep = "<table><tr><td>a<td>" * 100 + "end"
    assert html.text_of(deep) == "a  " * 100 + "end"


@pytest.mark.parametrize("quote", "'\"")
def test_attributes_of_any_length(quote):
    image = f"<p>x<img alt={quote}{'a>b' * 100_000}{quote}>y"
    assert html.text_of(image) == "xy"


SHEETS = [
    (".x{display:none}", "<p class=x>no</p><p class='y x'>no</p><p class=xx>yes</p>", "yes"),
    ("#a, p.b { visibility : hidden }", "<p id=a>no</p><div class=b>yes</div><p class=b>no</p>", "yes"),
    ("p{display:none} p.on{display:block} .on{display:none}", "<p>no<p class=on>yes<div class=on>no</div>", "yes"),
    ("p{display:none !important}", "<p style='display:block'>no<div>yes</div>", "yes"),
    ("p{display:none}", "<p style='display:block'>yes<p>no", "yes"),
    ("/* p{display:none} */ @media print { div{display:none} } @media screen{ b{display:none} } @import url(x); @font-face{display:none}", "<p>yes<div>yes <b>no</b></div>", "yes\n\nyes"),
    ("div p{display:none} a:hover{display:none} p > b{display:none}", "<div><p>yes <b>yes</b></div>", "yes yes"),
    ("*{visibility:hidden} .v{visibility:visible}", "<p>no <b class=v>yes</b>", "yes"),
    ("p{display:none", "<p>yes", "yes"),
    (".A{display:none}", "<p class=a>yes<p class=A>no", "yes"),
]


@pytest.mark.parametrize(("sheet", "page", "text"), SHEETS)
def test_style_sheets_of_the_page(sheet, page, text):
    assert html.text_of(f"<style>{sheet}</style>{page}") == text
    assert html.text_of(f"{page}</p></div><style>{sheet}</style>") == text  # wherever it stands


def test_a_very_long_page(spark):
    page = "<p>" + "some words " * 50_000 + "<ul>" + "<li>item" * 20_000 + "</ul>end"
    docs = spark.createDataFrame([(1, page, 0)], "page_id long, html string, id int")
    text = html.extracted(docs).first().text
    assert text.count("item") == 20_000 and text.count("some words") == 50_000 and text.endswith("end")


def test_hostile_pages_end():
    for page in ("<div>" * 200_000 + "x", "<b>" * 50_000 + "<p>" * 50_000 + "x", "<table>" * 3000 + "x", '<a "' * 3000, "<" * 100_000, "<li>" * 20_000, "&" * 100_000, "<td>" * 20_000, "<!--" * 20_000, "<script>" * 1000):
        html.text_of(page)


def test_null_repeated_and_empty(spark):
    docs = spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "y")], "page_id long, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in html.extracted(docs).collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert html.extracted(docs.limit(0)).count() == 0
