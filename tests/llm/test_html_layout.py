import html as html_lib
import re

import pytest

from paracorpus.llm import html_layout

from .helpers import rows

CASES = {
    "<p>One<p>Two": "One\n\nTwo",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "a <b> b</b>  c": "a b c",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=3><li>x<li><p>y</p><p>z</p></ol>": "3. x\n4. y\n\n   z",
    "<ul><li><pre>a\n\nb</pre><li>c</ul>": "- a\n\n  b\n- c",
    "<ul><li>a<ul><li><p>b<p>c</ul>d<li>e</ul>f": "- a\n  - b\n\n    c\n  d\n- e\n\nf",
    "<details open><summary>s</summary>t</details><details>u<summary>v</summary><summary>w</summary></details>": "s\nt\nv",
    "a<b>c<!-- <b>d": "ac",
    "a<b>c<!x": "ac",
    "x<br>y<br><br>z": "x\ny\n\nz",
    "<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td>Kiwi fruit<td>12<br>more</table>": "Name        Qty\nApple       3\nKiwi fruit  12\n            more",
    "<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b<td>d</table>": "wide     c\na     b  d",
    "<pre>\n a  b\n  c</pre>": " a  b\n  c",
    "<p>a<span style='display:none'>no</span><i hidden>no</i><script>if (a<b) no</script>b": "ab",
    "<head><title>no</title><style>p{}</style></head><body>yes": "yes",
    "&amp;lt; &eacute; &#x41; &nbsp;|": "&lt; é A \xa0|",
    "<!-- no --><!DOCTYPE html>yes<!-- open": "yes",
    "a < b and c <d": "a < b and c <d",
    "<select><option>one<option>two</select>": "one\ntwo",
    "<dl><dt>t<dd>d</dl>after": "t\n  d\n\nafter",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "a<hr>b": "a\n\n---\n\nb",
    "<dialog>no</dialog><details><summary>s</summary>t</details>": "s",
    "<a href='x>y'>link</a></p></div>end": "linkend",
    "<table><td>x</td><td>y</td><tbody><td>z</table>": "x  y\nz",
    "<table>stray<tr><td>a</table>": "stray\na",
    "": "",
    "  \n ": "",
}


@pytest.mark.parametrize("source", CASES, ids=range(len(CASES)))
def test_layout(source):
    assert html_layout.page_text(source) == CASES[source]


def test_nested_table_stays_in_its_cell():
    got = html_layout.page_text("<table><tr><td>a<table><tr><td>n1<td>n2</table><td>b</table>")
    assert got == "a       b\n\nn1  n2"


def test_deep_and_broken_markup():
    assert html_layout.page_text("<div>" * 50_000 + "x") == "x"
    assert html_layout.page_text("<b><i><table><tr><td>" * 40 + "x").strip() == "x"
    assert html_layout.page_text("</p></td></li>x<") == "x<"


def test_many_unclosed_tags():
    page = "<p>x</p>" + "<a " * 400_000
    assert html_layout.page_text(page) == "x\n\n" + ("<a " * 400_000).rstrip()


def words(text):
    return re.findall(r"\w+", text)


def test_words_of_the_tables(spark, sf001):
    """Against a brute force that only deletes: every visible word, in order, and no other."""
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html_layout.op3_query(pages).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.sub(r"(?is)<(head|script|style)\b.*?</\1>|<!--.*?-->", " ", source[r["page_id"]])
        assert words(re.sub(r"(?m)^ *(- |\d+\. )", "", r["text"])) == words(html_lib.unescape(re.sub(r"(?s)<[^>]*>", " ", body)))


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "<p>x"), (3, "<p>y" * 20_000), (3, "<b>z")], "page_id long, html string")
    df = df.selectExpr("*", "'u' as url", "'t' as text")
    got = rows(html_layout.op3_query(df))
    assert sorted((r for r in got if r[0] != 3), key=repr) == [(1, ""), (2, ""), (None, "x")]
    assert sorted(len(r[1]) for r in got if r[0] == 3) == [1, 20_000 + 2 * 19_999]
    assert rows(html_layout.op3_query(df.limit(0))) == []


FOREIGN = {
    "<p>sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> end": "sum x+1 end",
    "<math><semantics><mrow><mi>y</mi></mrow><annotation encoding='application/x-tex'>no</annotation></semantics></math>": "y",
    "<math><mfrac><mi>a</mi><mi>b</mi></mfrac></math>": "a b",
    "<svg><title>no</title><desc>no</desc><defs><text>no</text></defs>no<path d='M0'/><text>North</text><text x=1>South</text></svg>": "North\nSouth",
    "<svg><defs/><g><rect/><text><tspan x=1>A</tspan><tspan x=2>B</tspan></text></g></svg>after": "A B\nafter",
    "<svg><text display='none'>no</text><foreignObject><p>in html</p></foreignObject></svg>": "in html",
    "<svg><defs><p>left": "left",
    "<a href=x><svg><a><text>t</text></a></svg> link</a>": "t\nlink",
    "<map name=m><area alt=no><p>choose <a href=y>one</a></p></map>": "choose one",
    "<desc>shown</desc><mask>too</mask>": "showntoo",
}


@pytest.mark.parametrize("source", FOREIGN, ids=range(len(FOREIGN)))
def test_formulas_graphics_and_maps(source):
    assert html_layout.page_text(source) == FOREIGN[source]
