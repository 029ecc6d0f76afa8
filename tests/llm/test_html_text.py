"""Layouts written out by hand, and what must hold for any markup."""

import html as entities
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import html_text
from tidemark.llm.html_text import extract

CASES = {
    "a paragraph left open<p>one<p>two<div>three</div>four": "a paragraph left open\n\none\n\ntwo\n\nthree\nfour",
    "<ul><li>a<li>b<ol start=3><li>c<li value=9>d<li>e</ol><li>f</ul>g": (
        "- a\n- b\n  3. c\n  9. d\n  10. e\n- f\n\ng"
    ),
    "<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table>": (
        "name       n\nlong name  1\nx          22"
    ),
    "<table><td>a<td rowspan=2>b<td>c<tr><td>dd<td>ee</table>": "a   b  c\ndd     ee",
    "<table><tr><td colspan=2>a wide one<td>z<tr><td>b<td>c<td>d</table>": "a wide one  z\nb  c        d",
    "<table><caption>Cap</caption><tfoot><tr><td>last</tfoot><tr><td>a<br>b<td>c</table>": (
        "Cap\na     c\nb\nlast"
    ),
    "<table><tr><td>a</div></p></table>b": "a\n\nb",
    "x<script>var t='</p>';</script>y<style>p{}</style><!-- no -->z": "xyz",
    "<head><title>t</title></head><p hidden>no<p style='color:red; DISPLAY : none'>no<p>yes": "yes",
    "<noscript>no</noscript><template><p>no</template><p style='visibility:hidden'>no</p>yes": "yes",
    "<pre>a  b\n  c\n</pre>d   e": "a  b\n  c\n\nd e",
    "one<br>two<br><br>three<br>": "one\ntwo\n\nthree",
    "a&nbsp;&nbsp;b &amp; c &lt;d&gt; &copy;": "a  b & c <d> ©",
    "1 < 2 and <b>3</b>>2": "1 < 2 and 3>2",
    "<blockquote><p>q</p><p>r</p></blockquote>s": "  q\n\n  r\n\ns",
    "<dl><dt>t<dd>d<dt>u<dd>v</dl>": "t\n  d\nu\n  v",
    "<nav><ul><li><a href=/x>x</a></li></ul></nav><h1>h</h1><h2>i": "- x\n\nh\n\ni",
    "<select><option>a<option>b</select>": "a\nb",
    "<a href=\"x>y\">link</a> <a title='it\"s'>b</a> <p id=\"open>c": "link b\n\nc",
    "<table><tr><td>日本<td>b<tr><td>aaaa<td>c</table>": "日本  b\naaaa  c",
    "<td>loose cell</td></li></table>": "loose cell",
    "": "",
    "<p></p> \n": "",
}


@pytest.mark.parametrize("source", list(CASES))
def test_layout(source):
    assert extract(source) == CASES[source]


PARTS = "<p> </p> <div> </div> <ul> <li> </ul> <table> <tr> <td/colspan=2> <td> </table> <b> </b> <br> <pre> < > &amp; \" '".split(" ")


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS) | st.from_regex("w[a-z]{1,3} ", fullmatch=True), max_size=25))
def test_every_word_is_kept_in_some_order(parts):
    source = " ".join(parts)
    words = [p.strip() for p in parts if p.startswith("w")]
    got = re.findall(r"w[a-z]+", extract(source))
    assert sorted(got) == sorted(words)


def test_depth_and_length():
    assert extract("<div>" * 50_000 + "deep").strip() == "deep"
    assert extract("<b><table><tr><td>" * 3_000 + "deep").strip() == "deep"
    assert len(extract("<p>word</p>" * 50_000)) == 6 * 50_000 - 2


def test_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    got = html_text.extract_text(pages).collect()
    assert len(got) == len(sources)
    for r in got:
        unseen = r"<!--.*?-->|<head>.*?</head>|<(script|style|noscript|template|svg)\b.*?</\1>"
        shown = re.sub(r"<[^>]*>", " ", re.sub(f"(?s){unseen}", "", sources[r.page_id]))
        assert letters(r.text) == letters(entities.unescape(shown))


def letters(text):
    return sorted(c for c in text if c.isalpha())


def test_edge_rows(spark):
    rows = [(1, None, "u"), (None, "<p>a", "u"), (2, "", "u"), (2, "", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract_text(df).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, None), (None, "a"), (2, ""), (2, "")]))
    assert html_text.extract_text(df.limit(0)).count() == 0


SEEN = {
    "<html><head><title>t</title><body><p>text": "text",
    "<head><meta charset=utf-8> <p>one<p>two": "one\n\ntwo",
    "<head><title>t</title>\nbare text <b>on": "bare text on",
    "<head><style>p{}</style><template><p>no</template><script>x</script></head><body>yes": "yes",
    "<html><head></body>late": "late",
    "a<head><title>t</title>b": "ab",
    "<p>see <svg viewBox='0 0 9 9'>no<g><path d='M0'/><title>no</title><text>A</text><text x=1>B</text></g>"
    "<defs><text>no</text></defs></svg> here": "see\nA\nB\nhere",
    "<svg><path d='M0'><p>broken out": "broken out",
    "so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>.": "so x=2.",
    "<form><input name=q value=word> <input type=submit value='Go &amp; see'> <input type=BUTTON value=b>"
    "<input type=hidden value=no><input type=checkbox value=no></form>": "word Go & see b",
}


@pytest.mark.parametrize("source", list(SEEN))
def test_what_browsers_show(source):
    assert extract(source) == SEEN[source]


STYLED = {
    "<p style='backface-visibility:hidden'>yes</p>": "yes",
    "<p style='--display:none; x-visibility : hidden'>yes</p>": "yes",
    "<p style='display:none;display:block'>yes</p>": "yes",
    "<p style='display:none !important;display:block'>no</p>": "",
    "<p style='/* display:none */color:red'>yes</p>": "yes",
    "<p hidden style='display:block'>yes</p>": "yes",
    "<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p>no</div>": "yes",
    "<div style='visibility:collapse'>no <b>no</b><span style='visibility:visible'>yes</span></div>": "yes",
    "<div style='visibility:hidden'><div style='visibility:inherit'>no</div></div>yes": "yes",
    "<div style='display:none'>no<p style='display:block;visibility:visible'>no</p></div>yes": "yes",
    "<style>.h{display:none}</style><p class='a h'>no<p class=hh>yes": "yes",
    "<style>#x{display:none} p{visibility:hidden}</style><p>no<div id=x>no</div><div>yes": "yes",
    "<style>p{display:none} p.k{display:block}</style><p>no<p class=k>yes": "yes",
    "<style>p.k{display:block} p{display:none}</style><p>no<p class=k>yes": "yes",
    "<style>p{display:none!important} p.k{display:block}</style><p class=k>no": "",
    "<style>.a.b{display:none}</style><p class=a>yes<p class='b a'>no": "yes",
    "<style>P, .z , h1{ display : NONE }</style><p>no<h1>no</h1><b class=z>no</b><h2>yes": "yes",
    "<style>.h{display:none}</style><p class=h style='display:block'>yes": "yes",
    "<style>.h{display:none}.h{display:block}</style><p class=h>yes": "yes",
    "<style>@media print{p{display:none}}</style><p>yes": "yes",
    "<style media=print>p{display:none}</style><p>yes": "yes",
    "<style>@media screen{p{display:none}} h1{color:red}</style><p>no<h1>yes": "yes",
    "<style>@import url(x.css); p{display:none}</style><p>no<h1>yes": "yes",
    "<style>div p{display:none} p:hover{display:none} [x]{display:none}</style><div><p x=1>yes": "yes",
    "<style><!-- p{display:none} --></style><p>no<b>yes": "",
    "<style>@font-face{src:x} p{display:none}</style><p>no</p>yes": "yes",
    "<ul><li style='visibility:hidden'>no<b style='visibility:visible'>yes</b><li>b</ul>": "- yes\n- b",
    "<table><tr><td>a<td style='visibility:hidden'>long one<td>c<tr><td>x<td>yy<td>z</table>": "a      c\nx  yy  z",
    "<style>p{display:none": "",
    "<style>p{display:none</style><p>no</p>yes": "yes",
}


@pytest.mark.parametrize("source", list(STYLED))
def test_styles(source):
    assert extract(source) == STYLED[source]


def shown(node, rules, unseen=False):
    """Visible text, spaces left out, by walking down and asking for every element anew."""
    own = html_text.declarations(node.attributes.get("style", ""))
    said = {}
    for rule in sorted((r for r in rules if r.matches(node)), key=lambda r: r.weight()):
        for name, (value, important) in rule.declared.items():
            if important or not said.get(name, ("", False))[1]:
                said[name] = value, important
    for name, (value, important) in own.items():
        if important or not said.get(name, ("", False))[1]:
            said[name] = value, important
    display = said.get("display", (None,))[0]
    if display == "none" or display is None and "hidden" in node.attributes or node.name in html_text.UNSEEN:
        return ""
    unseen = {"hidden": True, "collapse": True, "visible": False}.get(said.get("visibility", ("inherit",))[0], unseen)
    return "".join(
        ("" if unseen else "".join(c.split())) if isinstance(c, str) else shown(c, rules, unseen) for c in node.children
    )


PARTS = ["<div>", "</div>", "<p class=a>", "<p class='a b' id=x>", "</p>", "<b id=x>", "</b>", "text ", "more "]
PARTS += [f"<span style='{s}'>" for s in ("display:none", "visibility:hidden", "visibility:visible", "display:block!important")]
PARTS += ["</span>", "<i hidden>", "</i>", "<section class=b style='visibility:visible'>", "</section>"]
SHEETS = ["", ".a{visibility:hidden}", "#x{display:none}", "p{display:none}.b{display:block}", "b,.b{visibility:visible!important}"]


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=25), sheets=st.lists(st.sampled_from(SHEETS), max_size=3))
def test_visible_text_equals_a_plain_walk(parts, sheets):
    source = "".join(f"<style>{s}</style>" for s in sheets) + "".join(parts)
    rules = []
    for sheet in sheets:
        rules += html_text.rules_of(sheet, len(rules))
    assert "".join(extract(source).split()) == shown(html_text.parse(source), rules)
