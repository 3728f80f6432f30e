from __future__ import annotations

import html
import re
import time

import pytest

from clinspark.llm import html_text
from clinspark.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><div id="menu"><a href="1">Home</a><a href="2">News</a></div>
<div class="cookie-notice">We use cookies on this site for all manner of things.</div>
<div id="wrap"><div class="col"><h2>Title</h2><p>Some long paragraph of text &amp; more, with <a href="x">a link</a>.
<p>Another<br>paragraph that &lt;stays&gt; open&#33;<ul><li>one<li>two items</ul><table><tr><td>a<td>b<tr><td>c</table></div>
<div class="sidebar"><p>Sidebar text that is also a bit long, really it is.</p></div></div>
<section id="comments"><p>A reader comment that is quite long as well, says a user of this site.</p></section>
<form><label>Search</label><input name="q"></form><aside>More</aside><!-- <p>no</p> --><script>var a = "</p>";</script>
<footer>(c) Site</footer></body></html>"""


def test_parts_of_a_page():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title", "Some long paragraph of text & more, with a link.", "Another paragraph that <stays> open!", "one", "two items",
        "a b", "c"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>", ""), ("a < b <b", "a < b"), ("<p>x<p>y", "x\ny"), ("</div></p>z", "z"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<b><i>a</b>b</i>", "ab"), ("<p title='>'>q</p>", "q"),
    ("<script>x", ""), ("<!-- open", ""), ("<p>&nbsp; a &eacute; &#x41;</p>", "a é A"), ("<nav>only</nav>", ""),
    ("<![CDATA[a<b]]>", "a<b"), ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_menus_without_names_lose_to_text():
    links = "".join(f'<div><a href="{i}">Link {i}</a></div>' for i in range(30))
    text = "".join(f"<p>This is paragraph {i} of the story, and it is long enough to count.</p>" for i in range(6))
    got = html_text.main_text(f"<body><div>{links}</div><div>{text}</div></body>")
    assert got.count("paragraph") == 6 and "Link" not in got


def paragraphs(name, n, size=12):
    return "".join(f"<p>{name} {i} {'words of a story ' * size}</p>" for i in range(n))


@pytest.mark.parametrize("size", [1, 12])
@pytest.mark.parametrize("outer", ["article", "div class=wrap", "body"])
def test_all_sections_of_a_page(outer, size):
    """The second section, the title and the introduction are kept, a list of links between them goes."""
    links = "<ul>" + "".join(f'<li><a href="{i}">Link {i}</a></li>' for i in range(20)) + "</ul>"
    inner = (f"<h1>Title</h1><p>The introduction</p><section>{paragraphs('first', 6)}</section>{links}"
             f"<section>{paragraphs('second', 4, size)}</section>")
    page = f"<body>{inner}</body>" if outer == "body" else f"<body><{outer}>{inner}</{outer.split()[0]}></body>"
    lines = html_text.main_text(page).split("\n")
    assert [x.split(" ")[0] for x in lines] == ["Title", "The", *["first"] * 6, *["second"] * 4]


@pytest.mark.parametrize("wrapper", [
    "div class='content has-sidebar'", "div class='post comments-open'", "div id='page-with-menu'", "form id='aspnetForm'"])
def test_named_wrappers_keep_their_page(wrapper):
    """The name of what holds the page says nothing, that of a small part of it does."""
    end = wrapper.split()[0]
    small = "<div class='sidebar'><p>Sidebar text of a few words.</p></div><form><label>Search</label></form>"
    for inner in (paragraphs("main", 5), f"<article>{paragraphs('main', 5)}</article>"):
        lines = html_text.main_text(f"<body><{wrapper}>{inner}{small}</{end}></body>").split("\n")
        assert [x.split(" ")[0] for x in lines] == ["main"] * 5


def test_named_sections_and_comments():
    page = (f"<body><article>{paragraphs('a', 3)}<section class='related'>{paragraphs('b', 4)}</section></article>"
            f"<div class='comments'>{paragraphs('c', 30)}</div></body>")
    kept = [x.split(" ")[0] for x in html_text.main_text(page).split("\n")]
    assert kept.count("a") == 3 and "c" not in kept
    article = page[:page.index("<div class='comments'>")]
    assert [x.split(" ")[0] for x in html_text.main_text(article).split("\n")] == ["a"] * 3 + ["b"] * 4
    parts = "".join(f"<div class='post comments-open'>{paragraphs(n, 2)}</div>" for n in "pqrs")
    assert len(html_text.main_text(f"<body>{parts}</body>").split("\n")) == 8


@pytest.mark.parametrize("page,first", [
    ("<section data-title=\"a hidden gem\">{main}</section>", ["main"] * 4),
    ("<article><header class='entry-header'><h1>Title</h1></header>{main}</article><header>Site</header>", ["Title"] + ["main"] * 4),
    ("<div>{main}</div><div class='comment-section'>{comments}</div>", ["main"] * 4),
    ("<div>{main}</div><div id='comments'><article class='comment'>{comments}</article></div>", ["main"] * 4),
    ("<article>{main}<article class='comment-body'>{comments}</article></article>", ["main"] * 4),
    ("<article><p>main text</p></article><form>{comments}</form>", ["main"]),
    ("<article>{main}<p hidden>no</p></article>", ["main"] * 4),
    ("<article><ul><li hidden>no<li>main a<li>main b</ul>{main}</article>", ["main"] * 6),
])
def test_names_headers_comments_forms(page, first):
    got = html_text.main_text("<body>" + page.format(main=paragraphs("main", 4, 2), comments=paragraphs("c", 30)) + "</body>")
    assert [x.split(" ")[0] for x in got.split("\n")] == first


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + "deep", "<div><table>" + "<i>" * 20_000 + "</div>" * 20_000 + "deep",
    "<span>" * 20_000 + "<p>" * 20_000 + "deep", "<div hidden>" + "<div>" * 20_000 + "</div>" * 20_001 + "deep"])
def test_deep_nesting_is_linear(page):
    begin = time.perf_counter()
    assert html_text.main_text(page) == "deep"
    assert time.perf_counter() - begin < 5


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", PAGE), (2, "u", PAGE), (2, "u", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, text string, html string")
    found = html_text.extract_text(df)
    assert found.columns == ["page_id", "html", "text"] and [bool(r["text"]) for r in found.collect()].count(True) == 3
    assert html_text.extract_text(df.where("false")).collect() == []
    assert html_text.extract_text(df.select("page_id", "html"), out="html").columns == ["page_id", "html"]


def test_query(spark, sf_dir):
    """The supplied pages hold their text in one article of headings and paragraphs."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op9_text_density"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
