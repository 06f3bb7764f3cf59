"""Main texts of pages of many kinds, each with what a reader would call the article."""

from __future__ import annotations

import time

import pytest

from cohortloom.llm import main_text
from cohortloom.llm.main_text import main_text as text_of

A = "The river rose in the night, and by morning the lower fields were under water."
B = "Nobody had seen it so high since the bridge was built; the old men said so, at least."
MENU = '<nav><ul><li><a href="/">Home</a><li><a href="/n">News, sport</a></ul></nav>'

PAGES = {
    "article": (f"<body>{MENU}<article><h1>River</h1><p>{A}<p>{B}</article><footer>All rights. Reserved, really.</footer>", ["River", A, B]),
    "short article": (f'{MENU}<div class="ad">{A} {B}</div><article><p>Rain.</article><footer>{B}</footer>', ["Rain."]),
    "main": (f"<main><h1>River</h1><p>{A}</p><aside><p>{B}</p></aside></main><p>{B}", ["River", A]),
    "plain divs": (
        f'<div id="top"><a href="/">Home</a> <a href="/x">More</a></div><div id="c"><h2>River</h2><p>{A}</p><p>{B}</p>'
        f'<p>Yes.</p></div><div id="low"><a href="/imprint">Imprint</a> | <a href="/c">Contact</a></div>',
        ["River", A, B, "Yes."],
    ),
    "body only": (f"<html><body><p>{A}</p><p>{B}</p></body></html>", [A, B]),
    "comments": (
        f'<article><p>{A}</p><section id="comments"><p>{B}</p></section><div class="comment-list">x, y.</div></article>',
        [A],
    ),
    "comment articles": (f'<article class="post"><p>{A}</p></article><article class="comment"><p>{B}</p></article>', [A]),
    "inner header": (f"<article><header><h1>River</h1><p>By me</p></header><p>{A}</p><footer>Tags</footer></article>", ["River", A]),
    "notice": (f'<div class="cookie-notice"><p>{B}</p></div><div role="banner">{B}</div><div class="text"><p>{A}</p></div>', [A]),
    "form around all": (f"<form><div>Login <input></div><article><p>{A}</p></article></form>", [A]),
    "form": (f"<article><p>{A}</p><form><label>Your name, please.</label><button>Go</button></form></article>", [A]),
    "layout names": (f'<div class="no-sidebar has-menu"><p>{A}</p></div>', [A]),
    "script": (f"<article><script>if (a<b) x='</p>{B}';</script><style>p{{}}</style><p>{A}<!-- {B} --></p></article>", [A]),
    "references": (
        "<article><p>a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &copy 1 &am x&nbsp;y &notanentity;</p></article>",
        ["a & b <c> ééé © 1 &am x y ¬anentity;"],
    ),
    "white space": (f"<article><p>\n  {A[:9]}\t\n{A[9:]}<br>\n{B}<b> </b></p>\n<p> \n</p></article>", [f"{A[:9]} {A[9:].strip()} {B}"]),
    "inline": ("<article><p>wo<b>r</b>d <i>and</i> <a href='x'>link</a>, end.</p></article>", ["word and link, end."]),
    "unclosed": (f"<article><p><b>{A}<br><p>{B}</article><p>after", [A, B]),
    "list and table": (
        "<article><ul><li>one<li>two<p>three</p></ul><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>",
        ["one", "two", "three", "a", "b", "c", "d", "e"],
    ),
    "attributes": (f"<article><p title=\"a > b\" data-x='<p>'>{A}</p><img alt='x > y'><p class=it's>{B}</p></article>", [A, B]),
    "open quote": (f'<article><p title="oops>{A}</p><p>{B}</p></article>', [A, B]),
    "stray signs": ("<article><p>1 < 2 and 3 > 2, <3 </p></article>", ["1 < 2 and 3 > 2, <3"]),
    "odd comments": (f"<article><!--><p>{A}</p><!----!><?php x ?><!x></ ><p>{B}</p></article><!-- open", [A, B]),
    "stray ends": (f"<article></div></p><p>{A}</b></p></span><p>{B}</article>", [A, B]),
    "no content": (MENU + "<footer>Nothing, here.</footer><script>x()</script>", []),
    "no tags": (A, [A]),
    "empty": ("", []),
    "capitals": (f"<ARTICLE><P>{A}</P><SCRIPT>x</SCRIPT></ARTICLE>", [A]),
    "title": (f"<head><title>River</title></head><body><article><p>{A}</p></article>", [A]),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    html, blocks = PAGES[name]
    assert text_of(html) == "\n\n".join(blocks)


def test_unmarked_neighbours_go():
    """Containers that no element or name marks, told apart by their ratios alone."""
    links = "".join(f'<li><a href="/{k}">Story {k}</a></li>' for k in range(30))
    page = f"<div class=left><ul>{links}</ul></div><div class=mid><p>{A}</p><p>{B}</p><h3>Then</h3><p>{B}</p></div><div class=low>v1</div>"
    assert text_of(page) == "\n\n".join([A, B, "Then", B])


@pytest.mark.parametrize(
    "html",
    ["<" * 200_000, "<a " * 100_000, '<a b="' * 100_000, "<div>" * 100_000 + "x" + "</b>" * 100_000, "<b>" * 50_000 + "<p>" * 50_000]
    + ["<!--" * 100_000, "</p>" * 100_000, "<a x='>'" * 50_000, "&" * 300_000, f"<article><p>{A * 20_000}</p></article>"],
)
def test_long_and_hostile_pages_end_soon(html):
    begun = time.time()
    text_of(html)
    assert time.time() - begun < 20


def test_tables(spark):
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(PAGES.values())] + [(None, None, None), (1, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS Text", "1 AS `a.b`", "2 AS HTML")
    got = main_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "a.b", "HTML", "text"]
    found = sorted(((r.page_id, r.text) for r in got.collect()), key=str)
    want = [(k, "\n\n".join(blocks)) for k, (_, blocks) in enumerate(PAGES.values())] + [(None, ""), (1, "x")]
    assert found == sorted(want, key=str)
    assert main_text.extract_text(pages.limit(0)).count() == 0
