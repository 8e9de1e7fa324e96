from __future__ import annotations

import html as plain
import re

import duckdb
import pytest

from threatsieve.llm import html

LONG = "This is a sentence of some length, with a comma, and it goes on for a while. " * 3
SHORT = "Yes."


def page(body):
    return f"<html><head><title>No</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    "article": (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>{SHORT}</article><footer>Foot, long. {LONG}</footer>", f"Title {LONG} {SHORT}"),
    "no article": (
        f"<header><h1>Site</h1></header><div id=menu><p>{LONG}</p></div><div class='post-body'><h2>Title</h2><p>{LONG}</p><p>{SHORT}</p></div>"
        f"<div class='sidebar'><p>{LONG}</p></div><section id='comments'><p>{LONG}</p></section>",
        f"Title {LONG} {SHORT}",
    ),
    "inside": (
        f"<article><header><h1>Title</h1></header><p>{LONG}</p><div class='ad-slot'>Buy, now. {LONG}</div><aside>Side {LONG}</aside><form>Name: <input><button>Go</button></form>"
        f"<div class='cookie-notice'>{LONG}</div><p>{SHORT}</p><section class='comments'><p>{LONG}</p></section></article>",
        f"Title {LONG} {SHORT}",
    ),
    "own head": (f"<div id='page-header'>Site</div><div class='story'><div class='entry-header'><h1>Title</h1></div><p>{LONG}</p><div class='entry-footer'>Filed, {LONG}</div></div>", f"Title {LONG}"),
    "references": ("<article><p>a &amp; b &lt;c&gt; &#233;&#x1F600; &nbsp;d &eacute; &copy;</p></article>", "a & b <c> é😀 d é ©"),
    "space": ("<article><p>one\n\t two<br>three <b>fo</b>ur</p><pre> a\n b </pre></article>", "one two three four a b"),
    "scripts": ("<article><script>if (a<b) document.write('<p>no</p>')</script><p>yes, it is.</p><style>no</style><!-- <p>no</p> --><noscript>no</noscript></article>", "yes, it is."),
    "broken": (f"<article><p><b>{LONG}<br><p>{SHORT}</p><p>end &am", f"{LONG} {SHORT} end &am"),
    "quoted": ("<article><p title='a > b' data-x=\"</p>\">text, here.</p></article>", "text, here."),
}


ITEM = "a short item of 25 chars."
BLOCKS = {
    "list": (f"<ul>{f'<li>{ITEM}</li>' * 10}</ul>", f"{ITEM} " * 10),
    "table": ("<table><tr><th>Year<th>Sum<tr><td>1<td>2</table>", "Year Sum 1 2"),
    "definitions": ("<dl><dt>Term<dd>What it is</dl>", "Term What it is"),
    "links": (f"<ul>{'<li><a href=/>Elsewhere</a></li>' * 10}</ul>", ""),
    "a link": ("<ul><li>See <a href=/>there</a> for the rest</ul>", "See there for the rest"),
}


@pytest.mark.parametrize("name", BLOCKS)
@pytest.mark.parametrize("root", ["article", "main", "div class=story"])
def test_all_blocks_of_the_article_stay(name, root):
    block, text = BLOCKS[name]
    paragraph = (LONG * 2)[:400]
    source = page(f"<div class=top>Short</div><{root}><h1>Title</h1>{f'<p>{paragraph}</p>' * 10}{block}{f'<p>{paragraph}</p>' * 10}</{root.split()[0]}>")
    half = f"{paragraph} " * 10
    assert html.main_text(source) == " ".join(f"Title {half} {text} {half}".split())


P = f"<p>{LONG}</p>"
NAMED = {
    "modifier": (f"<div class='content has-sidebar'><article>{P}</article></div>", LONG),
    "holds the article": (f"<div class='modal'><article>{P * 3}</article></div><p>{SHORT}</p>", LONG * 3),
    "holds most": (f"<div id='overlay'>{P * 5}</div><div id='footer'>{LONG}</div>", LONG * 5),
    "long comments": (f"<article>{P}</article><div id='comments'>{f'<article>{P}</article>' * 9}</div>", LONG),
    "side effects": (f"<article>{P}<section id='side-effects'>{P}</section></article>", LONG * 2),
    "discussion": (f"<article>{P}<section id='discussion'><h2 id='related-work'>Work</h2>{P}</section><h2 id=search>Search</h2></article>", f"{LONG} Work {LONG} Search"),
    "teaser": (f"<div class='story'>{P * 9}</div><article><a href=/>Read this too</a></article>", LONG * 9),
    "names": (f"<article>{P}<div class='related-posts'>{P}</div><div class='sidebar-left x'>{LONG}</div><section id='comments'>{P}</section></article>", LONG),
}


@pytest.mark.parametrize("name", NAMED)
def test_names(name):
    body, text = NAMED[name]
    assert html.main_text(page(body)) == " ".join(text.split())


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    body, text = CASES[name]
    source = body if name == "broken" else page(body)
    assert html.main_text(source) == " ".join(text.split())


@pytest.mark.parametrize("source", ["", "<", "<p", "<!--", "</p>", "<p><p></b></i></p>", "<script>", "&", "<a" * 2000, "<div>" * 3000 + "x", "\x00<p>"])
def test_odd_pages_do_not_fail(source):
    assert isinstance(html.main_text(source), str)


def test_paths_by_brute_force(sf_dir):
    """The given pages keep their text in ``article``: its blocks are all of the result."""
    rows = duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet'").fetchall()
    for (source,) in rows:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inside)]
        expected = [" ".join(plain.unescape(b).split()) for b in blocks]
        assert html.main_text(source) == " ".join(b for b in expected if b)


def test_frames(spark):
    rows = [(1, "u", page(CASES["article"][0]), "x"), (1, "u", page(CASES["article"][0]), "x"), (None, None, None, None), (2, "v", "", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extracted(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    text = " ".join(CASES["article"][1].split())
    expected = [(0, None, "", 0), (1, "u", text, len(text)), (1, "u", text, len(text)), (2, "v", "", 0)]
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in found.collect()) == expected
    assert html.extracted(frame.limit(0)).count() == 0
