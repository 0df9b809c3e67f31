"""Main text of pages: made-up page layouts, broken markup, odd rows, and the whole query against a plain reading."""

import html as h
import re
import time

import pytest
from pyspark.sql import functions as F

from spendlens.llm import maintext
from spendlens.llm.maintext import main_text

P1 = "The committee met on Monday, as planned, and agreed on a first draft of the new rules for the harbour."
P2 = "Fishermen, traders and pilots had asked for it, because the old rules, written in 1931, no longer fit."
P3 = "A vote is due in May."
BODY = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
TEXT = f"{P1} {P2} {P3}"
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li><li><a href="/d">About us</a></li></ul>'
LONG_COMMENT = "I do not agree, not at all, with what was said here, and neither do my neighbours, friends, or colleagues. " * 6

PAGES = {
    "article": (f"<body><nav>{MENU}</nav><article><h1>Harbour</h1>{BODY}</article><footer>&copy; 2020 Port News</footer></body>", f"Harbour {TEXT}"),
    "article header": (f"<header><h1>Port News</h1></header><article><header><h1>Harbour</h1></header>{BODY}<footer>Tags: sea</footer></article>", f"Harbour {TEXT}"),
    "div by id": (f"<body><div id=header>Port News</div><div class='menu'>{MENU}</div><div id=content>{BODY}</div><div id=sidebar><p>{P2}</p></div><div class=footer>Imprint</div>", TEXT),
    "comments": (f"<div class=post>{BODY}</div><div id=comments><div class=comment-body><p>{LONG_COMMENT}</p></div></div>", TEXT),
    "comments as articles": (f"<main><article class='post comments-open'>{BODY}<section class=comments><article class=comment><p>{LONG_COMMENT}</p></article></section></article></main>", TEXT),
    "notice": (f"<div class=cookie-banner><p>We use cookies, and so on, to make this site better for you.</p><button>OK</button></div><main>{BODY}</main>", TEXT),
    "form around the page": (f"<form id=aspnet><div class=nav>{MENU}</div><div class=inner>{BODY}</div></form><form><input><label>Your mail</label></form>", TEXT),
    "search form": (f"<form role=search><p>Search this site, please, for anything you like.</p></form><div>{BODY}</div>", TEXT),
    "menu without a name": (f"<body>{MENU}<div>{BODY}</div>{MENU}</body>", TEXT),
    "sections": (f"<div class=text><div class=s><p>{P1}</p></div><div class=s><p>{P2}</p></div><div class=s><p>{P3}</p></div></div><aside>x</aside>", TEXT),
    "no paragraphs": (f"<div class=top-nav>{MENU}</div><div class=story>{P1}<br><br>{P2}<br>{P3}</div><div class=footer>x</div>", TEXT),
    "layout table": (f"<table><tr><td>{MENU}<td><p>{P1}<p>{P2}<p>{P3}</table>", TEXT),
    "title beside": (f"<body><div class=site-header>Port</div><h1>Harbour</h1><div class=body>{BODY}</div></body>", f"Harbour {TEXT}"),
    "inline": (f"<article><p>{P1[:30]}<b>{P1[30:50]}</b><a href=x>{P1[50:60]}</a>{P1[60:]}</p>\n\n<p> {P2}\t</p><script>if (a<b) '</p>'</script><p>{P3}<style>p{{}}</style></article>", TEXT),
    "lists, tables, quotes and code": (f"<article>{BODY}<ul><li>one<li>two</ul><table><tr><td>3<td>4</table><blockquote>five</blockquote><pre>x  =\n 6</pre></article>", f"{TEXT} one two 3 4 five x = 6"),
    "links inside": (f"<article>{BODY}<ul><li><a href=a>First source</a><li><a href=b>Second source</a><li><a href=c>Third</a></ul></article>", f"{TEXT} First source Second source Third"),
    "hidden": (f"<article>{BODY}<p hidden>no</p><p style='display: none'>no</p><span aria-hidden=true>no</span></article>", TEXT),
    "advert inside": (f"<article><p>{P1}</p><div class='ad ad-slot'><p>Buy now, today, here.</p></div><p>{P2}</p><div id=adsense-1>Buy</div><p>{P3}</p></article>", TEXT),
    "share and related": (f"<article>{BODY}<div class=share-bar><a href=x>Share</a></div><div class='related'><h2>More</h2><p>{P1}</p></div></article>", TEXT),
    "names in other languages": (f"<div class=werbung><p>{P1}</p></div><div class=inhalt>{BODY}</div><div id=kommentare><p>{LONG_COMMENT}</p></div><div class='commentaires-lecteurs'><p>{P2}</p></div>", TEXT),
    "reactions and announcements": (f"<div class=announcement><p>{P2}</p></div><div class=main-content>{BODY}</div><section id=reader-reactions><p>{LONG_COMMENT}</p></section><ins class=adsbygoogle>Buy</ins>", TEXT),
    "class that only mentions": (f"<body class='has-sidebar no-comments'><div class='content with-ads'>{BODY}</div></body>", TEXT),
    "cut off": (f"<html><body><nav>{MENU}</nav><article><p>{P1}</p><p>{P2[:40]}</p><p>A &am", f"{P1} {P2[:40].strip()} A &am"),
    "cut off in a tag": (f"<article><p>{P1}</p><p>{P2}</p><a hre", f"{P1} {P2}"),
    "references": ("<article><p>Caf&eacute; &amp; bar&nbsp;&#8211; &lt;b&gt; &#x1F600; &unknown; A&B</p></article>", "Café & bar – <b> 😀 &unknown; A&B"),
    "quotes": ("<article><p title='a > b' data-x=\"<p>\">one, two, three, four, five, six</p><p class=\"x>seven</p></article>", "one, two, three, four, five, six seven"),
    "less than": ("<article><p>if 1 < 2 and 3<4 then all is well, is it not?</p></article>", "if 1 < 2 and 3<4 then all is well, is it not?"),
    "comment": (f"<article><!-- <p>no</p> --><p>{P1}</p><!----><p>{P2}</p><!--> <p>{P3}</p></article>", TEXT),
    "title only": ("<html><head><title>T</title></head><body></body></html>", ""),
    "one word": ("<html><body><p>word</p></body></html>", "word"),
    "no markup": ("just a line,  and another", "just a line, and another"),
    "script without end": (f"<article><p>{P1}</p><script>var a = '<p>no</p>'", P1),
    "upper case": (f"<BODY><NAV>{MENU}</NAV><ARTICLE><P>{P1}</P><SCRIPT>x</Script></ARTICLE>", P1),
    "blank": (" \n ", ""), "empty": ("", ""), "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    page, want = PAGES[name]
    assert main_text(page) == want


@pytest.mark.parametrize("page", ["<div>" * 60_000 + P1, "<a <a " * 60_000, "<p " + "=\"" * 100_000, "<!--" * 100_000,
                                  "<b>" * 50_000 + "<p>" * 50_000 + P1, "</p></div>" * 60_000 + P1, "<script>" * 50_000,
                                  "<li>" * 60_000 + P1, "&" * 300_000, "<p>" + P1 * 10_000, "<" * 300_000])
def test_broken_and_long_pages_take_linear_time(page):
    began = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - began < 8


def test_rows_and_columns(spark):
    rows = [(1, "u", p, f"t{i}") for i, (p, _) in enumerate(PAGES.values())] * 2 + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    out = maintext.extract(pages)
    assert out.columns == ["page_id", "url", "text", "_text"]
    got = {(r.text, r._text) for r in out.collect()}
    assert got == {(f"t{i}", w) for i, (_, w) in enumerate(PAGES.values())} | {(None, "")}
    assert out.count() == len(rows)
    assert maintext.extract(pages.where(F.lit(False))).collect() == []


def test_query_equals_a_plain_reading_of_the_articles(spark, sf_small):
    """The given pages have one article element each: everything in it, by a few substitutions."""
    def plain(page):
        body = re.sub(r"<[a-zA-Z/!][^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1])
        body = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))
        return " ".join(h.unescape(body).split())
    want = {r.page_id: plain(r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    got = maintext.query(spark, sf_small).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(want)
