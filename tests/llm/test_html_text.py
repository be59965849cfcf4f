from __future__ import annotations

import html
import random
import re
import time

import pytest

from hoptrail.llm import html_text, queries

PAGE = """<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body>
<header>Site header, with commas, many</header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, ok?</div><div id="sidebar"><p>Aside, aside, aside, aside</p></div>
<div class="post"><h2>Title</h2><p>First   paragraph,\n with commas, and &amp; entities &#233;&nbsp;x.<p>Second <b>bold</b>
one, short<br>line.</p><ul><li>one<li>two</ul><form><p>Name, please</p></form></div>
<div class="comments"><p>A reader wrote, at length, a comment, yes</p></div><footer>&copy; all</footer></body></html>"""


def article(page: str) -> str:
    """Blocks of the one article of the generated pages, by plain splitting."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    inner = re.sub(r"<[^>]*\Z", "", inner)
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_generated_pages(spark, small):
    found = {r["page_id"]: r for r in queries.op2_html_text(spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        row = found[page["page_id"]]
        assert row["text"] == article(page["html"])
        assert row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def test_container_without_an_article_element():
    assert html_text.main_text(PAGE) == (
        "Title\nFirst paragraph, with commas, and & entities é x.\nSecond bold one, short line.\none\ntwo"
    )


def test_links_count_against_a_container():
    links = "".join(f"<p><a href=/{i}>A long link text, with commas, number {i}</a></p>" for i in range(30))
    page = f"<body><div>{links}</div><div><p>A plain paragraph, of some length, stays.</p></div></body>"
    assert html_text.main_text(page) == "A plain paragraph, of some length, stays."


def test_good_siblings_are_kept():
    long = "Plain words, with commas, that go on and on for more than eighty characters, as paragraphs do."
    page = f"<body><p>{long} 1</p><div>{''.join(f'<p>{long} {i}</p>' for i in (2, 3, 4))}</div><p>{long} 5</p></body>"
    assert [x[-1] for x in html_text.main_text(page).split("\n")] == list("12345")


def test_slugs_and_theme_classes_drop_nothing():
    page = """<body><div id="page" class="social-enabled"><article><h2 id="market-share">Market share</h2>
<p class="side-effects">Effects.</p><section id="related-work"><h3 id="search">Search</h3><p>Work.</p></section>
<section id="comments"><p>Remarks.</p></section><div class="share-buttons">Share!</div></article></div></body>"""
    assert html_text.main_text(page) == "Market share\nEffects.\nSearch\nWork."
    assert html_text.main_text('<div class="menu"><main><p>The whole page.</p></main></div>') == "The whole page."
    plain = '<body><div class="no-sidebar skip-intro"><h2 id="login">Login</h2><p id="banner">Text, of a page.</p></div></body>'
    assert html_text.main_text(plain) == "Login\nText, of a page."


def test_short_siblings_are_kept():
    items = [f"{i} " + "plain words " * 8 for i in range(8)]
    listed = "".join(f"<li>{x}</li>" for x in items)
    inner = f"<div><h2>A</h2><p>Intro.</p><ul>{listed}</ul><p>Short end.</p></div>"
    expected = ["A", "Intro.", *(x.strip() for x in items), "Short end."]
    assert html_text.main_text(f"<body>{inner}</body>") == "\n".join(expected)
    links = "<ul><li><a href=/1>Some other page</a></li><li><a href=/2>One more page</a></li></ul>"
    page = f"<body><h1>T</h1>Bare <b>words</b> here.{inner}{links}<section><h2>B</h2><p>Last.</p></section></body>"
    assert html_text.main_text(page) == "\n".join(["T", "Bare words here.", *expected, "B", "Last."])


def test_edges(spark):
    deep = "<div>" * 3000 + "<p>deep, deep text that is long enough</p>"
    rows = [
        (1, None, None, 1),
        (2, "u", "", 1),
        (3, "u", "<p", 1),
        (4, "u", "plain text only", 1),
        (5, "u", "<article><p>unfinished &am", 1),
        (6, "u", deep, 1),
        (6, "u", deep, 1),
        (7, "u", "<script>never closed", 1),
        (8, "u", "<article></article>", 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    found = [(r["page_id"], r["text"]) for r in html_text.extract_text(pages).collect()]
    deep_text = "deep, deep text that is long enough"
    assert sorted(found) == [
        (1, ""),
        (2, ""),
        (3, ""),
        (4, "plain text only"),
        (5, "unfinished &am"),
        (6, deep_text),
        (6, deep_text),
        (7, ""),
        (8, ""),
    ]
    assert html_text.extract_text(pages.limit(0)).count() == 0


PROSE = "Plain words, with commas, that go on and on for more than eighty characters, as paragraphs do."
NAMES = (
    "user-comments reader-comments post-comments comment-thread comments-section commentlist related-posts ad-slot"
    " ad-300x250 sticky-ad advert-inline mobile-menu author-sidebar social-media share-buttons cookieNotice newsletter"
    " page-footer breadcrumbs main-nav"
).split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("around", ["article", "div", "main", "section"])
def test_named_boilerplate_goes(name, around):
    own = [f"{PROSE} {i}" for i in range(4)]
    for kind in ("class", "id"):
        other = f'<div {kind}="{name}"><p>{PROSE} A reader or a seller wrote this.</p></div>'
        body = "".join(f"<p>{p}</p>" for p in own)
        inside = f"<body><{around}>{body}{other}<p>End.</p></{around}></body>"
        assert html_text.main_text(inside) == "\n".join([*own, "End."])
        beside = f"<body><div>{other}<{around}>{body}</{around}>{other}</div></body>"
        assert html_text.main_text(beside) == "\n".join(own)


def test_comments_with_a_heading_go():
    for page in (
        f'<body><article><p>{PROSE}</p><section id="comments"><h3>2 comments</h3><p>{PROSE} Me.</p></section></article></body>',
        f'<body><div class="post"><p>{PROSE}</p></div><ol class="commentlist"><li>{PROSE} Me.</li></ol></body>',
    ):
        assert html_text.main_text(page) == PROSE
    kept = f'<body><article><p>{PROSE}</p><section id="comments-and-methods"><h3>Comments and methods</h3><p>Ours.</p></section></article></body>'
    assert html_text.main_text(kept) == f"{PROSE}\nComments and methods\nOurs."


@pytest.mark.parametrize("around", ["article", "div"])
def test_unnamed_side_column_goes(around):
    column = "<div><h3>About</h3><p>A site on words.</p><p>Write to us, please.</p></div>"
    body = "".join(f"<p>{PROSE} {i}</p>" for i in range(6))
    page = f"<body><div>{column}<{around}><h1>Title</h1>{body}</{around}>{column}</div></body>"
    assert html_text.main_text(page) == "\n".join(["Title", *(f"{PROSE} {i}" for i in range(6))])


def test_the_score_decides_the_container():
    """Three containers without names: the one with the most prose wins, wherever it is."""
    parts = [f"<div>{''.join(f'<p>{PROSE} {k}{i}</p>' for i in range(n))}</div>" for k, n in (("a", 1), ("b", 9), ("c", 1))]
    for order in ((0, 1, 2), (1, 0, 2), (2, 0, 1)):
        page = "<body><div>" + "".join(parts[i] for i in order) + "</div></body>"
        assert html_text.main_text(page) == "\n".join(f"{PROSE} b{i}" for i in range(9))


def test_short_ends_beside_a_long_list_stay():
    items = "".join(f"<li>{PROSE} {i}</li>" for i in range(8))
    page = f"<body><div><h2>A</h2><p>Intro.</p><ul>{items}</ul><p>Short end.</p></div></body>"
    assert html_text.main_text(page).split("\n")[:2] == ["A", "Intro."]
    assert html_text.main_text(page).endswith("7\nShort end.")


def test_odd_markup_is_read_as_browsers_do():
    for odd in ("<![foo[x]]>", "<![CDATA[x]]>", "<!x y>", "<?php x ?>", "<!-- x --!>", "<!-->", "<!--->", "</ >", "<!-- <p>x</p> -->"):
        assert html_text.main_text(f"<body><p>{PROSE}</p>{odd}<p>b</p></body>") == f"{PROSE}\nb", odd
    assert html_text.main_text(f"<p>{PROSE}</p><!-- never ends <p>x</p>") == PROSE
    assert html_text.main_text(f"<p>{PROSE}</p><![if x") == PROSE


def test_time_is_linear():
    n = 50_000
    pages = [
        "<div>" * n + f"<p>{PROSE}</p>",
        '<div class="menu-x">' * n + f"<article><p>{PROSE}</p></article>",
        "<p>" + "<b>" * n + PROSE,
        f"<p>{PROSE}</p>" + "</i></div></p>" * n,
        "<table>" + "<tr><td>" * n + f"<p>{PROSE}</p>",
        "<ul>" + "<li>" * n + f"{PROSE}</ul>",
    ]
    for page in pages:
        started = time.process_time()
        assert PROSE in html_text.main_text(page)
        assert time.process_time() - started < 6


def test_generated_pages_without_an_article():
    """Pages built from known parts; what is to come out is known by construction."""
    rng = random.Random(8)
    for _ in range(60):
        truth, body = [], []
        for i in range(rng.randint(3, 8)):
            tag, text = rng.choice([("p", PROSE), ("p", "Short."), ("h2", "Head"), ("blockquote", PROSE), ("pre", "x = 1, 2")])
            truth.append(f"{text} {i}")
            body.append(f"<{tag}>{text} {i}</{tag}>")
        truth.append(PROSE)
        body.append(f"<p>{PROSE}</p>")
        for _ in range(rng.randint(0, 3)):
            other = f'<div class="{rng.choice(NAMES)}"><p>{PROSE} no</p></div>'
            body.insert(rng.randint(0, len(body)), other)
        wrapped = "<div>" + "".join(body) + "</div>"
        for _ in range(rng.randint(0, 3)):
            links = "".join(f"<p><a href=/{j}>Another, linked, page {j}</a></p>" for j in range(4))
            wrapped = rng.choice([f"<div>{wrapped}</div>", f"<div>{links}</div>{wrapped}", f"<nav>{links}</nav>{wrapped}"])
        assert html_text.main_text(f"<html><body>{wrapped}<footer>f</footer></body></html>") == "\n".join(truth)
