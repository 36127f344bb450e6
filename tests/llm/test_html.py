import pytest

from fleetmatch.llm import html
from fleetmatch.llm.common import read_table
from tests.llm.helpers import by_id

SENTENCE = "This is the text of the page and it is long enough for the rules to see that it is a text."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<", "<"), ("plain words", "plain words"),
    ("<p>a &lt; b &amp;amp; &notin; &#65;&nbsp;x <!-- no --> <b>c</b>d<br>e <script>var a='</p>'</script>", "a < b &amp; ∉ A x cd\ne"),
    ("<article><h1>T</h1><p>one\n two</p><div class='ad'>buy</div><p>three</article><footer>f</footer>", "T\none two\nthree"),
    ("<article><header><h1>T</h1></header><p>one<section id=comments><p>first!</section></article>", "T\none"),
    (f"<nav><a href=x>Home</a></nav><h2>Title</h2><p>{SENTENCE}<p>Short.<div class=sidebar>{SENTENCE}</div>",
     f"Title\n{SENTENCE}\nShort."),
    (f"<p>{SENTENCE}<ul><li><a>x y</a><li><a>z</a></ul><p>Next to links.<ul><li><a>x y</a></ul>", SENTENCE),
    (f"<form><label>Your name</label><p>{SENTENCE}</form><p>Text", "Text"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
    ("<title>no</title><p>a<p >b</P\n>c", "a\nb\nc"),
    (f"<article><p title=it's>{SENTENCE}</p><p data-x='a>b' y=\"c>d\" z=\"o'p\">two</article>", f"{SENTENCE}\ntwo"),
    ("<!--><p>one<!---><p>two<!-- > no --><p>three", "one\ntwo\nthree"),
    (f"<article><p>{SENTENCE}<div class='ad-type-banner'>Buy now</div><p class='post type-post'>two</article>",
     f"{SENTENCE}\ntwo"),
    (f"<main><div class='page-header'><h1>Title</h1></div><p>{SENTENCE}</main>", f"Title\n{SENTENCE}"),
    (f"<div class='no-ads has-sidebar'><p>{SENTENCE}</div>", SENTENCE),
])
def test_blocks(page, text):
    assert html.main_text(page) == text


def test_open_blocks_follow_their_neighbours():
    T, O, B = html.TEXT, html.OPEN, html.BOILERPLATE
    assert html.settle([O, O]) == [T, T]
    assert html.settle([T, O, O, O, B]) == [T, T, T, B, B]
    assert html.settle([O, B, O, O, T, O]) == [B, B, B, T, T, T]
    assert html.settle([]) == []


@pytest.mark.parametrize("page", ["<div>" * 50000, "<p " * 50000, "<p a=" * 30000, "<p a='" * 20000, "<p =\"" * 20000, '<a "' * 20000, "<b></p>" * 50000, "<b><p></i>" * 20000,
                                  "<!--" * 20000, "&amp" * 50000])
def test_time_grows_with_the_page(page):
    html.main_text(page)


def test_pages_of_the_table_give_their_articles(spark, sf_dir):
    import html as library
    import re

    pages = read_table(spark, sf_dir, "pages")
    rows = by_id(html.page_digest(pages))
    for page in pages.collect():
        inside = page.html[page.html.index("<article>") + 9:].split("</article>")[0]
        parts = (re.sub(r"\s+", " ", library.unescape(re.sub("</?b>", "", part))).strip()
                 for part in re.split(r"</?(?:h1|p|br)\b[^>]*>", inside))
        text = "\n".join(part for part in parts if part)
        assert rows[page.page_id] == [(page.url, text, len(text))]


def test_odd_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, None, ""), (3, "v", "<p>" + "word " * 60000)]
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], "page_id long, url string, html string, text string, HTML string")
    found = by_id(html.page_digest(frame))
    assert found[1] == [("u", "a", 1)] * 2 and found[None] == [(None, "", 0)] and found[2] == [(None, "", 0)]
    assert found[3][0][2] == 299999
    assert html.page_digest(frame.limit(0)).count() == 0


LONG = " ".join([SENTENCE] * 3)
TEASER = "<article><h3>Other</h3><p>A teaser of another page that is on the side.</p></article>"


@pytest.mark.parametrize("page, text", [
    (f"<div><p>{LONG}</p><p>Short.</p></div><aside>{TEASER}</aside>", f"{LONG}\nShort."),
    (f"<div><p>{LONG}</p></div><section class=comments><article><p>{SENTENCE}</p></article></section>", LONG),
    (f"<div><p>{LONG}</p></div><article class='comment'><p>{SENTENCE}</p></article>", LONG),
    (f"<div><p>{LONG}</p></div><article class='related'><p>{SENTENCE}</p></article>", LONG),
    (f"<div><p>{LONG}</p></div><article><a href=x>More</a> <a href=y>of this</a></article>", LONG),
    (f"<article class='post comments-open tag-social'><p>{LONG}</article><div class=comments><p>{LONG} {LONG}</div>", LONG),
])
def test_marks_in_frames_are_none(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<html class='no-touch search'><body class='has-sidebar social'><p>{LONG}</p></body>", LONG),
    (f"<div class='content no-sidebar'><article><h1>T</h1><p>{LONG}</p></article></div>", f"T\n{LONG}"),
    (f"<div class='article share-enabled'><h1>T</h1><p>{LONG}</p></div>", f"T\n{LONG}"),
    (f"<div class='social'><h1>T</h1><p>{LONG}</p><div class=sidebar>{SENTENCE}</div></div>", f"T\n{LONG}"),
    (f"<article><h2 id=form-validation>H</h2><p class=notice>Short.</p><section id=related-work><h3>W</h3><p>{SENTENCE}"
     f"</section><div class=related><a>x y</a></div></article>", f"H\nShort.\nW\n{SENTENCE}"),
    (f"<body><form id=aspnetForm><nav><a>x</a></nav><h1>T</h1><p>{LONG}</p></form><p>Imprint", f"T\n{LONG}\nImprint"),
    (f"<p>{LONG}<p class=notice>{SENTENCE}<p class=copyright>Of the firm.", f"{LONG}\n{SENTENCE}"),
    (f"<p>{LONG}</p><section class=comments><p>{LONG} {LONG}</section><div class=ad>{LONG}</div>", LONG),
])
def test_text_outvotes_words_in_names(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page", ["<div class=social>" * 50000 + LONG, "<div class=ad>x</div>" * 50000])
def test_time_grows_with_the_frames(page):
    html.main_text(page)
