import html
import re

import pyarrow.parquet as pq
import pytest

from tableworks.llm import extract

ARTICLE = "<h1>A title here</h1><p>First paragraph, with a comma. And more.</p><p>Second one; it is longer, as it goes on.</p>"
WANT = "A title here\nFirst paragraph, with a comma. And more.\nSecond one; it is longer, as it goes on."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>(c) 2020, all rights.</footer></body></html>",
    f"<body><ul class='main-menu'><li><a>One</a><li><a>Two</a></ul><div id=content>{ARTICLE}</div><div class='sidebar'>Some side text, with commas, and so on. Really.</div>",
    f"<body><header>Site</header><main>{ARTICLE}<section class=comments><p>I like this, very much. Really, I do.</p></section></main>",
    f"<div class=AdBox>x</div><div class='cookie-notice'>We use cookies, as all do. Accept?</div><div>{ARTICLE}<form><p>Your name, please: <input></p></form></div>",
    f"<div><a href=1>Home</a> | <a href=2>News</a></div><div><!-- <p>old, text.</p> -->{ARTICLE}</div><div><a href=3>Privacy policy</a></div>",
    f"<body><article>{ARTICLE}<aside>Read also: this, that.</aside><div hidden>not, shown.</div><style>p{{}}</style></article>",
])
def test_templates(page):
    assert extract.main_text(page) == WANT


def test_broken_markup():
    cases = {
        "<article><p><b>Bold, first.<br><p>Next one, yes.</article>": "Bold, first.\nNext one, yes.",
        "<article><p>a &lt; b &amp; c&nbsp;d &copy 1 < 2, ok.</p></article>": "a < b & c d © 1 < 2, ok.",
        "<article><p>Cut off, here. <a href=\"x": "Cut off, here.",
        "<article><p title='a > b'>Quoted, tag.</p></article>": "Quoted, tag.",
        "<article><p>x<script>if (a<b) {}</script>y, z.</p><p>  two\n\twords </p></article>": "x y, z.\ntwo words",
        "plain text, no tags. Really.": "plain text, no tags. Really.",
        "": "", "<p></p>": "", "<nav>Menu, only.</nav>": "", "</p></div>": "", "<": "<", "<!--": "", "<script>": "",
    }
    for page, text in cases.items():
        assert extract.main_text(page) == text, page
    assert extract.main_text(None) == ""


def test_long_and_deep_pages():
    assert extract.main_text("<article>" + "<p>Words, words.</p>" * 20000 + "</article>").count("\n") == 19999
    assert extract.main_text("<div>" * 5000 + "deep, text." + "</div>" * 5000) == "deep, text."
    assert extract.main_text("<p " * 3000) == ""


def test_pages_of_the_tables():
    """Against the article element cut out by a pattern, paragraph by paragraph."""
    for row in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        body = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", body)
        lines = [" ".join(html.unescape(re.sub(r"<[^<>]*>", " ", p)).split()) for p in parts]
        assert extract.main_text(row["html"]) == "\n".join(x for x in lines if x), row["page_id"]


def test_tables(spark):
    rows = [(1, "u", "<p>One, text.</p>", "x"), (2, None, None, "x"), (1, "u", "<p>One, text.</p>", "x"), (None, "v", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = sorted((str(r.page_id), r.main_text) for r in extract.extract(df).collect())
    assert got == [("1", "One, text."), ("1", "One, text."), ("2", ""), ("None", "")]
    assert extract.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("page", [
    f"<body><div class='layout has-sidebar'><article>{ARTICLE}</article><div class=sidebar>Side text, and so on. Really.</div></div>",
    f"<body><div class='with-comments'><main>{ARTICLE}<section class=comments><article>I like this, really.</article></section></main></div>",
    f"<body><main><div class='no-nav'><article>{ARTICLE}</article></div></main>",
    f"<body><section class='notice'><article>{ARTICLE}</article></section><div class='cookie-notice'>We use cookies, as all do.</div>",
    f"<body><div id='form-page'><div>{ARTICLE}</div><div class=share>Share this, now.</div></div><div><a href=1>Privacy policy</a></div>",
])
def test_names_of_wrappers(page):
    """Words in a class or id of what holds the article leave it alone; smaller parts go."""
    assert extract.main_text(page) == WANT


def test_an_advert_longer_than_the_article():
    page = "<div class=ad>Buy this, now. It is good, and so on.</div><article><h1>Short.</h1><p>One.</p></article>"
    assert extract.main_text(page) == "Short.\nOne."


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm><article>{ARTICLE}</article></form>",
    f"<body><div role=form><article>{ARTICLE}</article></div><div role=search>Find, here. Or there.</div>",
    f"<body><form action=x><div>{ARTICLE}</div><div class=footer>All rights, reserved.</div></form>",
    f"<body><div role=dialog><main>{ARTICLE}</main></div><dialog>Accept, please.</dialog>",
    f"<body><main>{ARTICLE}<form><p>Write, to us.</p></form><div role=alert>Note, this.</div></main>",
])
def test_forms_and_roles(page):
    """A form or role on what holds the article leaves it alone; smaller ones go."""
    assert extract.main_text(page) == WANT


@pytest.mark.parametrize("part", [
    "<ul><li><a href=1>Another article</a></li><li><a href=2>And one more</a></li></ul>",
    "<div><a href=3>Buy now our product</a></div>",
    "<section><h2>3 Comments</h2><div><p>I like this, very much. Really, I do.</p></div><div><p>Me too, of course.</p></div></section>",
    "<div><h3>Leave a reply</h3><p>Say something, please. Be kind.</p></div>",
])
def test_parts_inside_the_article(part):
    """Link lists, adverts and comments without telling names are no text."""
    assert extract.main_text(f"<body><article>{ARTICLE}{part}</article>") == WANT


def test_short_parts_of_the_article_stay():
    page = f"<article>{ARTICLE}<h2><a href=1>Next</a></h2><ul><li>One</li><li>Two <a href=2>x</a> words</li></ul><p><a href=3>All link</a></p><h3>Comments</h3><p>As I said, before.</p></article>"
    assert extract.main_text(page) == WANT + "\nNext\nOne\nTwo x words\nAll link\nComments\nAs I said, before."
