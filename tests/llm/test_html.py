import random
import time
from html.parser import HTMLParser

import pytest

from postloom.llm.html_text import VOID, extract, main_text, parse, text_of

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a < b) "</p>"</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">Menu</a></ul></nav>
<div id="cookie-banner"><p>We use cookies, for you, and us, all the time, everywhere.</p></div>
<article class="post"><h1>The &amp; title</h1><p>First   paragraph,
with commas, and <b>bold</b> text &copy; us.<p>Second one, <a href="/l">linked</a>, is longer than the first one by far.
<div class="ad">Buy now, cheap</div><form><p>Sign up</p></form><ul><li>point one<li>point two</ul></article>
<aside><p>Side, bar, with, commas, and a lot of text in it to mislead.</p></aside>
<div class="comments"><p>Nice, good, great, wonderful, and so on, and so forth, indeed.</p></div>
<footer>&copy; no</footer></body></html>"""
TEXT = "The & title First paragraph, with commas, and bold text © us. Second one, linked, is longer than the first one by far. point one point two"


def test_article():
    assert main_text(PAGE) == TEXT


def test_without_article_element():
    page = PAGE.replace("<article class=\"post\">", "<div><div class=content>").replace("</article>", "</div></div>")
    assert main_text(page) == TEXT


def test_edges():
    assert main_text(None) == main_text("") == main_text(" ") == main_text("<script>x") == main_text("<nav>x</nav>") == ""
    assert main_text("<p>only") == "only" and main_text("a < b &amp; c") == "a < b & c" and main_text("&lt;b&gt;") == "<b>"
    assert main_text("<p>x&nbsp;y<br>z<!-- no --></p>") == "x y z"
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    long = "word, " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()
    assert main_text("<p>in<b>li</b>ne</p><p>next") == "inline next"


def test_rows(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE)]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").selectExpr("*", "'t' AS text", "3 AS n_chars")
    assert sorted(extract(df).collect(), key=str) == sorted([(1, "u", TEXT), (2, None, ""), (None, "v", ""), (1, "u", TEXT)], key=str)
    assert extract(df.limit(0)).count() == 0


STORY = "<p>A story, long enough, with commas, to be one of those that are told.</p>"
TOLD = "A story, long enough, with commas, to be one of those that are told."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p title=don't>one</p><p title='a>b' x=\"c>d\">two</p>", "one two"),
        ("<p a=\"b\"c='d'>x</p>", "x"),
        ("<!-->shown <!-- not --><!--->too<!-- a --!> end", "shown too end"),
        ("<p>a</p><!-- open", "a"),
        ("<p>a</p><b title='x", "a"),
        (f"<form action=/x><div>{STORY}</div></form>", TOLD),
        (f"<body><div class='content has-sidebar'>{STORY}</div><div class=sidebar>{STORY}</div>", TOLD),
        (f"<div class=elementor-widget-container>{STORY}</div>", TOLD),
        ("<p>1 < 2 <3</p>", "1 < 2 <3"),
    ],
)
def test_marks_and_wrappers(page, text):
    assert main_text(page) == text


def test_many_elements_and_open_quotes_take_seconds():
    begin = time.perf_counter()
    assert main_text("<div>" * 200_000 + "deep") == "deep"
    assert main_text("<p><table><tr><td>" + "<div>" * 50_000 + "deep") == "deep"
    assert main_text("<a b='" * 60_000 + '<a b="' * 60_000) == ""
    assert main_text("<li><b>" * 50_000 + "x").startswith("x")
    assert time.perf_counter() - begin < 30


class Plain(HTMLParser):
    """Text of a page by the standard reader; scripts and styles are left out by the pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text = []

    def handle_data(self, data):
        self.text.append(data)


def test_all_text_equals_that_of_another_reader():
    rng = random.Random(4)
    tags = ["p", "div", "b", "i", "span", "ul", "li", "table", "tr", "td", "br", "img", "h2", "blockquote"]
    attrs = ["", " a=b", " a='x > y'", ' a="&lt;"', " x=don't", " hidden2", " a = 'b'"]
    for _ in range(300):
        page = []
        for _ in range(rng.randrange(1, 40)):
            tag = rng.choice(tags)
            kind = rng.randrange(5)
            page.append(f"<{tag}{rng.choice(attrs)}>" if kind < 2 else f"</{tag}>" if kind == 2 and tag not in VOID else rng.choice(["x ", "&amp;", "y&eacute; ", "<!-- n -->", "&#65;"]))
        page = "".join(page)
        plain = Plain()
        plain.feed(page)
        plain.close()
        mine = "".join(t for t in text_of(parse(page)))
        assert "".join(mine.split()) == "".join("".join(plain.text).split()), page
