import html
import re

import pytest

from quarterwise.llm import html_text, queries
from quarterwise.llm.html_text import Page, extract

WORDS = "Plain sentences that tell a reader something worth knowing, at some length, one after another. "


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("a &lt; b &amp;&nbsp; c<br>d", "a < b & c d"),
        ("<p>one<p>two<!-- gone --><p>three", "one\n\ntwo\n\nthree"),
        ("<script>var a='</p>';</script><p>x</p><style>p{}</style>", "x"),
        ("<p>open <b>bold <i>it", "open bold it"),
        ("</div><p>a</p></p></span>b", "a\n\nb"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<p title='a>b' data-x=\"<p>\">q</p>", "q"),
        ("<p>x<!-- never ends", "x"),
        ("<p>x<a href='never ends", "x"),
        ("<pre>a\n  b</pre>", "a b"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ],
)
def test_reading(source, text):
    assert extract(source)[0] == text


def test_other_parts_are_left_out():
    body = "".join(f"<p>{WORDS * 2}{k}</p>" for k in range(4))
    parts = [
        "<header><h1>Site</h1></header>", "<nav><a href=/>Home</a></nav>", '<div class="top-menu"><a href=/a>A</a></div>', '<div id="cookie-notice">We use cookies.</div>',
        '<div class="ad">Buy now</div>', "<form><p>Name</p><input></form>", "<aside><p>Aside</p></aside>", '<div class="sidebar"><p>Side</p></div>',
        '<section id="comments"><p>First!</p></section>', '<div role="navigation">Go</div>', '<p style="display: none">hidden</p>', "<footer>End</footer>",
    ]
    expected = "\n\n".join(f"{WORDS * 2}{k}" for k in range(4))
    for tag in ("article", "div"):
        text, path = extract(f"<html><head><title>T</title></head><body>{''.join(parts)}<{tag}>{parts[4]}{body}{parts[8]}</{tag}>{''.join(parts)}</body></html>")
        assert text == expected and path.endswith(tag)


def test_links_without_a_mark_are_below_the_threshold():
    links = "<ul>" + "".join(f"<li><a href=/{k}>Link number {k}</a></li>" for k in range(30)) + "</ul>"
    body = "".join(f"<p>{WORDS * 3}{k}</p>" for k in range(5))
    text, _ = extract(f"<body><div>{links}</div><div>{body}</div><div>{links}</div></body>")
    assert text == "\n\n".join(f"{WORDS * 3}{k}" for k in range(5))


def test_long_and_deep_pages():
    deep = "<div>" * 30_000 + "deep" + "</div>" * 30_000
    assert extract(deep)[0] == "deep"
    assert extract("<" * 100_000)[0].count("<") == 100_000
    assert extract("<p>" + "word " * 300_000)[0].count("word") == 300_000
    assert len(Page("<a b=" * 20_000).tag) >= 1


def test_every_given_page(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in queries.QUERIES["op10_main_text"](spark, small).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>)", pages[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner)))
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_messy_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (1, "u", "<p>a</p>", None), (1, "u", "<p>a</p>", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = html_text.main_text(pages).selectExpr("row.page_id", "row.text as own", "text").collect()
    assert sorted(r.text for r in out) == ["", "", "a", "a"]
    assert html_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ["section", "div", "article"])
@pytest.mark.parametrize("sizes", [(2, 3), (8, 10), (3, 2, 4), (1, 6)])
def test_siblings_that_hold_the_text_are_all_kept(tag, sizes):
    parts = [[f"Part {i}", *(f"{WORDS * 2}{i} {k}" for k in range(n))] for i, n in enumerate(sizes)]
    inner = "".join(f"<{tag}><h2>{h}</h2>{''.join(f'<p>{p}</p>' for p in ps)}</{tag}>" for h, *ps in parts)
    outside = "".join(f"<h2>{h}</h2><{tag}>{''.join(f'<p>{p}</p>' for p in ps)}</{tag}>" for h, *ps in parts)
    links = "<ul>" + "".join(f"<li><a href=/{k}>Link number {k}</a></li>" for k in range(30)) + "</ul>"
    for body in (inner, outside):
        assert extract(f"<body>{links}<div id=content>{body}</div>{links}</body>")[0] == "\n\n".join(b for p in parts for b in p)


@pytest.mark.parametrize("wrapper", ["layout has-sidebar", "no-comments", "with-cookie-notice", "post share-enabled", "content sidebar", "widget"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_layout_classes_do_not_drop_the_article(wrapper, tag):
    body = "".join(f"<p>{WORDS * 2}{k}</p>" for k in range(4))
    source = f'<body><nav><a href=/>Home</a></nav><div class="{wrapper}"><{tag}>{body}<div class="ad">Buy now</div></{tag}></div><div class="comments"><p>First!</p></div></body>'
    assert extract(source)[0] == "\n\n".join(f"{WORDS * 2}{k}" for k in range(4))


def test_parts_of_an_article_are_not_dropped_by_a_word_in_their_class():
    body = "".join(f"<p>{WORDS * 2}{k}</p>" for k in range(4))
    comments = "".join(f"<div><p>{WORDS * 3}</p></div>" for _ in range(9))
    text, _ = extract(f'<body><article>{body}<p class="notice">Note this.</p><section class="related-work"><p>{WORDS}</p></section><section id="comments">{comments}</section></article></body>')
    assert text == "\n\n".join([*(f"{WORDS * 2}{k}" for k in range(4)), "Note this.", WORDS.strip()])
