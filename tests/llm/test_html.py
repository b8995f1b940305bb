"""Main text: planted pages, the cut against brute force, and broken markup."""

import random
import re
from html import unescape
from itertools import product

import pytest

from cartloom.llm import html
from cartloom.llm.queries import QUERIES

LINE = "The council voted on the new bridge after a long and lively debate."
ARTICLE = f"<h1>Bridge &amp; river</h1><p>{LINE}</p><div><p>A second\n\t paragraph &#8211; with   spaces.</p></div><p>Short one</p>"
TEXT = f"Bridge & river\n{LINE}\nA second paragraph – with spaces.\nShort one"
BOILER = {
    "nav": '<nav><ul><li><a href="/">Home</a><li><a href="/x">All our news and other things.</a></ul></nav>',
    "menu": f'<div id="main-menu"><p>{LINE}</p></div>',
    "header": f"<header><h2>Daily Paper</h2><p>{LINE}</p></header>",
    "footer": f"<footer><p>&copy; 2020 Paper. {LINE}</p></footer>",
    "aside": f"<aside><p>{LINE}</p></aside>",
    "sidebar": f'<div class="leftSidebar"><p>{LINE}</p></div>',
    "cookie": f'<div class="cookie-notice"><p>{LINE}</p></div>',
    "advert": f'<div class="ad"><p>{LINE}</p></div>',
    "form": f'<form action="/s"><label>Your name</label><p>{LINE}</p><textarea>{LINE}</textarea><button>Send now.</button></form>',
    "comments": f'<section id="comments"><article class="comment"><p>{LINE}</p></article></section>',
    "script": f"<script>document.write('<p>{LINE}</p>')</script><style>p{{content:'{LINE}'}}</style><!-- {LINE} --><noscript>{LINE}</noscript>",
    "hidden": f'<div style="display: none"><p>{LINE}</p></div>',
}


@pytest.mark.parametrize("kind", BOILER)
@pytest.mark.parametrize("frame", ["<article>{}</article>", '<div class="story">{}</div>'])
def test_boilerplate_around_and_inside(kind, frame):
    around = f"<html><head><title>T {LINE}</title></head><body>{BOILER[kind]}{frame.format(ARTICLE)}{BOILER[kind]}</body></html>"
    assert html.main_text(around) == TEXT
    if kind not in ("header",):
        inside = frame.format(ARTICLE + BOILER[kind])
        assert html.main_text(f"<body>{inside}</body>") == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<article><p>Open <b>bold", "Open bold"), ("<article><p>a &lt;b&gt; &amp;amp; c<br>d</p>", "a <b> &amp; c d"),
        ("<article><p>one two three four five six.<p>x<p>seven eight nine ten eleven twelve.", "one two three four five six.\nx\nseven eight nine ten eleven twelve."),
        ('<article><p title="a > b">in &nbsp; side</p><p class="x>broken quote</p></article>', "in side\nbroken quote"),
    ],
)
def test_small_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("frame", ['<div id="page" class="right-sidebar">{}</div>', '<div class="site no-sidebar"><div class="no-comments">{}</div></div>', '<p>A line of the paper that stands outside of it all.</p><div class="no-ads">{}</div>'])
def test_layout_words_around_the_article(frame):
    for inner in (f"<article>{ARTICLE}</article>", f'<div class="story">{ARTICLE}</div>'):
        page = frame.format(f"{BOILER['nav']}{BOILER['sidebar']}{inner}{BOILER['comments']}{BOILER['footer']}")
        assert TEXT in html.main_text(page)
        assert html.main_text(page).count(LINE) == 1


def test_vetoed_text_alone_stays_out():
    for kind in ("sidebar", "cookie", "advert", "comments", "hidden"):
        assert html.main_text(f"<body>{BOILER[kind]}</body>") == ""


@pytest.mark.parametrize("lines", [["市议会在漫长而热烈的辩论之后投票通过了新桥的建设计划。", "新桥将于明年春天开工，预计耗资三千万元。"], ["สภาเมืองลงมติเกี่ยวกับสะพานใหม่หลังจากการอภิปรายที่ยาวนาน"], ["The new bridge opened today.", "Many people came to see it."]])
def test_paragraphs_of_few_spaced_words(lines):
    page = BOILER["nav"] + "<div>" + "".join(f"<p>{x}</p>" for x in lines) + "</div>" + BOILER["footer"]
    assert html.main_text(page) == "\n".join(lines)


def test_long_page():
    page = "<body><nav><a href=x>menu</a></nav><main>" + f"<p>{LINE}</p>" * 3000 + '<p class="' * 500 + "</main></body>"
    assert html.main_text(page).split("\n")[:3000] == [LINE] * 3000


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 9)
        score = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(i, i + 1, rng.randint(0, 6)) for i in range(n - 1)] + [(i, j, rng.randint(1, 4)) for i in range(n) for j in range(i + 2, n) if rng.random() < 0.2]

        def cost(label):
            return sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(score, label)) + sum(w for u, v, w in edges if label[u] != label[v])

        assert cost(html.min_cut(score, edges)) == min(map(cost, product([False, True], repeat=n)))


def test_query_on_given_pages(spark):
    """The given pages keep their article in an article element."""
    path = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    got = QUERIES["op1_html_extract"](spark, path).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        lines = [" ".join(unescape(re.sub(r"<(?!p|/p|h1|/h1)[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)


def test_rows(spark):
    rows = [(1, "u", None), (1, "u", f"<p>{LINE}</p>"), (None, None, f"<p>{LINE}</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS extra")
    out = html.extract(pages)
    assert out.columns == ["page_id", "url", "extra", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.extra) for r in out.collect()) == [(0, LINE, len(LINE), 2), (1, "", 0, 2), (1, LINE, len(LINE), 2)]
    assert html.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("frame", [
    '<article><h1>On rivers</h1>{}<section class="comments">{}</section></article>',
    '<main>{}<div id="comments">{}</div></main>',
    '<div id="content">{}</div><div id="comments">{}</div>',
    '<div class="has-comments no-sidebar"><div class="post">{}</div><ol class="comment-list">{}</ol></div>',
])
@pytest.mark.parametrize("shape", ["<p>{}</p>", '<div class="comment"><p>{}</p></div>', '<article class="comment"><p>{}</p><p>And that is all I have to say about it today.</p></article>', "<article><p>{}</p></article>"])
def test_comments_stay_out_whatever_their_length(frame, shape):
    for n, m in product((1, 2, 5), (2, 8, 20)):
        if shape == "<article><p>{}</p></article>" and frame.startswith("<article>"):
            continue  # articles in an article are told apart by nothing
        article = "".join(f"<p>The river {k} rises in the hills, crosses the plain and reaches the sea after many days.</p>" for k in range(n))
        said = "".join(shape.format(f"I walked along it {k} years ago with my sister, and we both still speak of that long and happy summer.") for k in range(m))
        text = html.main_text(f"<html><body>{frame.format(article, said)}</body></html>")
        assert "walked" not in text and "have to say" not in text, (n, m)
        assert text.count("reaches the sea") == n
