"""Main text of pages: hand-made pages, brute-force smoothing, robustness."""

import random
import time

import numpy as np
import pytest

from scanlake.llm import html_extract

HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>'
MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
FOOT = "<footer>&copy; 2024 all rights</footer></body></html>"


def words(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))


LONG = [words(40, i) for i in range(5)]

PAGES = {
    "article": (
        f"{HEAD}{MENU}<article><h1>Big &amp; small</h1><p><b>{LONG[0]}<br><p>{LONG[1]}\n\t x </p></article>{FOOT}",
        f"Big & small {LONG[0]} {LONG[1]} x",
    ),
    "short lines of the article stay": (
        f"{HEAD}{MENU}<article><header><h1>A</h1></header><p>{LONG[0]}</p><p>ok.</p><p>{LONG[1]}</p></article>{FOOT}",
        f"A {LONG[0]} ok. {LONG[1]}",
    ),
    "beside the article": (
        f'{HEAD}<header>Site</header><div class="cookie-notice">We use cookies {LONG[2]}</div><article><p>{LONG[0]}</p>'
        f'<div class="ad">Buy {LONG[3]}</div><form><p>Mail</p></form><p>{LONG[1]}</p><section id="comments"><p>{LONG[4]}</p></section>'
        f'</article><aside class="x">{LONG[2]}</aside>{FOOT}',
        f"{LONG[0]} {LONG[1]}",
    ),
    "no article": (
        f'{HEAD}{MENU}<div id="wrap"><div><p>{LONG[0]}</p><p>{LONG[1]}</p></div></div><div class="sidebarBox"><p>{LONG[2]}</p></div>{FOOT}',
        f"{LONG[0]} {LONG[1]}",
    ),
    "bare text": ("just  some\ntext &lt;b&gt; &#233;", "just some text <b> é"),
    "unclosed": (f"<html><body><article><p>{LONG[0]}<p>{LONG[1]}", f"{LONG[0]} {LONG[1]}"),
    "hidden": (f'<article><p hidden>x</p><p style="display: none">y</p><p>{LONG[0]}</p></article>', LONG[0]),
    "textless": (f"{HEAD}{MENU}{FOOT}", ""),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_pages(name):
    html, expected = PAGES[name]
    assert html_extract.main_text(html) == expected


CLUSTERS = {
    "a short article beside the text": (
        f'{HEAD}{MENU}<article><a href="/x">Read on</a></article><div><p>{LONG[0]}</p><p>{LONG[1]}</p><p>{LONG[2]}</p></div>{FOOT}',
        f"{LONG[0]} {LONG[1]} {LONG[2]}",
    ),
    "the text goes on after the article": (
        f"{HEAD}<article><h1>A</h1><p>{LONG[0]}</p></article><div><p>{LONG[1]}</p><p>{LONG[2]}</p></div><div><b>x</b></div>{FOOT}",
        f"A {LONG[0]} {LONG[1]} {LONG[2]}",
    ),
    "one of two articles": (
        f"{HEAD}<article><h2><a href='/'>Other</a></h2></article><article><h1>A</h1><p>{LONG[0]}</p><p>ok.</p></article><div>Home</div>{FOOT}",
        f"A {LONG[0]} ok.",
    ),
}


@pytest.mark.parametrize("name", list(CLUSTERS))
def test_clusters_decide_and_elements_only_widen_them(name):
    html, expected = CLUSTERS[name]
    assert html_extract.main_text(html) == expected


SHORTS = [f"short {w}." for w in "one two three four five six seven".split()]
WHOLE = {
    "head without its end": (f"<html><head><title>T</title><script>x</script><body><p>{LONG[0]}</p><p>{LONG[1]}</p>", f"{LONG[0]} {LONG[1]}"),
    "head without its end and no body": (f"<head><meta charset=x><title>T</title><p>{LONG[0]}</p><div>{LONG[1]}</div>", f"{LONG[0]} {LONG[1]}"),
    "text in the head": (f"<head><title>T</title>{LONG[0]}", LONG[0]),
    "wrapper with a word": (f'<body><div class="content has-sidebar"><p>{LONG[0]}</p><p>{LONG[1]}</p></div>{FOOT}', f"{LONG[0]} {LONG[1]}"),
    "title in a post-header": (f'<article><div class="post-header"><h1>A</h1></div><p>{LONG[0]}</p></article>', f"A {LONG[0]}"),
    "title in a header": (f'<article><div class="header"><h1>A</h1></div><p>{LONG[0]}</p></article>', f"A {LONG[0]}"),
    "body of widgets": (
        f"<body><header>Site</header>{''.join(f'<div class=widget><p>{x}</p></div>' for x in LONG)}<div class='ad'>{words(9)}</div>{FOOT}", " ".join(LONG),
    ),
    "links in a sidebar": (
        f"<body><div><p>{LONG[0]}</p></div><div class=sidebar>{''.join(f'<p><a href=x>{x}</a></p>' for x in LONG[1:])}</div>{FOOT}", LONG[0],
    ),
    "comments are longer": (f"<body><div><p>{LONG[0]}</p></div><div id=comments>{''.join(f'<p>{x}</p>' for x in LONG[1:])}</div>{FOOT}", LONG[0]),
    "short lines inside the body": (
        f"<body><div><p>{LONG[0]}</p><p>{LONG[1]}</p><ul>{''.join(f'<li>{x}' for x in SHORTS)}</ul><p>{LONG[2]}</p></div>{FOOT}",
        " ".join([LONG[0], LONG[1], *SHORTS, LONG[2]]),
    ),
    "paragraphs in boxes": (
        f"<body><div><div><p>{LONG[0]}</p></div><div>{''.join(f'<p>{x}</p>' for x in SHORTS)}</div><div><p>{LONG[2]}</p></div></div>{FOOT}",
        " ".join([LONG[0], *SHORTS, LONG[2]]),
    ),
    "short lines at both ends": (
        f"<div><h1>Title here</h1><p>Short one.</p><p>Go.</p><p>{LONG[0]}</p><p>Bye.</p><p>And so on.</p><p>End of it.</p></div>",
        f"Title here Short one. Go. {LONG[0]} Bye. And so on. End of it.",
    ),
    "a formula": ("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>mc</mi><annotation>E=m c</annotation></math> as known</p></article>", "Energy is E=mc as known"),
}


@pytest.mark.parametrize("name", list(WHOLE))
def test_no_part_of_the_content_is_lost(name):
    html, expected = WHOLE[name]
    assert html_extract.main_text(html) == expected


def test_query_shape_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", PAGES["article"][0], 5, "old"), (1, "u", PAGES["article"][0], 5, "old"), (2, None, None, 0, None), (None, "v", "", 1, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    found = html_extract.extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    expected = PAGES["article"][1]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "u", expected, len(expected))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str
    )
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_smoothing_equals_the_sum():
    values = np.random.default_rng(0).random(9)
    for i, got in enumerate(html_extract.smoothed(values, 1.0, 2)):
        near = [(values[j], np.exp(-((i - j) ** 2) / 2)) for j in range(9) if abs(i - j) <= 2]
        assert got == pytest.approx(sum(v * w for v, w in near) / sum(w for _, w in near))


def test_any_text_is_parsed():
    r = random.Random(3)
    parts = ["<", ">", "</p>", "<p", "<!--", "-->", "<script>", "</script>", "&#x", "&amp", "<article>", "a b", '"', "<a href='", "\0", "é", "<![CDATA["]
    for _ in range(300):
        html = "".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        text = html_extract.main_text(html)
        assert text == " ".join(text.split())
    assert len(html_extract.main_text("<article><p>" + "word " * 400_000)) == 5 * 400_000 - 1
    assert html_extract.main_text("<div>" * 20_000 + LONG[0]) == LONG[0]


@pytest.mark.parametrize("part", ["<a ", "<!--", "<![", "</a ", "<a b='", '<a b="', "<?", "<!", "<", "</", "<a b=", "<script>", "<a b='>", "<!-->", "&", "<p/", "<b>", "</b>"])
@pytest.mark.parametrize("end", ["", ">", "-->", "<h1></h1></i>" * 5_000])
def test_broken_markup_takes_linear_time(part, end):
    start = time.perf_counter()
    html_extract.main_text(f"<p>{LONG[0]}</p>" + part * ((100_000 if end else 1_000_000) // len(part)) + end)
    assert time.perf_counter() - start < 20


def test_unfinished_markup_ends_the_page():
    for rest in ("<a href=", "<!-- x", "</p", "<!-- a > b"):
        assert html_extract.main_text(f"<p>{LONG[0]}</p>{rest} more text") == LONG[0]
    assert html_extract.main_text(f"<p>{LONG[0]} a < b</p>") == f"{LONG[0]} a < b"
