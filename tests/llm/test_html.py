"""Pages on which the ratios decide, against the ratio, smoothing and clusters written out."""

import math
import random
import re
import statistics
import time

import numpy as np
import pytest

from shelfwise.llm import html_text

LONG = "Some long running text that goes on for a while, as the text of an article does. " * 3
CARDS = "".join(f"<div><a href=/{k}>Card {k}</a></div>" for k in range(12))


def brute_clusters(sizes, tags, sigma=html_text.SIGMA):
    ratios = [s / max(1, t) for s, t in zip(sizes, tags)]
    reach = max(1, math.ceil(3 * sigma))
    smooth = []
    for i in range(len(ratios)):
        near = [(ratios[j], math.exp(-0.5 * ((i - j) / sigma) ** 2)) for j in range(len(ratios)) if abs(i - j) <= reach]
        smooth.append(sum(r * w for r, w in near) / sum(w for _, w in near))
    limit = min(statistics.pstdev(smooth), max(smooth))
    return [x >= limit for x in smooth]


@pytest.mark.parametrize("seed", range(20))
def test_clusters(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 60)
    sizes, tags = [rng.choice((3, 12, 300, 900)) + rng.random() for _ in range(n)], [rng.randint(0, 9) for _ in range(n)]
    assert html_text.clusters(np.array(sizes), np.array(tags)).tolist() == brute_clusters(sizes, tags)


def test_ratios_choose_the_region():
    page = f"<body><div id=a>{CARDS}</div><div id=b><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div id=c>{CARDS}</div></body>"
    assert html_text.main_text(page) == "\n\n".join([LONG.strip(), "Short.", LONG.strip()])


def test_ratios_choose_against_article_elements(monkeypatch):
    teasers = "".join(f"<article><b><i><a href=/{k}>Teaser {k} of some words</a></i></b></article>" for k in range(60))
    page = f"<body><div>{teasers}</div><div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div></body>"
    want = "\n\n".join(["Title", LONG.strip(), LONG.strip()])
    assert html_text.main_text(page) == want
    monkeypatch.setattr(html_text, "smoothed", lambda ratios, sigma=1.0: np.ones(len(ratios)))
    assert html_text.main_text(page) != want


def test_links_outside_the_clusters_go(monkeypatch):
    page = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p>A <a href=x>linked</a> word.</p><ul>{''.join(f'<li><a href=/t{k}>tag {k}</a></li>' for k in range(15))}</ul></article>"
    got = html_text.main_text(page).split("\n\n")
    assert got[:4] == ["Title", LONG.strip(), LONG.strip(), "A linked word."] and "tag 14" not in got
    monkeypatch.setattr(html_text, "smoothed", lambda ratios, sigma=1.0: np.ones(len(ratios)))
    assert "tag 14" in html_text.main_text(page)


def test_several_articles_and_titles_stay():
    page = f"<main><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG}</p><ul><li>a<li>b<li>c</ul></article></main>"
    assert html_text.main_text(page) == "\n\n".join(["One", LONG.strip(), "Two", LONG.strip(), "a", "b", "c"])


def test_deep_and_long_pages_take_time_in_proportion():
    def seconds(n):
        page = "<div>" * n + f"<p>{LONG}</p>" + "<b>x" * n + "</div>" * n
        start = time.process_time()
        assert html_text.main_text(page).startswith("Some long")
        return time.process_time() - start

    seconds(1_000)
    assert seconds(40_000) < 60 * seconds(4_000) + 1
    text = "word " * 1_000_000
    assert html_text.main_text(f"<article><p>{text}</p></article>") == text.strip()


def test_empty_table_and_clashing_columns(spark):
    kinds = "page_id long, url string, html string, text string, n_chars string, open string"
    assert html_text.extract(spark.createDataFrame([], kinds), ["page_id", "url", "text", "open"]).columns == ["page_id", "url", "open", "text", "n_chars"]
    rows = [(1, "u", "<p>a &amp; b</p>", "old", "9", "kept")]
    assert [tuple(r) for r in html_text.extract(spark.createDataFrame(rows, kinds), ["page_id", "text", "n_chars", "open"]).collect()] == [(1, "kept", "a & b", 5)]
    assert re.fullmatch("a & b", html_text.main_text(rows[0][2]))
