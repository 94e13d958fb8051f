"""Pages whose markup misleads, pages without menus, very large and very deep pages, and the cut on them."""

from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest

from shelfscout.llm import html

LINES = [
    "The river rises in the hills above the town, and for most of the year it is calm.",
    "In spring, when the snow melts, it floods the lower meadows; people there build on stilts.",
    "Nobody remembers a year without water in the streets, and few would want one.",
]
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in LINES)
MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
FOOT = "<footer>All rights reserved</footer>"


@pytest.fixture(scope="module")
def weights(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").select("html").collect()
    return html.fit_blocks([r.html for r in rows if r.html])


@pytest.mark.parametrize("body", [
    f'<article title="The hidden city">{PARAGRAPHS}</article>',
    f'<div class="content with-sidebar">{PARAGRAPHS}</div>',
    f'<div class="layout no-sidebar"><article>{PARAGRAPHS}</article></div>',
    f'<div class="has-header"><article>{PARAGRAPHS}</article></div>',
    f'<div class="sidebar-layout"><article>{PARAGRAPHS}</article></div>',
    f"<form action=/post><article>{PARAGRAPHS}</article></form>",
    f'<article><section class="share price">{PARAGRAPHS}</section></article>',
    f'<article data-note="aria-hidden=true display:none">{PARAGRAPHS}</article>',
])
@pytest.mark.parametrize("around", [("", ""), (MENU, FOOT)])
def test_wrappers_do_not_hide_the_article(weights, body, around):
    assert html.main_text(f"<html><body>{around[0]}{body}{around[1]}</body></html>", weights) == "\n".join(LINES)


@pytest.mark.parametrize("body", [f"<article>{PARAGRAPHS}</article>", f"<div>{PARAGRAPHS}</div>", PARAGRAPHS])
def test_page_of_only_an_article(weights, body):
    assert html.main_text(body, weights) == "\n".join(LINES)


def test_page_of_one_paragraph(weights):
    assert html.main_text(f"<p>{' '.join(LINES)}</p>", weights) == " ".join(LINES)


@pytest.mark.parametrize("other", [
    '<div class="comments"><p>%s</p></div>', '<section id="comments-list"><p>%s</p></section>', '<aside><p>%s</p></aside>', "<p hidden>%s</p>",
    '<div aria-hidden="true">%s</div>', "<div style='color:red; display : none'>%s</div>", '<div class="cookie-notice">Accept.</div>',
    '<form><fieldset><p>Your name</p></fieldset></form>',
])
def test_what_goes(weights, other):
    # Comments and the like go even where they hold most of the page.
    told = other.replace("%s", " ".join(["I have been there, and it was lovely indeed."] * 30))
    page = f"<html><body>{MENU}<article>{PARAGRAPHS}</article>{told}{FOOT}</body></html>"
    assert html.main_text(page, weights) == "\n".join(LINES)


def test_siblings_are_tied_across_what_stands_between():
    page = html.parsed("<article><p>a b</p><div class=ad><p>x</p></div><p>c d</p></article>")
    assert (0, 2, html.ACROSS) in page.edges() and [b.text for b in page.blocks] == ["a b", "x", "c d"]
    assert html.parsed("").edges() == [] and html.parsed("plain").edges() == []


def test_cut_on_random_graphs_against_all_labellings():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 9)
        content, boilerplate = ([rng.choice((0.0, rng.random() * 3)) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(labels):
            own = sum(content[i] if kept else boilerplate[i] for i, kept in enumerate(labels))
            return own + sum(c for a, b, c in edges if labels[a] != labels[b])

        least = min(cost(labels) for labels in itertools.product((True, False), repeat=n))
        assert abs(cost(html.least_cut(content, boilerplate, edges)) - least) < 1e-6


@pytest.mark.parametrize("make_page", [
    lambda n: "<body>" + "".join(f"<p>{LINES[i % 3]}</p>" if i % 3 else f"<div class=ad><a href=x>Buy {i}</a></div>" for i in range(n)),
    lambda n: "<div>some words, here. " * n,
    lambda n: "<div><b>" * n + LINES[0] + "</i>" * n,
    lambda n: "<li><a>x" * n,
], ids=["flat", "deep", "unclosed", "items"])
def test_time_grows_with_the_page(make_page, weights):
    seconds = []
    for n in (5_000, 40_000):
        page = make_page(n)
        start = time.perf_counter()
        html.main_text(page, weights)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 30 * max(seconds[0], 0.05), seconds


def test_repeats_of_a_page_are_sampled_one_by_one(spark):
    page = f"<html><body>{MENU}<article>{PARAGRAPHS}</article></body></html>"
    pages = spark.range(400).selectExpr("id AS page_id", "CASE WHEN id % 3 = 0 THEN '' END AS url", f"'{page}' AS html")
    assert np.any(html.classifier(pages, sample=50))
    assert not np.any(html.classifier(pages.limit(0)))
