"""Regions of pages are chosen by density; names only weigh."""

from __future__ import annotations

import html as _html
import re
import time

import numpy as np
import pytest

from epistar.llm import html_text

from tests.llm.test_operators import SF

BODY = "<h1>Title</h1>" + "".join(f"<p>{'word ' * k}end</p>" for k in (90, 60, 40))
TEXT = " ".join(["Title"] + ["word " * k + "end" for k in (90, 60, 40)])


@pytest.mark.parametrize(
    "page",
    [
        "<div class='post social-science'>{}</div><div>tiny</div>",
        "<div id='job-search-guide'>{}</div>",
        "<div class='has-sidebar'>{}</div><div class='sidebar'>a sidebar</div>",
        "<form id='aspnetForm'>{}</form>",
        "<div class='layout-widget-area'><div class='menu'>home about</div>{}<div class='newsletter'>join us</div></div>",
        "<div><ul><li><a href='/'>home</a></li></ul></div><div>{}</div><div>A short line.</div>",
        "<div>{}</div><div class='comments'>" + "<p>A reader writes a very long answer to it all.</p>" * 80 + "</div>",
        "<div>{}</div><div class='reader-comments'>" + "<p>A reader writes a very long answer to it all.</p>" * 10 + "</div>",
        "<article><p>A teaser card.</p></article><div>{}</div><article><p>One more card.</p></article>",
        "<div hidden>" + "<p>hidden words in numbers</p>" * 60 + "</div><div>{}</div>",
    ],
)
def test_names_only_weigh(page):
    assert html_text.main_text(page.format(BODY)) == TEXT


def test_a_lone_notice_is_no_article():
    for page in ("<div class='ad'>Buy now, it is cheap.</div>", "<div class='cookie-notice'><p>We use cookies.</p></div><article></article>", "<form>Search: <p>go</p></form>"):
        assert html_text.main_text(page) == ""


def _wanted(page: str) -> str:
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    return " ".join(_html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", body).replace("<b>", "").replace("</b>", "")).split())


def test_density_finds_articles_without_names(spark, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/../sf0.01/pages.parquet").select("html").collect()]
    wanted = [_wanted(p) for p in pages]

    def right(change) -> float:
        return sum(html_text.main_text(change(p)) == w for p, w in zip(pages, wanted)) / len(pages)

    def without_class(p):
        return p.replace(' class="ad"', "").replace("article>", "div>")

    def without_names(p):
        return re.sub(r"(</?)(nav|footer)>", r"\1div>", without_class(p))

    assert right(lambda p: p.replace("article>", "div>")) == 1
    assert right(without_class) >= 0.9
    assert right(without_names) >= 0.6
    for p, w in zip(pages, wanted):
        assert w in html_text.main_text(without_names(p))  # never less than the article
    monkeypatch.setattr(html_text, "smoothed", lambda ratios: np.ones(len(ratios)))
    assert right(without_names) == 0


def test_deep_markup_takes_linear_time():
    def seconds(page: str) -> float:
        t = time.perf_counter()
        assert html_text.main_text(page)
        return time.perf_counter() - t

    for part in ("<div>x", "<span><p>x", "<b></i>x<p>y", "<ul><li>x"):
        seconds(part * 100)
        assert seconds(part * 40_000) < 40 * max(seconds(part * 4_000), 0.02)
