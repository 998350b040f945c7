"""Main text of web pages: parser events, text-to-tag ratio by line, smoothing, threshold clustering.

A page streams through the standard library's HTML parser. Block elements cut it
into lines; each line knows its text, its tags and the element that holds it. Elements
that cannot hold the article (menus, page footers, asides, scripts, styles, hidden
ones, reader comments) are left out while parsing.

A line's text-to-tag ratio, smoothed over its neighbours by a Gaussian, splits
the lines into two clusters at a threshold (the ratios' standard deviation, at
most half their largest). The dense cluster decides twice:

1. A container whose class, id or role names an advert, notice, sidebar and the like, or
   a form, is a rival of the text around it, at a lower rank: it stays only if its dense
   text, times the rank of its name, exceeds the dense text outside it.
2. The region of the rest that holds the dense text is selected: all ``article`` and ``main``
   elements if they hold at least half of it, else the deepest container (no
   paragraph, list or table) around all its lines that are dense of themselves.

Every line of that region belongs to the result, short ones too, but for lines of
links outside dense text. Time and memory are linear in the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table

SIGMA = 1.0
RADIUS = 2
LINK_SHARE = 0.8
# ranks of containers by name: a plain sign ("ad", "site-footer"), and a sign among other words ("job-search-guide")
PLAIN_RANK, MIXED_RANK = 1 / 16, 1 / 2
# a container with a plain sign needs this much dense text, so that a page's lone notice is no article
PLAIN_LINES, PLAIN_CHARS = 3, 400
SENTENCE = 80  # a dense line of so many characters is text of its own, whatever its tags
# HTML's void and block elements, and names that mark what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NEVER = frozenset(
    "script style noscript template head title nav footer aside button select textarea option iframe object svg canvas audio video dialog menu map math".split()
)
HOLDERS = frozenset("html body main article section div center".split())
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCK - {"br", "p", "li", "td", "th", "tr", "dd", "dt", "option"}
LISTS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "p": set()}
SIGNS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead comment comments reply replies disqus notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations widget toolbar pagination pager search alert skip toc".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
TALK = frozenset("comment comments reply replies disqus".split())
PLACES = frozenset("site page main top bottom left right inner outer box block area bar list item section container wrapper wrap content link links icon".split())

IN, MIXED, PLAIN, TALKED, ELEMENT = 0, 1, 2, 3, 4  # marks: an uncertain name, a plain one or a form, reader comments, its kind
LEFT_OUT = TALKED  # marks from here on are left out while parsing


def marked(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """The mark of a container that is named, or hidden, as something else than the article."""
    if tag in ("html", "body", "main"):
        return IN
    found = IN
    wanted = TALK if tag == "article" else SIGNS - {"header"} if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else SIGNS
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id"):
            for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
                parts = set(re.findall(r"[a-z]+", token))
                if parts & wanted:
                    plain = parts <= SIGNS | PLACES
                    talk = bool(parts & TALK)
                    found = max(found, (TALKED if talk else PLAIN) if plain else PLAIN if talk else MIXED)
        elif name == "role" and value.lower() in ROLES:
            found = max(found, PLAIN)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return ELEMENT
        elif name == "style" and re.search(r"display\s*:\s*none", value.lower()):
            return ELEMENT
    return found


class Lines(HTMLParser):
    """Cuts a page into lines (text, tags, link characters, number of the innermost element).

    Elements are numbered as they open, 0 being the page: ``parent`` holds the number of
    the element around each, ``mark`` its own mark, ``holders`` those that hold paragraphs,
    ``articles`` the outermost ``article`` and ``main`` elements.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []  # element, its number, the largest mark down to it
        self.open: Counter[str] = Counter()
        self.parent, self.mark = [0], [IN]
        self.holders: set[int] = set()
        self.articles: set[int] = set()
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.tags = self.link = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.link, self.stack[-1][1] if self.stack else 0))
            self.tags = self.link = 0
        self.parts = []

    def out(self) -> bool:
        return bool(self.stack) and self.stack[-1][2] >= LEFT_OUT

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        self.tags += not self.out()
        if tag in VOID:
            return
        mark = marked(tag, attrs)
        if tag in ("article", "main") and self.stack and self.stack[-1][2] in (MIXED, PLAIN) and mark == IN:
            while self.stack and self.stack[-1][2]:  # an unclosed advert or a form around the page does not hide the article
                self._pop()
        if tag in CLOSES_ITSELF:
            self._close_within(CLOSES_ITSELF[tag], LISTS[tag])
        elif tag in ENDS_P:
            self._close_within({"p"}, ENDS_P)
        in_article = self.open["article"] + self.open["main"] > 0
        mark = max(mark, ELEMENT * (tag in NEVER), PLAIN * (tag == "form"), ELEMENT * (tag == "header" and not in_article))
        number = len(self.parent)
        self.parent.append(self.stack[-1][1] if self.stack else 0)
        self.mark.append(mark)
        if tag in HOLDERS:
            self.holders.add(number)
        if tag in ("article", "main") and not in_article:
            self.articles.add(number)
        self.stack.append((tag, number, max(mark, self.stack[-1][2] if self.stack else IN)))
        self.open[tag] += 1

    def _pop(self) -> str:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        return tag

    def _close_within(self, names: set[str], limits) -> None:
        """Close the nearest open element of ``names``, unless one of ``limits`` stands before it."""
        if not any(self.open[t] for t in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                self.flush()
                while len(self.stack) > k:
                    self._pop()
                return
            if self.stack[k][0] in limits:
                return

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self.tags += not self.out()
        while self.open[tag] and self._pop() != tag:
            pass

    def handle_data(self, data):
        if not self.out():
            self.parts.append(data)
            if self.open["a"]:
                self.link += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines (the kernel is cut at the page's ends)."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    full = np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]


def dense_lines(sizes: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The dense cluster of the smoothed ratios, and those of its lines that are dense of themselves."""
    raw = sizes / np.maximum(1, tags)
    ratio = smoothed(raw)
    threshold = min(float(ratio.std()), float(ratio.max()) / 2)
    dense = ratio >= threshold
    core = dense & ((raw >= threshold) | (sizes >= SENTENCE))
    return dense, core if core.any() else dense


def rejected(page: Lines, held: np.ndarray, core: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By element: whether it lies in a marked container that its rivals outweigh (rule 1 above).

    A container's rival is the dense text around it that no deeper mark covers, up to the next marked container or the page.
    """
    parent, mark = page.parent, page.mark
    n = len(parent)
    weight, count = np.bincount(held, core * sizes, n), np.bincount(held, core, n)
    scope = list(range(n))  # the nearest marked element, itself included; numbers grow with depth
    for e in range(n):
        if e and mark[e] == IN:
            scope[e] = scope[parent[e]]
    own = np.bincount(scope, weight, n)
    whole, lines = weight.copy(), count.copy()
    for e in range(n - 1, 0, -1):
        whole[parent[e]] += whole[e]
        lines[parent[e]] += lines[e]
    out = np.zeros(n, bool)
    for e in range(1, n):
        out[e] = out[parent[e]]
        if mark[e] and not out[e]:
            rank = PLAIN_RANK if mark[e] == PLAIN else MIXED_RANK
            slight = mark[e] == PLAIN and (lines[e] < PLAIN_LINES or whole[e] < PLAIN_CHARS)
            out[e] = slight or whole[e] * rank <= own[scope[parent[e]]]
    return out


def main_text(html: str | None) -> str:
    """The article's text; empty if there is none."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.flush()
    if not page.lines:
        return ""
    texts, tags, links, held = ([x[k] for x in page.lines] for k in range(4))
    sizes, tags, links, held = np.array([len(t) for t in texts], float), np.array(tags, float), np.array(links), np.array(held)
    if any(page.mark):
        kept = np.flatnonzero(~rejected(page, held, dense_lines(sizes, tags)[1], sizes)[held])
        if not len(kept):
            return ""
        texts, sizes, tags, links, held = [texts[i] for i in kept], sizes[kept], tags[kept], links[kept], held[kept]
    dense, core = dense_lines(sizes, tags)
    plain = links <= LINK_SHARE * sizes
    n = len(page.parent)
    article = [e in page.articles for e in range(n)]
    for e in range(1, n):
        article[e] = article[e] or article[page.parent[e]]
    inside = np.array(article)[held]
    if (core * sizes * inside).sum() >= (core * sizes).sum() / 2:
        # all lines of elements with dense text count; of the other articles those that are no mere links
        outer = list(range(n))
        for e in range(1, n):
            if e not in page.articles:
                outer[e] = outer[page.parent[e]]
        outer = np.array(outer)[held]
        chosen = inside & (np.isin(outer, outer[dense & inside]) | plain)
    else:
        cores, held_lines = np.bincount(held, core, n), np.bincount(held, minlength=n)
        for e in range(n - 1, 0, -1):
            cores[page.parent[e]] += cores[e]
            held_lines[page.parent[e]] += held_lines[e]
        # numbers grow with depth; an element of one line is a paragraph, whatever its kind
        region = max((e for e in page.holders if cores[e] == core.sum() and held_lines[e] > 1), default=0)
        within = [e == region for e in range(n)]
        for e in range(1, n):
            within[e] = within[e] or within[page.parent[e]]
        chosen = np.array(within)[held] & (dense | plain)
    return " ".join(t for t, c in zip(texts, chosen) if c)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Null and empty html gives an empty text, a null id or url stays null, repeated pages give repeated
    rows, an empty table gives none; other columns of ``pages`` are not read. Whole pages are parsed, of any length.
    """
    bounded_batches(pages.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    slim = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = slim.mapInArrow(scan, "id long, url string, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars."""
    return extract_pages(table(spark, sf_dir, "pages"))
