"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams through the whole page. Its events are laid out as
lines, one for each run of text between block tags, with the container they stand in, the
number of tags met and the characters of text (links apart). Each line's ratio of text to
tags is smoothed with a Gaussian along the page, and the ratios are split in two clusters
at the threshold where the means of both sides are equally far (one-dimensional two-means).
Lines of the high cluster mark the content. The region is the smallest container that holds
nearly all of their text, or the article or main element around it, and every line of that
region is kept, short headings and single words included, except what stands in
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments (by element, role, or the words of class and id).

Defined cases: null, empty and text-free pages give an empty text; pages are read whole;
broken markup is read as far as it goes; rows with equal ids are separate rows; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, picked, table

# HTML element names by what they do to the flow of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol
    p pre search section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("html body main article section div td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_TEXT = frozenset("""head script style noscript template iframe object svg math canvas audio video select
    option button textarea input label map""".split())
APART = frozenset("nav header footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that name something other than the article.
APART_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    comment comments commentlist reply replies disqus respond discussion share sharing social related recommended
    pagination pager toolbar skip toc""".split())
#: Elements that an opening tag of the same kind closes.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
             "option": frozenset(["option"])}
SCOPES = frozenset("html body article section div main td th table ul ol dl nav header footer aside form blockquote".split())
WORDS = re.compile(r"[a-z]+")


class _Lines(HTMLParser):
    """Lines of a page: ``lines`` holds [text, characters outside links, tags, container, apart]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.above = [-1]                       # parent of each container
        self.kinds = ["html"]
        self.stack = [("", False, False, 0, False)]  # tag, apart, not text, container, link
        self.data: list[str] = []
        self.free = 0
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.data).split())
        _, apart, _, container, _ = self.stack[-1]
        if text:
            self.lines.append([text, self.free, self.tags, container, apart])
            self.tags = 0
        self.data, self.free = [], 0

    def parse_marked_section(self, i, report=1):
        """Marked sections of any kind are passed over like comments."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _names_apart(self, tag: str, attrs) -> bool:
        if tag in APART:
            return True
        for name, value in attrs:
            if not value:
                continue
            if name == "role" and value.lower() in ROLES:
                return True
            if name in ("class", "id") and tag not in ("html", "body", "main") and tag not in HEADINGS \
                    and not APART_WORDS.isdisjoint(WORDS.findall(value.lower())):
                return True
            if name == "hidden":
                return True
        return False

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        elif tag in ("br", "wbr"):
            self.data.append(" " if tag == "br" else "")
        if tag in VOID:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[k][0]
            if tag in CLOSED_BY.get(open_tag, ()):
                del self.stack[k:]
                break
            if open_tag in SCOPES:
                break
        _, apart, hidden, container, link = self.stack[-1]
        apart = apart or self._names_apart(tag, attrs)
        if tag in CONTAINERS:
            self.above.append(container)
            self.kinds.append(tag)
            container = len(self.kinds) - 1
        self.stack.append((tag, apart, hidden or tag in NOT_TEXT, container, link or tag == "a"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                if tag in BLOCKS:
                    self.flush()
                del self.stack[k:]
                return
        if tag in BLOCKS:
            self.flush()

    def handle_data(self, data):
        _, _, hidden, _, link = self.stack[-1]
        if hidden:
            return
        self.data.append(data)
        if not link:
            self.free += len(data)


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing along the page; beyond its ends the ratio is 0."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach:reach + len(ratios)]


def cluster(values: np.ndarray) -> np.ndarray:
    """Members of the high cluster of one-dimensional two-means (all, if values are alike)."""
    low, high = values.min(), values.max()
    if high - low < 1e-9:
        return np.ones(len(values), bool)
    for _ in range(50):
        limit = (low + high) / 2
        up = values > limit
        new = values[~up].mean(), values[up].mean()
        if new == (low, high):
            break
        low, high = new
    return up


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.9) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    if not any(not x[4] for x in page.lines):
        return ""
    ratios = np.array([0.0 if apart else free / max(1, tags) for _, free, tags, _, apart in page.lines])
    content = cluster(smooth(ratios, sigma)) & np.array([not x[4] for x in page.lines])
    if not content.any():
        content = np.array([not x[4] for x in page.lines])
    weights = np.zeros(len(page.kinds))
    for line, chosen in zip(page.lines, content, strict=True):
        if chosen:
            weights[line[3]] += len(line[0])
    for k in range(len(weights) - 1, 0, -1):  # containers stand after those around them
        weights[page.above[k]] += weights[k]
    region = max(k for k in range(len(weights)) if weights[k] >= share * weights[0])
    around = region
    for kind in ("article", "main"):
        k = region
        while k >= 0 and page.kinds[k] != kind:
            k = page.above[k]
        if k >= 0:
            around = k
            break
    inside = [False] * len(page.kinds)
    for k in range(len(inside)):
        inside[k] = k == around or (page.above[k] >= 0 and inside[page.above[k]])
    return "\n".join(text for text, _, _, container, apart in page.lines if inside[container] and not apart)


def extract(pages: DataFrame, keep=("page_id", "url"), html_col: str = "html", sigma: float = 1.0,
            share: float = 0.9) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page."""
    def make():
        def run(html):
            texts = [main_text(x, sigma, share) for x in html.to_pylist()]
            return [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
        return run
    return arrow_rows(pages, list(keep), [html_col], "text string, n_chars long", make)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(picked(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html"))
