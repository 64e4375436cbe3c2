"""Main text of web pages by text-to-tag ratios of a parser's event stream.

The standard library's streaming parser turns a page into lines, one for each block of
text, with the number of tags met since the line before. Lines in menus, adverts, forms
and the like (by element or by the words of class, id and role) are noise and count as
empty, as do lines that are mostly links. Words alone don't make a container noise that
holds the page's longest article (or else main) element, most of its text, or, on a page
with neither, most of the text. The text-to-tag ratios are smoothed with a Gaussian and clustered by a threshold:
the midpoint of two means. Lines above it are content. From the body, the walk goes down
as long as one container holds most of the content; that container is the region.

All lines of an article or main element that holds the region are the text, however short
they are, but for lines below the threshold that are mostly links in a container that is
(lists of related pages). Elsewhere a container inside the region stays if it has a content line or
lies between two, without its lines of links, and lines directly in it stay, in the body only
from the first content line (with headings before it) to the last, or, where nothing is in
a container, to the end.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table

# Elements whose text is never main text.
NOISE_TAGS = set(
    "script style noscript template title nav footer aside form button select textarea menu dialog iframe object "
    "canvas svg math audio video datalist".split()
)
# Words of class, id or role that mark noise.
NOISE_WORDS = set(
    "nav navbar navigation menu menubar footer sidebar ad ads adv advert adverts advertisement advertising adsense "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe "
    "subscription signup popup modal overlay share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager comment comments commentlist reply replies respond discussion disqus widget "
    "toolbar login signin search skip complementary contentinfo dialog form".split()
)
HEADER_WORDS = {"header", "masthead", "topbar", "banner", "head"}  # noise outside an article only
# Elements that begin and end a block.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody tfoot thead title tr ul".split()
)
CONTAINER_TAGS = set(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section "
    "table ul".split()
)
SPACED_TAGS = {"br", "td", "th", "img", "input", "option"}
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NEGATIONS = {"no", "has", "with", "without"}  # the word after one of them in a name marks nothing
_WORDS = re.compile("[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

SIGMA = 1.0  # of the smoothing, in lines
MOST = 0.8  # share of the content that one container must hold for the walk to go on


class _Lines(HTMLParser):
    """Turns events into lines: (text, tags before and in it, container, noise, heading,
    characters in links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, bool, int]] = []
        self.parents, self.kinds = [-1], ["body"]  # containers; 0 is the page
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, container, noise, in article
        self.depth: Counter[str] = Counter()  # open elements of each tag
        self.named = [False]  # noise by its words
        self.here, self.noise, self.article = 0, False, False
        self.text: list[str] = []
        self.tags, self.heading, self.link, self.linked = 0, False, False, 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.here, self.noise, self.heading, self.linked))
            self.tags = 0
        self.linked = 0
        self.text.clear()

    def restore(self) -> None:
        _, self.here, self.noise, self.article = self.open[-1] if self.open else ("", 0, False, False)

    def marked(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether an element is noise, and whether it is so by its words alone."""
        if tag in NOISE_TAGS or (tag == "header" and not self.article):
            return True, False
        said = set()
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for token in value.split():
                    words = [w.lower() for w in _WORDS.findall(token)]
                    said.update(w for before, w in zip(["", *words], words) if before not in NEGATIONS)
            elif name == "hidden" or (name == "style" and value and re.search(r"display\s*:\s*none", value)):
                return True, False
        named = tag not in ("body", "html", "article", "main") and bool(
            said & NOISE_WORDS or (not self.article and said & HEADER_WORDS))
        return named, named

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        block = tag in BLOCK_TAGS
        if block:
            self.flush()
            self.heading = tag in HEADINGS
            while self.open and self.open[-1][0] == "p":  # a block ends an open paragraph
                self.open.pop()
                self.depth["p"] -= 1
                self.restore()
        elif tag in SPACED_TAGS:
            self.text.append(" ")
        self.link = tag == "a" or (self.link and not block)
        if tag in VOID_TAGS or tag in ("html", "body", "head"):
            return
        noise, named = self.marked(tag, attrs)
        if tag not in CONTAINER_TAGS and not noise:
            return
        if noise and not block:
            self.flush()
        here = self.here
        if tag in CONTAINER_TAGS:
            here = len(self.parents)
            self.parents.append(self.here)
            self.kinds.append(tag)
            self.named.append(named)
            noise = noise and not named  # decided when the whole page is read
        self.here, self.noise = here, self.noise or noise
        self.article = self.article or tag in ("article", "main")
        self.open.append((tag, here, self.noise, self.article))
        self.depth[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        self.link = self.link and tag != "a"
        if self.depth[tag]:  # what is passed on the way to it is closed, too: each element once
            self.flush()
            closed = ""
            while closed != tag:
                closed = self.open.pop()[0]
                self.depth[closed] -= 1
            self.restore()
        if tag in BLOCK_TAGS:
            self.flush()
            self.heading = False
        elif tag in SPACED_TAGS:
            self.text.append(" ")

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.link:
            self.linked += len(data.strip())


def unnamed(page: _Lines) -> list[tuple[str, int, int, bool, bool, int]]:
    """The page's lines, noise where a container is noise by its words. It is none if it
    holds the article with the most text, or MOST of that article's text; on a page without
    article and main, if it holds more than half of the text. Text is what is no noise
    otherwise, outside links; containers inside one that is kept are judged by themselves."""
    if not any(page.named):
        return page.lines
    n = len(page.parents)
    size = [0] * n
    for text, _, here, noise, _, linked in page.lines:
        if not noise:
            size[here] += max(0, len(text) - linked)
    for c in range(n - 1, 0, -1):
        size[page.parents[c]] += size[c]
    main = next((found for kind in ("article", "main") if (found := [c for c in range(n) if page.kinds[c] == kind and size[c]])), [])
    main = max(main, key=lambda c: size[c], default=None)
    above, c = set(), main
    while c is not None and c >= 0:
        above.add(c)
        c = page.parents[c]
    out, within = [False] * n, [c == main for c in range(n)]
    for c in range(1, n):
        within[c] = within[c] or within[page.parents[c]]
        if main is None:
            kept = 2 * size[c] > size[0]
        else:
            kept = c in above or (within[c] and size[c] >= MOST * size[main])
        out[c] = out[page.parents[c]] or (page.named[c] and not kept)
    return [(text, tags, here, noise or out[here], heading, linked) for text, tags, here, noise, heading, linked in page.lines]


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; weights at the edges are scaled to sum to one."""
    reach = math.ceil(3 * sigma)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    n = len(values)
    full = np.convolve(values, weights)[reach : reach + n]
    return full / np.convolve(np.ones(n), weights)[reach : reach + n]


def threshold(values: np.ndarray) -> float:
    """Midpoint of two means, from the extremes until it stays; the value itself if all
    are alike."""
    cut = (values.min() + values.max()) / 2
    for _ in range(100):
        low, high = values[values < cut], values[values >= cut]
        if not len(low):
            break
        after = (low.mean() + high.mean()) / 2
        if after == cut:
            break
        cut = after
    return cut


def region_lines(page: _Lines, sigma: float = SIGMA) -> list[str]:
    """Texts of the lines that belong to the content regions, in page order."""
    lines = unnamed(page)
    if all(noise for _, _, _, noise, _, _ in lines):
        return []
    ratios = np.array([0.0 if noise else max(0, len(text) - linked) / max(tags, 1) for text, tags, _, noise, _, linked in lines])
    smooth = smoothed(ratios, sigma)
    noise = np.array([x[3] for x in lines])
    links = np.array([2 * x[5] > len(x[0]) for x in lines])
    smooth[noise | links] = 0.0
    content = (smooth >= threshold(smooth)) & ~noise
    if not content[~links].any() and (~links & ~noise).any():
        content = ~links & ~noise
    n = len(page.parents)
    weight = [0.0] * n  # content characters in and below each container
    said, linked = [0] * n, [0] * n  # all characters, and those in links
    for (text, _, here, is_noise, _, in_links), good in zip(lines, content):
        weight[here] += len(text) if good else 0
        if not is_noise:
            said[here] += len(text)
            linked[here] += in_links
    for c in range(n - 1, 0, -1):  # from the leaves up
        for sums in (weight, said, linked):
            sums[page.parents[c]] += sums[c]
    region = 0
    children: dict[int, list[int]] = {}
    for child, parent in enumerate(page.parents):
        children.setdefault(parent, []).append(child)
    while True:
        best = max(children.get(region, []), key=lambda c: weight[c], default=None)
        if best is None or weight[best] < MOST * weight[region]:
            break
        region = best
    chain, lifted = region, None
    while chain >= 0:  # the outermost article or main that holds the region
        if page.kinds[chain] in ("article", "main"):
            lifted = chain
        chain = page.parents[chain]
    whole = lifted is not None
    region = lifted if whole else region

    below: list[int | None] = []  # for each container: its ancestor directly below the region
    for c, parent in enumerate(page.parents):
        below.append(region if c == region else c if parent == region else below[parent] if parent >= 0 else None)
    inside = [c == region or below[c] is not None for c in range(n)]
    listing = [False] * n  # in a container below the region that is mostly links
    for c in range(1, n):
        listing[c] = inside[c] and c != region and (listing[page.parents[c]] or 2 * linked[c] > said[c])
    found = np.flatnonzero(content)
    first, last = int(found[0]), int(found[-1])
    while first and lines[first - 1][4] and not lines[first - 1][3]:
        first -= 1
    flat = all(x[2] == region for x in lines if not x[3])  # a page without containers ends where it ends
    kept = []
    for i, (text, _, here, is_noise, _, _) in enumerate(lines):
        if is_noise or not inside[here] or (listing[here] and links[i] and not content[i]):
            continue
        if whole or (region and here == region):
            kept.append(text)
        elif here == region:
            if first <= i and (i <= last or (flat and not links[i])):
                kept.append(text)
        elif weight[below[here]] > 0 or (first <= i <= last and not links[i]):
            kept.append(text)
    return kept


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    return "\n\n".join(region_lines(page)) if page.lines else ""


def extract(html: Column | str) -> Column:
    """Main text of a page: blocks in page order, joined by an empty line. Null, empty and
    text-free pages give the empty text."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py()) for x in batch], pa.string())

    return text(html)


def extracted(df: DataFrame, html_col: str) -> DataFrame:
    """df with `text`, the main text of every row's whole page; pages of any length are
    read whole, repeated rows get equal texts, an empty table stays empty and a column
    called text is replaced. Rows don't move."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != "text"]
    return df.select(*rest, extract(F.col(f"`{html_col}`")).alias("text"))


@query("op4_text_ratio")
def op4(spark, sf_dir):
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages, "html").select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
