"""Main-text extraction from HTML by text-to-tag ratios.

The standard library's streaming parser turns a page into *lines*, one per
block (paragraph, heading, list item ...), each with its text, the tags met in
it and the sectioning element it lies in. Elements that never hold article
text are left out as they stream by: scripts, styles, forms, menus, headers
and footers of the page, and elements whose class, id or role names an advert,
notice, sidebar, comment section and the like. A name can mislead, and some
pages are one large form: a form, or an element named after a part of the
layout, is left out once the page has been read, and not if it holds most of
the page's content (text in articles, if that is most of it) or a ``main`` element.

The ratio of text length to tags of each line is smoothed with a Gaussian over
the neighbouring lines; lines above the spread (standard deviation) of the
smoothed ratios are content. Lines are then clustered by the sectioning
element they share: a region is kept whole when enough of its text lies on
content lines, so a short paragraph inside the article stays and a long one in
a link list goes. An ``article``, or a ``main`` without one, is one region, so its
tables, quotes and short blocks stay. If the page marks such an element, only
regions inside an ``article`` or ``main`` stand for election. The region with
the most content text is always kept, and with it what lies inside it unless
it is the body.

Defined results: null or empty html, and pages without any eligible line, give
the empty text. Repeated rows give equal rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import slices

SCHEMA = "page_id long, url string, text string, n_chars long, n_lines long, n_kept_lines long"
OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                 ("n_lines", pa.int64()), ("n_kept_lines", pa.int64())])

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head script style noscript template button select option textarea iframe object svg "
                    "canvas audio video map nav footer aside menu dialog".split())
METADATA = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
SECTIONS = frozenset("body article main section div td center fieldset".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main menu nav ol p pre section table ul".split())
# Words of a class, id or role that name what is no article text. The text of
# elements named by the first never counts as the page's main content.
NEVER = frozenset("ad ads advert adverts advertisement sponsor sponsored cookie cookies consent popup modal comment "
                  "comments disqus respond reply replies newsletter subscribe".split())
LAYOUT = frozenset("promo promotion banner notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
                   "masthead share sharing social related search complementary contentinfo".split())
# Words that may stand beside those in one name ("comment-list", "site-footer").
BESIDE = frozenset("area bar block body bottom box button buttons card cards col column container content desktop fixed "
                   "form global group head header holder icons inner item items left link links list main media message "
                   "mobile module outer overlay page panel policy post posts primary right row secondary section signup "
                   "site slot small sticky stories text thread title toolbar tools top unit widget wrap wrapper article "
                   "articles 1 2 3".split())
PARTS = re.compile("[-_]+")


def named(tag: str, attrs: list, article: bool) -> str:
    """Whether an element's names mark it: ``never``, ``layout`` or nothing. A
    name counts as a whole: ``comment-list`` does, ``market-share`` and
    ``no-sidebar`` do not. Inside an article an id is as likely an anchor of
    its own, so there it must be one of the unmistakable words."""
    if tag in ("html", "body"):
        return ""
    found = ""
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for name in value.lower().split():
                parts = [p for p in PARTS.split(name) if p]
                if not all(p in NEVER or p in LAYOUT or p in BESIDE for p in parts):
                    continue
                if any(p in NEVER for p in parts):
                    return "never"
                if any(p in LAYOUT for p in parts) and not (article and key == "id"):
                    found = "layout"
    return found


@dataclass(frozen=True)
class RatioParams:
    """``sigma`` of the Gaussian in lines; ``spread`` times the standard
    deviation is the threshold; a region needs ``region_share`` of its text on
    content lines."""
    sigma: float = 1.0
    spread: float = 1.0
    region_share: float = 0.5


class _Lines(HTMLParser):
    """Collects ``(text, tags, region, inside article or main, marked element)``
    per line; element 0 is none."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int]] = []
        # tag, dropped, region, article, marked element
        self.stack: list[tuple[str, bool, int, bool, int]] = [("", False, 0, False, 0)]
        self.parts: list[str] = []
        self.tags = [0]  # met in each marked element since its last line
        self.around = [0]  # of each marked element the one around it,
        self.never = [False]  # whether it is left out in any case,
        self.main = [False]  # and whether it holds a main element
        self.parents = [0]  # of each region, and its element
        self.kinds = [""]

    def flush(self) -> None:
        if self.parts:
            text = b" ".join("".join(self.parts).encode("utf-8", "replace").split()).decode()
            self.parts.clear()
            if text:
                _, _, region, article, mark = self.stack[-1]
                self.lines.append((text, self.tags[mark], region, article, mark))
                self.tags[mark] = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while self.stack[-1][0] == "head" and tag not in METADATA:  # </head> may be left out
            self.end("head")
        _, dropped, region, article, mark = self.stack[-1]
        if not dropped:
            self.tags[mark] += 1
        if tag in INLINE and not attrs and tag not in VOID:
            self.stack.append((tag, dropped, region, article, mark))
            return
        if tag == "br" and not dropped:
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES_P:
                self.end("p")
                _, dropped, region, article, mark = self.stack[-1]
        if tag in VOID:
            return
        if not dropped:
            name = named(tag, attrs, article)
            dropped = tag in DROPPED or (tag == "header" and not article) or (name != "" and tag in INLINE)
            if not dropped and (name or tag == "form"):
                self.around.append(mark)
                self.never.append(name == "never")
                self.main.append(False)
                self.tags.append(0)
                mark = len(self.around) - 1
            if tag == "main" and not dropped:
                up = mark
                while up:
                    self.main[up] = True
                    up = self.around[up]
            article = article or tag in ("article", "main")
            if tag in SECTIONS:
                self.parents.append(region)
                self.kinds.append(tag)
                region = len(self.kinds) - 1
        self.stack.append((tag, dropped, region, article, mark))

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        self.end(tag)

    def end(self, tag: str) -> None:
        """End the innermost open ``tag``; a paragraph is only looked for up to
        the element around it, so stray end tags close nothing else."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return
            if tag == "p" and self.stack[k][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        while self.stack[-1][0] == "head" and data.strip():
            self.end("head")
        if not self.stack[-1][1]:
            self.parts.append(data)


def containers(parents: list[int], kinds: list[str]) -> list[int]:
    """For each region the outermost article around it, or else the outermost
    main if that holds no article, or else itself."""
    with_article = set()
    for r in range(len(kinds) - 1, 0, -1):  # inner regions come later
        if kinds[r] == "article" or r in with_article:
            with_article.add(parents[r])
    out = [0]
    for r in range(1, len(kinds)):
        up = out[parents[r]]
        whole = kinds[up] == "article" or (kinds[up] == "main" and up not in with_article)
        out.append(up if whole else r)
    return out


def left_out(lines: list[tuple[str, int, int, bool, int]], around: list[int], never: list[bool],
             main: list[bool]) -> list[bool]:
    """For each marked element whether its lines go: with the one around it, if
    it is never content, or unless it holds at least half of the content or a
    main element."""
    gone = list(never)
    for m in range(1, len(around)):
        gone[m] = gone[m] or gone[around[m]]
    count = [line for line in lines if not gone[line[4]]]
    articles = [line for line in count if line[3]]
    if 2 * sum(len(line[0]) for line in articles) >= sum(len(line[0]) for line in count):
        count = articles
    held = [0] * len(around)
    for text, *_, mark in count:
        held[mark] += len(text)
    total = sum(held)
    for m in range(len(around) - 1, 0, -1):  # inner ones come later
        held[around[m]] += held[m]
    for m in range(1, len(around)):
        gone[m] = gone[m] or gone[around[m]] or not (main[m] or 2 * held[m] >= total > 0)
    return gone


def page_lines(html: str) -> tuple[list[tuple[str, int, int, bool]], list[int]]:
    """The lines and, for each region, the region around it (0 and body have none)."""
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # the parser's own check for a malformed "<![" section
        return page_lines(html.replace("<![", "<! ["))
    parser.flush()
    within = containers(parser.parents, parser.kinds)
    around = [0 if parser.kinds[p] == "body" else p for p in parser.parents]
    gone = left_out(parser.lines, parser.around, parser.never, parser.main)
    return [(text, tags, within[region], article) for text, tags, region, article, mark in parser.lines
            if not gone[mark]], around


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing, weights renormalised at both ends."""
    radius = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(ratios)):
        a, b = max(0, i - radius), min(len(ratios), i + radius + 1)
        w = kernel[a - i + radius:b - i + radius]
        out.append(sum(map(float.__mul__, w, ratios[a:b])) / sum(w))
    return out


def main_lines(lines: list[tuple[str, int, int, bool]], around: list[int],
               params: RatioParams = RatioParams()) -> list[str]:
    """The texts of the lines that belong to content regions, in page order."""
    if not lines:
        return []
    soft = smoothed([len(t) / max(1, tags) for t, tags, _, _ in lines], params.sigma)
    mean = sum(soft) / len(soft)
    limit = params.spread * math.sqrt(sum((x - mean) ** 2 for x in soft) / len(soft))
    elect = any(article for *_, article in lines)
    size: dict[int, int] = {}
    content: dict[int, int] = {}
    for (text, _, region, article), value in zip(lines, soft):
        if article or not elect:
            size[region] = size.get(region, 0) + len(text)
            content[region] = content.get(region, 0) + len(text) * (value >= limit)
    best = max(content, key=lambda r: (content[r], size[r], -r))
    kept = {r for r in size if content[r] >= params.region_share * size[r]} | {best}
    inside = {best} - {0}
    for r in range(best + 1, len(around)):
        if around[r] in inside:
            inside.add(r)
    kept |= inside
    return [t for t, _, region, article in lines if region in kept and (article or not elect)]


def extract_main_text(pages: DataFrame, params: RatioParams = RatioParams()) -> DataFrame:
    """``page_id, url, text, n_chars`` and line counts for each row of
    ``pages`` (``page_id``, ``url``, ``html``). One narrow pass, no shuffle."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            rows = []
            for page_id, url, html in zip(*(part.column(i).to_pylist() for i in range(3))):
                lines, around = page_lines(html or "")
                kept = main_lines(lines, around, params)
                text = "\n".join(kept)
                rows.append((page_id, url, text, len(text), len(lines), len(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), OUT)], schema=OUT)

    return pages.select("page_id", "url", "html").mapInArrow(extract, SCHEMA)
