"""Main text of HTML pages: parser events, text-to-tag ratio, Gaussian smoothing, threshold.

Each page goes once through the standard library's streaming parser.  Its
events make lines, one a block (paragraph, heading, list item, cell, ...), and
for each line the letters of its text, the letters inside links, the tags met
and the element it lies in.  Elements that say what they are (nav, footer,
form, aside, script, class="ad", role="banner", ...) take their lines out.

The text-to-tag ratio of a line is its text outside links over its tags.  The
ratios, zero for lines taken out, are smoothed with a Gaussian over
neighbouring lines, and lines above the threshold, one standard deviation of
the smoothed ratios but no more than their mean, are seeds.  The content region
is the article (or main) element with the most seed text, else the smallest
element that holds nine tenths of the seed text, with headings before it.  All lines
of the region are kept, long or short, except runs of links that dip below the threshold.

Work is a row's own: no shuffle, and a task holds one batch of pages.

Defined results: a null page is an empty one; a page without text, or all of
whose text is taken out, gives an empty text; unclosed, crossed or unknown tags
and pages cut off anywhere are read as far as they go; a page of one line keeps
it; very long pages are read whole; repeated rows and null ids come back as
they are; an empty table gives no rows; other columns are ignored whatever
their names.  ``<br>`` is white space; white space is what ``str.split`` takes.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import table

SIGMA, RADIUS = 1.0, 3  # of the Gaussian, in lines
REGION_SHARE = 0.9  # of the seed text that the region holds where no article is marked
LINK_SHARE = 0.5  # a line with more of its text in links is a link
MENU_LINES = 3  # so many links in a row, not all above the threshold, are a menu

# Element names and naming habits of HTML pages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
             "summary table tbody td tfoot th thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
TAKEN_OUT = set("head title script style noscript template iframe object svg math canvas audio video nav footer aside "
                "form button select option textarea dialog menu header".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NAMES = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted menu nav "
            "navbar navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice "
            "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
            "recommendations comment comments commentlist discussion disqus replies widget pagination pager toolbar "
            "search skip copyright".split())
REGIONS = set("article main".split())
HEAD_TAGS = set("html head title meta link script style base noscript template".split())
#: Elements that a start tag of the key closes when they are still open.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}}
WORD = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names_boilerplate(tag: str, attrs) -> bool:
    """Whether an element's role, class, id or state says that it isn't content."""
    held = dict(attrs)
    if "hidden" in held or (held.get("aria-hidden") or "").lower() == "true" \
            or re.search(r"display\s*:\s*none", held.get("style") or "", re.I):
        return True
    if (held.get("role") or "").lower() in ROLES:
        return True
    if tag in REGIONS or tag in HEADINGS or tag in ("html", "body"):
        return False
    text = CAMEL.sub(" ", f"{held.get('class') or ''} {held.get('id') or ''}").lower()
    return not NAMES.isdisjoint(WORD.findall(text))


class _Lines(HTMLParser):
    """Lines of a page.  Elements are numbered in page order: ``parent``, ``tag``,
    ``out`` (taken out) and ``block`` (the block that an inline element lies in) by number."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.out, self.block = [-1], ["#page"], [False], [0]
        self.open, self.open_tags = [0], Counter()
        self.text, self.linked, self.tags, self.at, self.begun, self.gone = [], 0, 0, 0, False, False
        self.lines = []  # (text, letters in links, tags, block); no text where it is taken out

    def line_ends(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.gone:
            self.lines.append((text, self.linked, self.tags, self.at))
            self.tags = 0
        self.text, self.linked, self.begun, self.gone = [], 0, False, False

    def close_down_to(self, depth: int) -> None:
        self.open_tags.subtract(self.tag[e] for e in self.open[depth:])
        del self.open[depth:]

    def closes(self, tags: set, scope: set) -> None:
        """Close the innermost open element of ``tags`` that lies within ``scope``."""
        if not any(self.open_tags[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                return self.close_down_to(depth)
            if tag in scope or tag in TAKEN_OUT:
                return None

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag not in HEAD_TAGS:
            self.closes({"head"}, set())
        if tag in BLOCKS:
            self.line_ends()
            self.closes({"p"}, {"td", "th", "li", "table", "article", "body"})
        if tag in CLOSED_BY:
            self.closes(CLOSED_BY[tag], SCOPES[tag])
        if tag in VOID:
            return
        above, me = self.open[-1], len(self.parent)
        named = tag in TAKEN_OUT
        if tag == "header" and any(self.open_tags[t] for t in REGIONS):
            named = False  # the head of an article: its headings stay, see _article_head
        self.parent.append(above)
        self.tag.append(tag)
        self.out.append(self.out[above] or named or _names_boilerplate(tag, attrs))
        self.block.append(me if tag in BLOCKS else self.block[above])
        self.open.append(me)
        self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.line_ends()
        if not self.open_tags[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                return self.close_down_to(depth)

    def handle_data(self, data):
        if not data.strip():
            self.text.append(data)
            return
        if self.open_tags["head"] and self.tag[self.open[-1]] == "head":
            self.closes({"head"}, set())
        element = self.open[-1]
        if self.out[element]:
            if not self.begun:
                self.at = self.block[element]
            self.gone = True
            return
        if not self.begun:
            self.at, self.begun = self.block[element], True
        self.text.append(data)
        if self.open_tags["a"] > 0:
            self.linked += len(data.strip())

    def parse_marked_section(self, i, report=1):  # <![...]> of any kind is no text
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def close(self):
        super().close()
        self.line_ends()


def _smooth(values: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[RADIUS:RADIUS + len(values)]
    return np.convolve(values, kernel)[RADIUS:RADIUS + len(values)] / weight


def ratios(lines: list, kept: np.ndarray) -> np.ndarray:
    """Smoothed text-to-tag ratios; lines taken out count as zero."""
    raw = np.array([max(0, len(t) - linked) / max(1, tags) for t, linked, tags, _ in lines], dtype=np.float64)
    return _smooth(np.where(kept, raw, 0.0))


def _region(page: _Lines, element: np.ndarray, kept: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Lines of the content region; ``mass`` is the seed text of each line."""
    n = len(page.parent)
    held = np.zeros(n)
    np.add.at(held, element, mass)
    for e in range(n - 1, 0, -1):  # children have larger numbers than their parents
        held[page.parent[e]] += held[e]
    marked = [e for e in range(1, n) if page.tag[e] in REGIONS and held[e] > 0 and not page.out[e]]
    best = max(marked, key=lambda e: (held[e], e), default=0)  # of nested regions with equal text the inner one
    if not best:
        children = {}
        for e in range(1, n):
            children.setdefault(page.parent[e], []).append(e)
        while True:
            inner = max(children.get(best, []), key=lambda e: held[e], default=0)
            if not inner or held[inner] < REGION_SHARE * held[0] or page.tag[inner] in HEADINGS or page.tag[inner] == "p":
                break
            best = inner
    inside = np.zeros(n, dtype=bool)
    inside[best] = True
    for e in range(best + 1, n):
        inside[e] = inside[page.parent[e]]
    chosen = inside[element] & kept
    if chosen.any() and page.tag[best] not in REGIONS:  # headings that lead into the region
        at = int(np.argmax(chosen)) - 1
        while at >= 0 and kept[at] and page.tag[element[at]] in HEADINGS:
            chosen[at] = True
            at -= 1
    return chosen


def _article_head(page: _Lines, element: int) -> bool:
    """Whether a line is in a header but in no heading of it."""
    heading = False
    while element > 0:
        tag = page.tag[element]
        if tag == "header":
            return not heading
        heading |= tag in HEADINGS
        element = page.parent[element]
    return False


def main_text(html: str | None) -> str:
    """The page's main text, blocks joined by line feeds."""
    page = _Lines()
    page.feed(html or "")
    page.close()
    lines = page.lines
    if not lines:
        return ""
    element = np.array([line[3] for line in lines])
    kept = np.array([bool(line[0]) and not _article_head(page, line[3]) for line in lines])
    if not kept.any():
        return ""
    smooth = ratios(lines, kept)
    threshold = min(smooth.std(), smooth.mean())
    high = smooth >= threshold
    length = np.array([len(t) - min(linked, len(t)) for t, linked, _, _ in lines])
    chosen = _region(page, element, kept, np.where(high & kept, length, 0))
    linked = np.array([links > LINK_SHARE * len(text) for text, links, _, _ in lines])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], linked, [0]])))
    for start, end in zip(edges[::2], edges[1::2]):
        if end - start >= MENU_LINES and not high[start:end].all():
            chosen[start:end] = False
    return "\n".join(lines[i][0] for i in np.flatnonzero(chosen))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    pages = pages.select("page_id", "url", "html")
    fields = pages.schema
    schema = f"page_id {fields['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"

    def extracted(batches):
        for batch in batches:
            html = batch.column("html")
            text = [main_text(html[i].as_py()) for i in range(len(html))]  # one page at a time
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.withColumn("url", F.col("url").cast("string")).mapInArrow(extracted, schema)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


#: For pages whose article is one article element with paragraphs and headings, as in the given tables.
OP12_SQL = r"""WITH inner_html AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS h FROM pages),
blocks AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(h, '<br */?>', ' ', 'gi'),
    '</?(p|h[1-6]|div|ul|ol|li|section|blockquote)( [^>]*)?>', chr(1), 'gi'), '<[^>]*>', '', 'g'), chr(1)) AS b
  FROM inner_html),
decoded AS (
  SELECT page_id, url, [trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(x,
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(160), ' '),
    '\s+', ' ', 'g')) FOR x IN b] AS b FROM blocks),
joined AS (SELECT page_id, url, coalesce(array_to_string([x FOR x IN b IF x <> ''], chr(10)), '') AS text FROM decoded)
SELECT page_id, url, text, length(text) AS n_chars FROM joined"""
