"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser reads a page as a stream of events. A block, the text between
two block-level tags, is a line; the ratio of a line is its letters over its tags. What
its tag, role or name marks as a menu, header, footer, sidebar, notice, advert, form, script,
style or reader comment is a line of ratio 0. The ratios are smoothed by a Gaussian along
the page, and two-means clustering of the smoothed ratios sets the threshold above which a
line is content.

Content lines choose regions, and a region is taken whole, with its short lines: the outermost
articles that hold a content line, else the page's main element, else the deepest element
that holds most of the content. Where that is the page's body itself, the lines from the
first content line to the last are taken, with the headings right before them.

Text is returned with character references decoded, white space inside a block turned into
one space, blocks joined by one line feed. Of an article's own header only the headings stay.
Null or empty pages, and pages without text, give an empty text; an empty table gives no
rows. Unclosed or crossed tags end where an enclosing element ends, a tag or comment that
the page's end cuts off is no text. Pages may be of any length, and work grows with it; an
element below ``DEEPEST`` open ones counts as part of the last of these. Repeated rows are
pages of their own; other columns are left out.
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

from hitloom.llm.tables import bounded_slices, in_arrow, texts_of

#: Width of the smoothing, in lines, and the share of the content a region must hold.
SIGMA, SHARE = 1.0, 0.6
#: Open elements that are told apart.
DEEPEST = 512
#: Why a line stands out of the content: not at all, as marked, as the header of an article
#: (whose headings stay), or in a form (whose articles stay).
KEPT, OUT, ARTICLE_HEADER, IN_FORM = range(4)

#: Elements that hold a line of text by themselves or other blocks.
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul head title "
    "script style noscript template svg math canvas object iframe video audio select option "
    "textarea button hr".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_HEAD = set("head title script style noscript template".split())
#: A start tag ends open elements of these names, up to a list or table around it.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
#: Inside these, a paragraph that began outside does not end.
_SCOPES = set("td th caption table button object article section div body html".split())
_OUT_TAGS = set(
    "head title script style noscript template svg math canvas object iframe video audio nav "
    "footer aside select option textarea button menu dialog".split())
_OUT_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar note status".split())
_OUT_NAMES = set(
    "ad ads advert adverts advertisement advertising advertorial adsense sponsor sponsored "
    "sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices "
    "alert alerts disclaimer sidebar sidebars sidenav nav navbar navigation menu menus submenu "
    "breadcrumb breadcrumbs topbar masthead header footer foot comment comments commentlist "
    "disqus respond reply replies share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login popup modal overlay pagination pager "
    "toolbar widget widgets teaser teasers copyright".split())
_COMMENT_NAMES = {"comment", "comments", "reply", "replies", "respond"}
#: A name that begins like this tells of another element, not of this one.
_ABOUT = {"has", "with", "no", "without", "is", "not"}
_NEVER = {"html", "body"}
_PLAIN = set("p li ul ol dl dd dt div section tr td th table tbody pre blockquote".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _names(attrs: dict[str, str | None]) -> set[str]:
    """The words of an element's class and id."""
    words = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()[:50]:
        parts = [part.lower() for part in _PARTS.findall(name[:200])]
        if parts and parts[0] not in _ABOUT:
            words.update(parts)
    return words


class _Lines(HTMLParser):
    """Lines of a page with their tags, and the element that each stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, bool]] = []  # tag, element, out, in article
        self.counts: Counter = Counter()  # of open tags
        self.deeper: Counter = Counter()  # of open tags below the deepest
        self.parents, self.kinds = [-1], ["html"]
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.elements: list[int] = []
        self.left_out: list[bool] = []
        self.heading: list[bool] = []
        self.held: list[str] = []
        self.seen = 0

    # The whole page is there, so markup without an end is cut off by the page's end. The
    # parser would search the rest of the page again for each such tag.

    def parse_comment(self, i, report=1):
        end = self.rawdata.find("-->", i + 4)
        return len(self.rawdata) if end < 0 else end + 3

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i + 3)
        return len(self.rawdata) if end < 0 else end + 1

    def updatepos(self, i, j):
        return j  # line numbers are not asked for

    def _cut_off(self, end):
        return len(self.rawdata) if end < 0 else end

    def parse_html_declaration(self, i):
        return self._cut_off(super().parse_html_declaration(i))

    def parse_pi(self, i):
        return self._cut_off(super().parse_pi(i))

    def parse_starttag(self, i):
        return self._cut_off(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._cut_off(super().parse_endtag(i))

    def unknown_decl(self, data):
        pass

    def _flush(self):
        if not self.held:
            return
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            _, element, out, _ = self.open[-1] if self.open else ("html", 0, KEPT, False)
            self.texts.append(text)
            self.tags.append(self.seen)
            self.elements.append(element)
            self.left_out.append(out != KEPT)
            self.heading.append(any(self.counts[tag] for tag in _HEADINGS))
            self.seen = 0

    def _close(self, names: set[str], scopes: set[str]):
        """End the innermost open element of these names, unless a scope is further in."""
        for name in names:
            if self.counts[name]:
                break
        else:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth][0]
            if tag in names:
                for ended, *_ in self.open[depth:]:
                    self.counts[ended] -= 1
                del self.open[depth:]
                return
            if tag in scopes:
                return

    def _stands_out(self, tag: str, attrs: dict[str, str | None], out: int,
                    in_article: bool) -> int:
        """Why an element is left out, given the same of its parent."""
        if out == OUT or tag in _OUT_TAGS:
            return OUT
        if not attrs and tag in _PLAIN:
            return out
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none", (attrs.get("style") or "")[:1000])
        if hidden and tag not in _NEVER:
            return OUT
        names = _names(attrs)
        if tag in ("article", "main"):
            return OUT if names & _COMMENT_NAMES else KEPT
        if tag in _NEVER:
            return out
        if (attrs.get("role") or "").lower() in _OUT_ROLES:
            return OUT
        if tag == "header":
            return ARTICLE_HEADER if in_article else OUT
        if tag in _HEADINGS:
            names.discard("header")
            out = KEPT if out == ARTICLE_HEADER else out
        if in_article:
            names.discard("header")
        if names & _OUT_NAMES:
            return OUT
        return IN_FORM if tag == "form" else out

    def handle_starttag(self, tag, attrs):
        self.seen += 1
        if tag == "br":
            self.held.append(" ")
        if tag not in _BLOCKS:
            return
        self._flush()
        if tag == "hr":
            return
        if tag in _ENDS:
            self._close(*_ENDS[tag])
        if self.counts["p"]:
            self._close({"p"}, _SCOPES)
        if self.open and self.open[-1][0] == "head" and tag not in _HEAD:
            self._close({"head"}, set())
        if len(self.open) >= DEEPEST:
            self.deeper[tag] += 1
            return
        _, parent, out, in_article = self.open[-1] if self.open else ("html", 0, KEPT, False)
        attributes = dict(attrs)
        kind = tag
        if attributes.get("role") in ("main", "article"):
            kind = attributes["role"]
        elif attributes.get("itemprop") == "articleBody":
            kind = "article"
        self.parents.append(parent)
        self.kinds.append(kind)
        self.counts[tag] += 1
        self.open.append((tag, len(self.kinds) - 1,
                          self._stands_out(tag, attributes, out, in_article),
                          in_article or kind in ("article", "main")))

    def handle_startendtag(self, tag, attrs):
        # A slash ends no element but in foreign markup, whose text is left out.
        if tag in ("svg", "math"):
            self._flush()
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.seen += 1
        if tag not in _BLOCKS:
            return
        self._flush()
        if self.deeper[tag]:
            self.deeper[tag] -= 1
        elif tag not in ("body", "html"):
            self._close({tag}, _SCOPES if tag == "p" else set())

    def handle_data(self, data):
        self.held.append(data)

    def lines(self, page: str) -> _Lines:
        self.feed(page)
        self.close()
        self._flush()
        return self


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios under a Gaussian of ``sigma`` lines, cut at three sigma; edges repeat nothing."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach:reach + len(ratios)]


def content_threshold(values: np.ndarray) -> float:
    """Two-means clustering in one dimension, from the extremes; the midpoint of the means."""
    low, high = float(values.min()), float(values.max())
    while True:
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all() or not upper.any():
            return cut
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            return cut
        low, high = new


def _outermost(element: int, parents: list[int], kinds: list[str], kind: str,
               known: dict[int, int]) -> int:
    """The outermost ancestor of that kind, 0 if there is none."""
    path = []
    while element > 0 and element not in known:
        path.append(element)
        element = parents[element]
    found = known.get(element, 0)
    for at in reversed(path):
        if not found and kinds[at] == kind:
            found = at
        known[at] = found
    return found


def extract(page: str) -> str:
    """The main text of one page."""
    page_lines = _Lines().lines(page)
    texts, elements, out = page_lines.texts, page_lines.elements, page_lines.left_out
    if not texts or all(out):
        return ""
    keep = ~np.array(out)
    ratios = np.array([len(text) / max(1, tags) if kept else 0.0 for text, tags, kept
                       in zip(texts, page_lines.tags, keep.tolist())])
    smooth = np.where(keep, smoothed(ratios), 0.0)
    weight = np.where(keep & (smooth >= content_threshold(smooth[keep])), smooth, 0.0)
    for kind in ("article", "main"):
        known: dict[int, int] = {}
        region = np.array([_outermost(e, page_lines.parents, page_lines.kinds, kind, known)
                           for e in elements])
        inside = keep & (region > 0)
        if inside.any():
            chosen = set(region[inside & (weight > 0)].tolist())
            if not chosen:
                mass = np.bincount(region[inside], ratios[inside])
                chosen = {int(mass.argmax()) or int(region[inside][0])}
            return "\n".join(text for text, at, kept in zip(texts, region.tolist(), keep.tolist())
                             if kept and at in chosen)
    return "\n".join(texts[i] for i in _densest(page_lines, keep, weight))


def _densest(page: _Lines, keep: np.ndarray, weight: np.ndarray) -> list[int]:
    """Lines of the deepest element that holds most of the content."""
    mass = np.bincount(page.elements, weight, minlength=len(page.kinds))
    for element in range(len(page.kinds) - 1, 0, -1):  # children come after their parents
        mass[page.parents[element]] += mass[element]
    enough = np.flatnonzero(mass >= SHARE * weight.sum())
    # A line's own paragraph, cell or list item is no region of the page.
    wide = [e for e in enough.tolist() if page.kinds[e] in ("div", "section", "td", "center")]
    region = max(wide, default=0)
    inside = np.zeros(len(page.kinds), dtype=bool)
    inside[region] = True
    for element in range(region + 1, len(page.kinds)):
        inside[element] = inside[page.parents[element]]
    at = np.flatnonzero(keep & inside[np.array(page.elements)]).tolist()
    if region:
        return at
    content = [k for k, i in enumerate(at) if weight[i] > 0]
    first, last = content[0], content[-1]
    while first and page.heading[at[first - 1]]:
        first -= 1
    return at[first:last + 1]


def main_texts(pages: DataFrame, html: str = "html", key: str = "page_id",
               url: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                        F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_in = texts_of(batch["html"])
            for part in bounded_slices(pages_in):
                texts = [extract(page) for page in pages_in[part]]
                yield pa.RecordBatch.from_arrays(
                    [batch["page_id"][part], batch["url"][part], pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return in_arrow(
        rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
