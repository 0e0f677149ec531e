"""Main text of web pages from streaming parser events and text-to-tag ratios.

The standard library's parser gives events; block elements cut the page into
lines. A line's ratio is its characters over its tags; the ratios are smoothed
with a Gaussian over neighbouring lines, and lines of at least a threshold, the
smoothed ratios' standard deviation, form content clusters. The clusters choose:

1. The region is the deepest container that holds MOST of the clusters' text, or
   the article and main elements with cluster text where they hold half of it: a page
   may have several, and their title stands beside the text. Elements without
   cluster text are no regions, article elements included.
2. In the region, lines of the clusters are content. So are its other lines, short
   paragraphs and list items, unless they are mostly link text: such a line outside
   the clusters is a menu, a list of tags or of further pages.

Lines inside menus, headers, footers, sidebars, notices, adverts, forms, comments
and the like, by element or by name, never take part.

Edge cases: null and empty html give an empty text, as do pages without text;
unclosed and stray tags are closed or skipped as their parents end; a page
without containers is one region; very long pages and deep nesting take time in
proportion to their size; repeated rows get equal texts; an empty table gives an
empty result; columns other than those named are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.5
#: Share of the clusters' text that a region must hold.
MOST = 0.6
#: Share of article and main elements in the clusters' text from which they are the regions.
SEMANTIC_SHARE = 0.5
#: Share of link text from which a line outside the clusters is no content.
LINKS = 0.5
# fixed values: element names and name parts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("aside button canvas dialog footer form head iframe input label menu nav noscript object script select style svg template textarea".split())
CONTAINER = frozenset("article body div main section td".split())
SEMANTIC = frozenset(("article", "main"))
ENDS_PARAGRAPH = BLOCK - {"caption", "dd", "dt", "html", "body", "legend", "li", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": "li", "dt": "dd dt", "dd": "dd dt", "td": "td th", "th": "td th", "tr": "td th tr", "option": "option"}
SCOPES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "td": "table tr", "th": "table tr", "tr": "table tbody thead tfoot", "option": "select"}
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-?bar|comments?|commentlist|disqus|repl(?:y|ies)|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|sharing|share|social|related|recommend\w*|breadcrumbs?|menu|nav|navbar|navigation|footer|masthead|site-?header|page-?header|topbar|toolbar|pagination|pager|widget|skip-?link|disclaimer)(?:$|[\s_-])",
    re.I,
)
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


class Lines(HTMLParser):
    """Collects lines: text, tags, whether excluded, innermost container, characters of link text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # name, excluded, innermost container or -1
        self.count: Counter[str] = Counter()  # of the open elements' names
        self.containers: list[tuple[str, int]] = []  # name, container around it or -1
        self.lines: list[tuple[str, int, bool, int, int]] = []
        self.text: list[str] = []
        self.tags = self.links = 0

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, excluded, inside = self.open[-1] if self.open else ("", False, -1)
            self.lines.append((text, self.tags, excluded, inside, self.links))
            self.tags = 0
        self.text, self.links = [], 0

    def close_at(self, k: int) -> None:
        """Ends the k-th open element and all inside it."""
        self.count.subtract(name for name, _, _ in self.open[k:])
        del self.open[k:]

    def close_to(self, names: set[str], scopes: set[str]) -> None:
        """Ends the nearest open element of these names, unless a scope stands between."""
        if not any(self.count[name] > 0 for name in names):
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in names:
                self.cut()
                self.close_at(k)
                return
            if self.open[k][0] in scopes:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
        self.tags += 1
        if tag in ENDS_PARAGRAPH:
            self.close_to({"p"}, {"button", "td", "th", "caption", "table"})
        if tag in SIBLINGS:
            self.close_to(set(SIBLINGS[tag].split()), set(SCOPES[tag].split()))
        if tag in VOID:
            if tag in ("br", "wbr", "hr"):
                self.text.append(" " if tag != "wbr" else "")
            return
        _, excluded, inside = self.open[-1] if self.open else ("", False, -1)
        if not excluded:
            own = dict(attrs)
            named = f"{own.get('class') or ''} {own.get('id') or ''}"
            hidden = "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style") or "") is not None
            noise = COMMENT if tag == "article" else NOISE
            noisy = tag not in ("html", "body", "main") and (bool(noise.search(named)) or (own.get("role") or "") in NOISE_ROLES)
            excluded = tag in NEVER or (tag == "header" and not any(self.count[x] > 0 for x in SEMANTIC)) or hidden or noisy
        if tag in CONTAINER:
            self.containers.append((tag, inside))
            inside = len(self.containers) - 1
        self.open.append((tag, excluded, inside))
        self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCK or tag in NEVER:
            self.cut()
        self.tags += 1
        if self.count[tag] <= 0:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.close_at(k)
                return
            if self.open[k][0] in BLOCK and tag not in BLOCK:
                return

    def handle_data(self, data):
        self.text.append(data)
        if self.count["a"] > 0:
            self.links += len(data.strip())

    def done(self) -> None:
        self.close()
        self.cut()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that fall outside are left out."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    cut = slice(reach, reach + len(ratios))
    return np.convolve(ratios, weights)[cut] / np.convolve(np.ones(len(ratios)), weights)[cut]


def clusters(sizes: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines belong to content clusters: smoothed ratios of at least their standard deviation."""
    ratios = smoothed(sizes / np.maximum(1, tags))
    return ratios >= min(ratios.std(), ratios.max())


def regions(containers: list[tuple[str, int]], votes: list[float], total: float) -> list[bool]:
    """For each container, whether it lies in a region; votes: cluster text inside each container, without its inner ones."""
    held, depth = list(votes), [0] * len(containers)
    for c in range(len(containers) - 1, -1, -1):
        if containers[c][1] >= 0:
            held[containers[c][1]] += held[c]
    semantic, outer = [False] * len(containers), 0.0
    for c, (name, around) in enumerate(containers):
        depth[c] = depth[around] + 1 if around >= 0 else 0
        # nested articles belong to the outer one
        semantic[c] = (name in SEMANTIC and held[c] > 0) or (around >= 0 and semantic[around])
        outer += held[c] if semantic[c] and not (around >= 0 and semantic[around]) else 0.0
    if outer >= SEMANTIC_SHARE * total and outer > 0:
        return semantic
    best = max((c for c in range(len(containers)) if held[c] >= MOST * total), key=depth.__getitem__, default=None)
    inside = [best is None] * len(containers)
    for c, (_, around) in enumerate(containers):
        inside[c] = inside[c] or c == best or (around >= 0 and inside[around])
    return inside


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.done()
    lines = [x for x in page.lines if not x[2]]
    if not lines:
        return ""
    sizes = np.array([len(x[0]) for x in lines], float)
    content = clusters(sizes, np.array([x[1] for x in lines])).tolist()
    votes = [0.0] * len(page.containers)
    for (text, _, _, inside, _), chosen in zip(lines, content):
        if chosen and inside >= 0:
            votes[inside] += len(text)
    chosen_text = float(sizes[content].sum())
    held = regions(page.containers, votes, chosen_text)
    anywhere = not page.containers or not any(held)
    own = [x[0] for x, chosen in zip(lines, content) if (anywhere or (x[3] >= 0 and held[x[3]])) and (chosen or x[4] < LINKS * len(x[0]))]
    return "\n\n".join(own)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Kept columns, text (main text) and n_chars (its code points)."""
    keep = [c for c in keep if c not in ("text", "n_chars")]

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    kinds = dict(pages.dtypes)
    return pages.select(*dict.fromkeys([*keep, html])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string, n_chars long"]))
