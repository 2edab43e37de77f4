"""Main-text extraction by tag-path ratios.

A page becomes a sequence of text nodes, each with its root-to-leaf tag path.
For each path the text length and the punctuation per node are summed over the
page; the two ratios, smoothed over neighbouring nodes in page order and fused
(their geometric mean), score the nodes, and nodes above a threshold taken from the
page's own scores are selected. The region is the smallest element that holds
all selected nodes, widened to the article around it. The main text is the selected
nodes, the rest of the article (in other regions: of the containers, div or section,
that hold a selected node), and short runs of text between these, so that a heading, a
list or a short paragraph is not lost; of that rest, groups made half or more of links
stay out, as menus do. Left out by their tag: scripts, styles, navigation, footers,
asides, controls. Forms, page headers and elements whose class, id or role names
navigation, sidebars, adverts or notices are left out unless half of the page's selected
text or more is inside and no article or main element beside them has selected text.
Elements named as reader comments are left out however long they are, if anything
selected lies outside them.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by one line feed. Null or empty html, or a page
without text: the empty text. Equal rows give equal results, one each. Extra
columns are not read. Whole pages are read; every page is one row of its task. The
time is in proportion to the page, however deep its elements nest.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody
td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "option"}
HIDDEN = frozenset("""script style noscript template head title nav footer aside button select textarea option iframe object svg
math canvas audio video dialog menu noframes datalist input label""".split())
FORM = frozenset(("form", "fieldset"))
GROUP = frozenset("ul ol menu dl table div section article main body html".split()) | {""}
CONTAINER = frozenset(("div", "section", "article", "main", "body", "html", ""))
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": {"tr"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "option": {"select"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
# names of page furniture in class, id and role
FURNITURE = re.compile(
    r"(?<![a-z])(ads?|advert\w*|adsense|adslot|adbox|banner\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alerts?|"
    r"sidebar\w*|side-?bar|rail|complementary|nav|navbar|navigation|menus?|breadcrumbs?|pagination|pager|toolbar|masthead|"
    r"footer\w*|contentinfo|comments?|commentlist|comment-?list|disqus\w*|repl(?:y|ies)|respond|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|popup|modal|overlay|login|signup|search|widgets?)(?![a-z])", re.I)
# names that are those of reader comments as a whole
COMMENTS = re.compile(r"(?:user-?|reader-?)?(?:comments?|comment-?list|comments?[-_](?:area|section|list|wrap\w*|threads?|container|block|box)|"
                      r"disqus\w*|repl(?:y|ies)|respond|responses)", re.I)
HEADER = re.compile(r"(?<![a-z])(site|page|top)?[-_]?header(?![a-z])", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؛،]")
SPACE = re.compile(r"\s+")


class _Element:
    """An open or closed element; what its ancestors say is taken over when it opens."""

    __slots__ = ("tag", "parent", "path", "depth", "hidden", "named", "comments", "article", "link", "block_at", "home", "group",
                 "mass", "above", "below", "out", "within")

    def __init__(self, tag, parent, path, hidden, named, comments):
        self.tag, self.parent, self.path, self.hidden, self.named, self.comments = tag, parent, path, hidden, named, comments
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.link = tag == "a" or (parent is not None and parent.link)
        self.block_at = self.depth if tag in BLOCK else parent.block_at if parent else 0  # stack place of the nearest block
        self.home = self if tag in CONTAINER else parent.home
        self.group = self if tag in GROUP else parent.group


class _Page(HTMLParser):
    """Text nodes of a page in order: (element, block number, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        root = _Element("", None, 0, False, False, False)
        self.stack, self.elements = [root], [root]  # elements: parents before children
        self.open: dict[str, list[int]] = defaultdict(list)  # stack places of each tag
        self.paths: dict[tuple[int, str], int] = {}
        self.nodes: list[tuple[_Element, int, str]] = []
        self.block = 0

    def _pop_to(self, depth: int) -> None:
        for e in self.stack[depth:]:
            self.open[e.tag].pop()
            if e.tag in BLOCK:
                self.block += 1
        del self.stack[depth:]

    def _last(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open[t]), default=0)

    def _implied_end(self, tag: str) -> None:
        if tag in CLOSES_P and self.stack[at := self.stack[-1].block_at].tag == "p":
            self._pop_to(at)
        if tag in SIBLINGS and (at := self._last(SIBLINGS[tag])) > self._last(SCOPE[tag]):
            self._pop_to(at)

    def handle_starttag(self, tag, attrs):
        self._implied_end(tag)
        top = self.stack[-1]
        hidden = top.hidden or tag in HIDDEN
        # the header of a page is furniture, that of an article holds its heading
        named = tag in FORM or (tag == "header" and not top.article)
        comments = False
        if not hidden and tag not in ("html", "body", "article", "main"):
            for name, value in attrs:
                if name in ("hidden", "aria-hidden") and (name == "hidden" or value == "true"):
                    hidden = True
                elif value and name in ("class", "id", "role"):
                    if FURNITURE.search(value) or (not top.article and HEADER.search(value)):
                        named = True
                    comments = comments or any(COMMENTS.fullmatch(x) for x in value.split())
        if tag in BLOCK:
            self.block += 1
        if tag == "br":
            self.nodes.append((top, self.block, " "))
        if tag not in VOID:
            path = self.paths.setdefault((top.path, tag), len(self.paths) + 1)
            e = _Element(tag, top, path, hidden, named, comments)
            self.open[tag].append(len(self.stack))
            self.stack.append(e)
            self.elements.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "<p/>" opens a p

    def handle_endtag(self, tag):
        at = self._last((tag,))
        # the end of an inline element does not reach out of a table cell
        if at and (tag in BLOCK or at > self._last(("td", "th", "table"))):
            self._pop_to(at)

    def handle_data(self, data):
        self.nodes.append((self.stack[-1], self.block, data))


def _scores(nodes: list[tuple[_Element, int, str]]) -> list[float]:
    """Fused, smoothed path ratios of the nodes."""
    chars, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for e, _, text in nodes:
        t = text.strip()
        if t:
            chars[e.path] += len(t)
            marks[e.path] += len(PUNCTUATION.findall(t))
            count[e.path] += 1

    def ratio(total, path):
        return total[path] / count[path] if count[path] else 0.0

    a = [ratio(chars, e.path) for e, _, _ in nodes]
    b = [ratio(marks, e.path) for e, _, _ in nodes]

    def smooth(x):
        return [(x[max(i - 1, 0)] + 2 * x[i] + x[min(i + 1, len(x) - 1)]) / 4 for i in range(len(x))]

    return [(p * q) ** 0.5 for p, q in zip(smooth(a), smooth(b), strict=True)]


def _selected(nodes) -> list[bool]:
    """Whether a node's score reaches the threshold of the page."""
    scores = _scores(nodes)
    if not scores:
        return []
    mean = sum(scores) / len(scores)
    spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    limit = min(mean, 0.8 * spread) if spread else 0.0
    return [s >= limit for s in scores]


def _weigh(page, nodes, chosen) -> int:
    """Sets the selected characters inside each element; returns those of the page."""
    for e in page.elements:
        e.mass = 0
    total = 0
    for (e, _, text), on in zip(nodes, chosen, strict=True):
        if on:
            e.mass += len(text.strip())
            total += len(text.strip())
    for e in reversed(page.elements):
        if e.parent is not None:
            e.parent.mass += e.mass
    return total


def _without(page, nodes, drop):
    """The nodes outside the elements for which ``drop`` holds, and outside those left out before."""
    for e in page.elements:
        e.out = drop(e) or (e.parent is not None and e.parent.out)
    return [x for x in nodes if not x[0].out]


def _shown(page, nodes):
    """The nodes without reader comments, and without those of named elements that
    hold less than half of the selected text, or lie beside an article with
    selected text."""
    if any(e.comments for e in page.elements):
        texts = [x for x in nodes if x[2].strip()]
        total = _weigh(page, texts, _selected(texts))
        nodes = _without(page, nodes, lambda e: e.comments and e.mass < total)
    if not any(e.named for e in page.elements):
        return nodes
    texts = [x for x in nodes if x[2].strip()]
    total = _weigh(page, texts, _selected(texts))
    for e in page.elements:
        e.out = (e.named and 2 * e.mass < max(1, total)) or (e.parent is not None and e.parent.out)
    # articles with selected text around, inside and beside each element
    for e in page.elements:
        e.above = (e.parent.above if e.parent is not None else 0) + (e.tag in ("article", "main") and e.mass > 0 and not e.out)
        e.below = 0
    count = 0
    for e in reversed(page.elements):
        own = e.tag in ("article", "main") and e.mass > 0 and not e.out
        count += own
        e.below += own
        if e.parent is not None:
            e.parent.below += e.below
    return _without(page, nodes, lambda e: e.named and (2 * e.mass < max(1, total) or (e.mass > 0 and count > e.above + e.below)))


def _region(page, nodes, chosen) -> _Element | None:
    """The smallest element holding all selected nodes, widened to the article around it."""
    total = _weigh(page, nodes, chosen)
    if not total:
        return None
    best = max((e for e in page.elements if e.mass == total), key=lambda e: e.depth)
    at = best
    while at is not None:
        if at.tag in ("article", "main"):
            return at
        at = at.parent
    # a lone block or inline element: its siblings belong to the same text
    while best.parent is not None and best.tag not in ("div", "section", "td", "body", "html", ""):
        best = best.parent
    return best


def _filled(nodes, chosen, whole: bool) -> list[bool]:
    """``chosen`` with the rest of the text: of the article (``whole``), else of
    containers that hold a chosen node. Of that rest, groups made half or more of
    links stay out, unless in a run between chosen nodes that is shorter than
    these together (in an article, a run at its ends needs one neighbour)."""
    size = [len(x[2].strip()) for x in nodes]
    links, held = defaultdict(int), set()
    for (e, _, _), n, on in zip(nodes, size, chosen, strict=True):
        links[e.group] += n if e.link else -n
        if on:
            held.add(e.home)
    out = [on or ((whole or e.home in held) and links[e.group] < 0) for (e, _, _), on in zip(nodes, chosen, strict=True)]
    at = [i for i, on in enumerate(out) if on]
    for lo, hi in zip([-1, *at], [*at, len(nodes)], strict=True):
        ends = [i for i in (lo, hi) if 0 <= i < len(nodes)]
        if (len(ends) == 2 or whole) and sum(size[lo + 1 : hi]) < sum(size[i] for i in ends):
            out[lo + 1 : hi] = [True] * (hi - lo - 1)
    return out


def extract(html: str | None) -> str:
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    nodes = _shown(page, [x for x in page.nodes if not x[0].hidden])
    texts = [x for x in nodes if x[2].strip()]
    chosen = _selected(texts)
    region = _region(page, texts, chosen)
    if region is None:
        return ""
    for e in page.elements:
        e.within = e is region or (e.parent is not None and e.parent.within)
    inside = [(x, on) for x, on in zip(texts, chosen, strict=True) if x[0].within]
    keep = iter(_filled([x for x, _ in inside], [on for _, on in inside], region.tag in ("article", "main")))
    blocks: dict[int, list[str]] = {}
    for e, block, text in nodes:
        if e.within and (not text.strip() or next(keep)):
            blocks.setdefault(block, []).append(text)
    out = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n".join(x for x in out if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    src = pages.select("page_id", "url", "html")
    schema = src.schema

    def run(batches):
        for batch in batches:
            texts = [extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
