"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks of text between block-level tags. A block has its word count, the share
of its words in links, the same of its neighbours, and what the elements around it say: tags, and
words of their class and id. None of these decides alone. A decision tree, grown from a small
labelled table, weighs them and says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import fresh, places, received, sent

# Elements that hold no text of the page.
SILENT = frozenset("script style noscript template title textarea select option iframe object svg math canvas audio video button".split())
SILENT_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in SILENT}
# Elements that begin or end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Block elements that are open until they, or one around them, are closed.
CONTAINER = frozenset("article aside body details dialog div dl fieldset footer form header main menu nav ol section table ul head".split())
# Elements and roles around text that is not main text.
OUTSIDE = frozenset("nav footer aside form menu dialog head fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in class or id of what is not main text.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promotion "
    "banner banners cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup login comment comments commentlist respond reply replies discussion disqus menu menus nav navbar navigation breadcrumb "
    "breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar share sharing social related recommended "
    "recommendations pagination pager toolbar search skip form hidden disclaimer legal copyright".split()
)
# Words in class or id of what holds the article.
INSIDE_WORDS = frozenset("article post entry story content".split())
# Elements whose own lines are content more often than page furniture.
LISTING = frozenset("table ul ol dl".split())
# A tag ends at its '>' or before the next '<', so that a page of open tags is read once, not once for each.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^<>]*>|</?[a-zA-Z!][^<>]*\Z", re.S
)
ATTRIBUTE = re.compile(r"""(?:\A|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
FEATURES = (
    "tag", "strong", "weak", "around", "inside", "page_inside", "clean", "heading",
    "words", "links", "words_before", "links_before", "words_after", "links_after",
)

# The labelled table. A row: inside an article, page with an article, heading, words, links, words and links of the
# block before, words and links of the block after, main text or not.
# Blocks within elements that are page furniture by their tag or by a whole word of their class, on pages that have
# other text: menus, headers and footers, adverts, forms, comments.
FURNITURE = [
    (0, 1, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (0, 1, 0, 2, 1.0, 1, 1.0, 3, 1.0, 0),
    (0, 1, 0, 12, 0.0, 1, 1.0, 9, 0.0, 0),
    (0, 1, 0, 7, 0.0, 90, 0.0, 0, 0.0, 0),
    (1, 1, 0, 30, 0.0, 80, 0.0, 25, 0.1, 0),
    (1, 1, 0, 3, 0.7, 60, 0.0, 4, 1.0, 0),
    (1, 1, 1, 2, 0.0, 60, 0.0, 22, 0.0, 0),
    (0, 0, 0, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    (0, 0, 0, 40, 0.0, 70, 0.0, 35, 0.0, 0),
    (0, 0, 0, 9, 0.1, 120, 0.0, 0, 0.0, 0),
    (0, 0, 1, 3, 0.0, 2, 1.0, 14, 0.0, 0),
    (1, 1, 0, 120, 0.0, 6, 0.0, 90, 0.0, 0),
    (0, 1, 0, 9, 0.0, 1, 1.0, 60, 0.0, 0),
    (0, 1, 0, 20, 0.0, 2, 1.0, 90, 0.0, 0),
    (0, 1, 0, 8, 0.0, 0, 0.0, 12, 0.0, 0),
    (0, 1, 1, 5, 0.0, 0, 0.0, 45, 0.0, 0),
    (0, 1, 0, 60, 0.0, 90, 0.0, 70, 0.0, 0),
    (0, 0, 0, 18, 0.0, 3, 1.0, 80, 0.0, 0),
    (0, 0, 0, 30, 0.0, 0, 0.0, 40, 0.0, 0),
    (0, 0, 1, 7, 0.0, 2, 0.0, 66, 0.0, 0),
    (0, 0, 0, 80, 0.0, 60, 0.0, 75, 0.0, 0),
    (0, 0, 0, 22, 0.1, 70, 0.0, 3, 1.0, 0),
    (0, 0, 0, 4, 0.0, 60, 0.0, 40, 0.0, 0),
    (0, 0, 0, 35, 0.0, 8, 0.0, 90, 0.0, 0),
    (1, 1, 0, 14, 0.0, 70, 0.0, 80, 0.0, 0),
    (1, 1, 0, 60, 0.0, 55, 0.0, 0, 0.0, 0),
    (1, 1, 1, 4, 0.0, 40, 0.0, 62, 0.0, 0),
    (1, 1, 0, 5, 1.0, 90, 0.0, 33, 0.0, 0),
]
# Blocks that no element speaks against.
PLAIN = [
    # inside the article, whatever its length
    (1, 1, 1, 9, 0.0, 12, 0.0, 10, 0.0, 1),
    (1, 1, 0, 10, 0.0, 9, 0.0, 64, 0.0, 1),
    (1, 1, 0, 1, 0.0, 80, 0.0, 75, 0.0, 1),
    (1, 1, 0, 2, 0.0, 3, 0.0, 7, 0.0, 1),
    (1, 1, 0, 250, 0.02, 70, 0.0, 31, 0.0, 1),
    (1, 1, 0, 45, 0.2, 250, 0.0, 8, 0.0, 1),
    (1, 1, 0, 4, 1.0, 60, 0.0, 70, 0.0, 1),
    (1, 1, 0, 24, 0.0, 55, 0.0, 1, 1.0, 1),
    (1, 1, 1, 1, 0.0, 1, 1.0, 0, 0.0, 1),
    (1, 1, 0, 3, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 1, 0, 60, 0.0, 40, 0.0, 0, 0.0, 1),
    (1, 1, 0, 160, 0.1, 0, 0.0, 0, 0.0, 1),
    (1, 1, 0, 90, 0.0, 2, 1.0, 0, 0.0, 1),
    (1, 1, 0, 7, 0.0, 2, 1.0, 1, 1.0, 1),
    (1, 1, 0, 15, 0.9, 3, 0.9, 12, 0.8, 1),
    (1, 1, 0, 40, 0.6, 1, 1.0, 70, 0.0, 1),
    (1, 1, 0, 2, 1.0, 2, 1.0, 2, 1.0, 1),
    (1, 1, 1, 4, 0.0, 6, 0.0, 3, 0.0, 1),
    # beside an article
    (0, 1, 0, 3, 0.0, 0, 0.0, 9, 0.0, 0),
    (0, 1, 0, 5, 0.0, 70, 0.0, 4, 0.0, 0),
    (0, 1, 0, 40, 0.0, 0, 0.0, 80, 0.0, 0),
    (0, 1, 1, 6, 0.0, 60, 0.0, 45, 0.0, 0),
    (0, 1, 0, 90, 0.0, 50, 0.0, 60, 0.0, 0),
    (0, 1, 0, 6, 0.0, 1, 1.0, 12, 0.0, 0),
    (0, 1, 0, 28, 0.0, 2, 1.0, 10, 0.0, 0),
    (0, 1, 1, 3, 0.0, 5, 1.0, 11, 0.0, 0),
    (0, 1, 0, 2, 1.0, 70, 0.0, 2, 1.0, 0),
    (0, 1, 0, 60, 0.1, 80, 0.0, 0, 0.0, 0),
    (0, 1, 0, 20, 0.0, 1, 1.0, 75, 0.0, 0),
    (0, 1, 0, 18, 0.0, 0, 0.0, 0, 0.0, 0),
    # pages that mark no article: long blocks, and short ones next to them
    (0, 0, 0, 120, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 70, 0.0, 50, 0.0, 0, 0.0, 1),
    (0, 0, 0, 33, 0.1, 3, 1.0, 28, 0.0, 1),
    (0, 0, 0, 26, 0.0, 40, 0.0, 5, 1.0, 1),
    (0, 0, 0, 80, 0.0, 60, 0.0, 75, 0.0, 1),
    (0, 0, 0, 35, 0.05, 8, 0.0, 90, 0.0, 1),
    (0, 0, 0, 22, 0.1, 70, 0.0, 3, 1.0, 1),
    (0, 0, 0, 18, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 1, 7, 0.0, 2, 1.0, 66, 0.0, 1),
    (0, 0, 1, 2, 0.0, 0, 0.0, 60, 0.0, 1),
    (0, 0, 1, 3, 0.0, 1, 1.0, 45, 0.0, 1),
    (0, 0, 1, 1, 0.0, 2, 1.0, 30, 0.0, 1),
    (0, 0, 0, 3, 0.0, 2, 1.0, 50, 0.0, 0),
    (0, 0, 0, 2, 0.0, 60, 0.0, 0, 0.0, 1),
    (0, 0, 0, 4, 0.0, 35, 0.0, 9, 0.0, 1),
    (0, 0, 0, 1, 0.0, 90, 0.0, 3, 1.0, 1),
    (0, 0, 0, 4, 0.0, 60, 0.0, 40, 0.0, 1),
    (0, 0, 0, 2, 0.0, 45, 0.0, 38, 0.1, 1),
    (0, 0, 0, 60, 0.3, 80, 0.0, 50, 0.0, 1),
    (0, 0, 0, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    (0, 0, 0, 4, 1.0, 3, 1.0, 50, 0.0, 0),
    (0, 0, 0, 25, 0.9, 4, 1.0, 30, 0.8, 0),
    (0, 0, 0, 14, 0.7, 60, 0.0, 6, 1.0, 0),
    (0, 0, 0, 5, 0.0, 3, 1.0, 4, 1.0, 0),
    (0, 0, 0, 3, 0.0, 2, 1.0, 0, 0.0, 0),
    (0, 0, 1, 2, 0.0, 4, 1.0, 3, 1.0, 0),
    (0, 0, 0, 50, 0.6, 3, 1.0, 5, 1.0, 0),
]
# Blocks of which a part of a class word speaks ("category-search"), or a list or table of such a class.
DOUBTFUL = [
    (1, 1, 0, 80, 0.0, 6, 0.0, 40, 0.0, 1),
    (1, 1, 0, 3, 0.0, 80, 0.0, 4, 0.0, 1),
    (1, 1, 0, 2, 0.0, 3, 0.0, 3, 0.0, 1),
    (1, 1, 1, 5, 0.0, 30, 0.0, 60, 0.0, 1),
    (1, 1, 0, 30, 0.2, 50, 0.0, 0, 0.0, 1),
    (1, 1, 0, 12, 0.3, 9, 0.1, 14, 0.2, 1),
    (1, 1, 0, 2, 1.0, 60, 0.0, 2, 1.0, 0),
    (1, 1, 0, 4, 1.0, 3, 1.0, 5, 0.8, 0),
    (1, 1, 0, 9, 0.7, 40, 0.0, 6, 1.0, 0),
    (1, 1, 0, 3, 0.7, 2, 1.0, 70, 0.0, 0),
    (1, 1, 0, 20, 0.8, 5, 0.9, 30, 0.0, 0),
    (0, 1, 0, 40, 0.0, 70, 0.0, 30, 0.0, 0),
    (0, 1, 0, 4, 0.6, 3, 1.0, 9, 0.0, 0),
    (0, 0, 0, 70, 0.0, 50, 0.0, 60, 0.0, 1),
    (0, 0, 0, 28, 0.1, 3, 1.0, 45, 0.0, 1),
    (0, 0, 1, 6, 0.0, 2, 1.0, 66, 0.0, 1),
    (0, 0, 0, 3, 1.0, 2, 1.0, 4, 1.0, 0),
    (0, 0, 0, 5, 0.0, 3, 1.0, 4, 1.0, 0),
]
# Blocks within furniture on pages that have no other text: a whole page in a form, or in a box of an odd name.
ONLY_TEXT = [
    (1, 1, 0, 90, 0.0, 8, 0.0, 70, 0.0, 1),
    (1, 1, 0, 4, 0.0, 60, 0.0, 80, 0.0, 1),
    (1, 1, 1, 6, 0.0, 0, 0.0, 50, 0.0, 1),
    (1, 1, 0, 45, 0.2, 30, 0.0, 0, 0.0, 1),
    (1, 1, 0, 2, 1.0, 40, 0.0, 2, 1.0, 0),
    (1, 1, 0, 8, 0.8, 3, 1.0, 50, 0.0, 0),
    (0, 0, 0, 120, 0.0, 40, 0.0, 60, 0.0, 1),
    (0, 0, 0, 30, 0.1, 2, 1.0, 70, 0.0, 1),
    (0, 0, 0, 50, 0.0, 70, 0.0, 0, 0.0, 1),
    (0, 0, 0, 2, 0.0, 60, 0.0, 0, 0.0, 1),
    (0, 0, 0, 4, 0.0, 35, 0.0, 9, 0.0, 1),
    (0, 0, 1, 5, 0.0, 0, 0.0, 70, 0.0, 1),
    (0, 0, 0, 3, 1.0, 2, 1.0, 4, 1.0, 0),
    (0, 0, 0, 5, 0.0, 3, 1.0, 4, 1.0, 0),
    (0, 0, 0, 16, 0.9, 3, 1.0, 9, 0.9, 0),
    (0, 1, 0, 40, 0.0, 20, 0.0, 30, 0.0, 0),
    (0, 1, 0, 5, 0.0, 20, 0.0, 30, 0.0, 0),
]


def labelled() -> list[tuple]:
    """The table with all features: what speaks against a block, and how much other text the page has."""
    some = (1.0, 0.8, 0.5, 0.2)
    rows = [(0, 0, 0, 0, r[0], r[1], clean, *r[2:]) for r in PLAIN for clean in (*some, 0.0)]
    rows += [(0, 0, 1, 0, r[0], r[1], clean, *r[2:]) for r in DOUBTFUL for clean in (*some, 0.0)]
    for speaks in ((1, 0), (0, 1), (1, 1)):  # a tag, a whole word, both
        rows += [(*speaks, 0, 0, r[0], r[1], clean, *r[2:]) for r in FURNITURE for clean in some]
        rows += [(*speaks, 0, 0, r[0], r[1], 0.0, *r[2:]) for r in ONLY_TEXT]
    # Articles within furniture: teasers and comments beside the article, but the article itself if it is the only one.
    whole = [r for r in PLAIN if r[0]]
    rows += [(0, 0, 0, 1, r[0], r[1], clean, *r[2:-1], 0) for r in whole for clean in some]
    rows += [(0, 0, 0, 1, r[0], r[1], 0.0, *r[2:]) for r in whole]
    return rows


@dataclass
class Tree:
    """A node: a test (feature < limit goes left), or a verdict."""

    verdict: bool = False
    feature: int = -1
    limit: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray) -> Tree:
        """Splits by least Gini impurity until every leaf is pure or cannot be split."""
        if y.min() == y.max():
            return cls(bool(y[0]))
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, f] < limit
                impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(limit))
        if best is None:
            return cls(bool(y.mean() >= 0.5))
        _, f, limit = best
        low = x[:, f] < limit
        return cls(False, f, limit, cls.grow(x[low], y[low]), cls.grow(x[~low], y[~low]))

    def says(self, row: tuple) -> bool:
        node = self
        while node.feature >= 0:
            node = node.left if row[node.feature] < node.limit else node.right
        return node.verdict


def trained() -> Tree:
    table = np.array(labelled(), float)
    return Tree.grow(table[:, :-1], table[:, -1])


@dataclass
class Place:
    """What the open elements say about the text in them."""

    tag: bool = False  # an element of page furniture, within the article if there is one
    strong: bool = False  # a class word that is nothing but furniture, likewise
    weak: bool = False  # a class word with a part that is furniture, likewise
    around: bool = False  # furniture around the article itself
    inside: bool = False  # in an article
    form: bool = False  # a form, which some sites put around everything


@dataclass
class Block:
    text: str
    words: int
    links: float
    place: Place
    heading: bool

    @property
    def plain(self) -> bool:
        return not (self.place.tag or self.place.form or self.place.strong or self.place.around)


def within(outer: Place, name: str, attributes: str) -> Place:
    """What holds inside an element that is opened in ``outer``."""
    marked = {}
    if attributes.strip():
        marked = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(attributes)}
    names = [set(re.split(r"[^a-z0-9]+", t)) - {""} for t in f"{marked.get('class', '')} {marked.get('id', '')}".split()]
    names = [t for t in names if t]
    role = marked.get("role", "")
    words = OUTSIDE_WORDS if outer.inside else OUTSIDE_WORDS | {"header"}
    strong = any(t <= words for t in names)
    weak = any(not t.isdisjoint(words) for t in names) and not strong
    form = name == "form" and role not in OUTSIDE_ROLES
    tag = (
        (name in OUTSIDE and not form)
        or (name == "header" and not outer.inside)
        or role in OUTSIDE_ROLES
        or "hidden" in marked
        or marked.get("aria-hidden") == "true"
        or "display:none" in marked.get("style", "").replace(" ", "")
    )
    article = (
        name in ("article", "main")
        or role in ("main", "article")
        or (name in ("div", "section") and any(not t.isdisjoint(INSIDE_WORDS) and t.isdisjoint(words) for t in names))
    )
    if article:  # what stood around it until here, but for a form, is around the article
        return Place(around=outer.around or outer.strong or outer.tag or strong or tag, inside=True)
    if name in ("body", "head"):
        strong = weak = False
    if strong and name in LISTING:
        strong, weak = False, True
    if form:  # its words say nothing about an article in it
        return replace(outer, form=True)
    return Place(outer.tag or tag, outer.strong or strong, outer.weak or weak, outer.around, outer.inside, outer.form)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, white space made single spaces, references decoded."""
    out: list[Block] = []
    parts: list[str] = []  # text of the block so far; texts in links are counted apart
    linked: list[str] = []
    stack: list[tuple[str, Place]] = []  # open containers
    opened: Counter[str] = Counter()
    heading, in_link, at = False, False, 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                n = len(html.unescape(" ".join(linked)).split()) if linked else 0
                here = stack[-1][1] if stack else Place()
                out.append(Block(" ".join(words), len(words), min(1.0, n / len(words)), here, heading))
            parts, linked = [], []

    while True:
        m = TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            parts.append(text)
            if in_link:
                linked.append(text)
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        name, ends = m[2].lower(), bool(m[1])
        if name in SILENT:
            if not ends and not m[3].rstrip().endswith("/"):
                end = SILENT_ENDS[name].search(page, at)
                at = end.end() if end else len(page)
            parts.append(" ")
        elif name == "a":
            in_link = not ends
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK:
            close()
            if name in CONTAINER:
                in_link = False
                if not ends:
                    stack.append((name, within(stack[-1][1] if stack else Place(), name, m[3])))
                    opened[name] += 1
                elif opened[name]:
                    last = ""
                    while last != name:
                        last = stack.pop()[0]
                        opened[last] -= 1
            heading = not ends and name in ("h1", "h2", "h3", "h4", "h5", "h6")
    close()
    return out


def clean_share(found: list[Block], some: bool) -> float:
    """The share of a page's running text (in articles, if it has any) that no element speaks against."""
    pool = [b for b in found if b.links < 0.5 and (b.place.inside if some else b.words >= 10)]
    return sum(b.words for b in pool if b.plain) / max(1, sum(b.words for b in pool))


def main_text(page: str | None, tree: Tree) -> str:
    """The page's main blocks, one a line; empty if there are none."""
    found = blocks(page or "")
    some = any(b.place.inside for b in found)
    clean = clean_share(found, some)
    ends = Block("", 0, 0.0, Place(), False)
    kept = []
    for before, b, after in zip([ends, *found], found, [*found[1:], ends]):
        p = b.place
        row = (p.tag or p.form, p.strong, p.weak, p.around, p.inside, some, clean, b.heading)
        row += (b.words, b.links, before.words, before.links, after.words, after.links)
        if tree.says(row):
            kept.append(b.text)
    return "\n".join(kept)


def extract_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., html) -> (..., text)."""
    tree = received(shared)
    for whole in batches:
        for first in range(0, whole.num_rows, 512):
            batch = whole.slice(first, 512)
            texts = [main_text(page, tree) for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=places(batch.num_columns))


def extract(pages: DataFrame, source: str = "html", into: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``pages`` with the main text of ``source``.

    Null and empty pages have an empty text. Pages cut off in a tag, comment or script lose that
    remnant only. Each row is worked on alone: no shuffle, no limit of length.
    """
    keep = keep or list(pages.columns)
    into = fresh(pages.select(*[f"`{c}`" for c in keep]), into)
    body = fresh(pages, "_page")
    shared = sent(pages.sparkSession, trained())
    rows = pages.select(*[f"`{c}`" for c in keep], F.col(f"`{source}`").cast("string").alias(body))
    kinds = "".join(f"`{c.name}` {c.dataType.simpleString()}, " for c in rows.drop(body).schema)
    done = rows.mapInArrow(lambda b: extract_batches(b, shared), f"{kinds}`{body}` string")
    return done.select(*[f"`{c}`" for c in keep], F.col(body).alias(into))
