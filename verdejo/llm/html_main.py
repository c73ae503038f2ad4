"""Main text of web pages: flat text blocks, their own and their neighbours' word counts and link
densities, and a decision tree trained on a small labelled table.

Each page is one row of work, so nothing is shuffled. Markup is scanned once, in time linear in
its length. Defined cases: null or empty html gives an empty text; unclosed, stray and misnested
tags are tolerated; null ids and urls are kept; repeated rows give repeated results; only the three
named columns are read. White space is what Python's ``str.split`` splits at.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kit import map_batches

#: Markup whose content is no text of the page.
DROPPED = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "embed", "canvas", "audio", "video",
           "select", "textarea", "button", "head", "title", "map", "datalist", "xml"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}  # content is not markup
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img",
          "wbr", "br"}
#: A new one of these closes an open one of the same group that stands on top.
OPTIONAL_END = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
                "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = HEADINGS | {"div", "section", "article", "ul", "ol", "dl", "table", "blockquote", "pre", "nav", "header", "footer", "aside", "main",
                       "figure", "address", "form", "fieldset", "hr", "details"}
MAIN_TAGS = {"article", "main"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "menu", "dialog", "figcaption"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "sidebar", "menu", "nav", "navbar",
               "navigation", "footer", "header", "masthead", "cookie", "cookies", "consent", "notice", "notification", "alert", "promo",
               "promotion", "sponsor", "sponsored", "related", "recommended", "share", "sharing", "social", "comment", "comments", "reply",
               "replies", "discussion", "disqus", "breadcrumb", "breadcrumbs", "subscribe", "subscription", "newsletter", "popup", "modal",
               "overlay", "widget", "copyright", "disclaimer", "login", "signup", "toolbar", "pagination", "pager", "tags", "legal"}
#: Asides also where an article or main element bears the name or stands inside.
FOREIGN_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "promo", "promotion", "sponsor", "sponsored", "related",
                 "recommended", "comment", "comments", "reply", "replies", "discussion", "disqus", "widget"}
#: What follows one of these in a class name tells of the layout or the topic, not of the element's part in the page.
STATES = {"has", "have", "no", "not", "is", "with", "without", "category", "cat", "tag", "topic", "format", "type", "status"}
LONG_BLOCK = 20  # words; blocks of a form that are shorter stay only if long ones hold most of its text
MAIN_WORDS = {"article", "content", "main", "post", "entry", "story", "body", "text"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "toolbar"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                 r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKEN = re.compile(r"[a-z]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "in_aside")

#: Labelled blocks: the eight features in order, then 1 for main text. Fixed, made by hand from typical page layouts.
LABELLED = (
    # paragraphs and headings inside an article element
    (80, 0.00, 60, 0.00, 70, 0.00, 1, 0, 1), (45, 0.02, 80, 0.00, 30, 0.00, 1, 0, 1), (12, 0.00, 6, 1.00, 50, 0.00, 1, 0, 1),
    (8, 0.00, 0, 0.00, 90, 0.00, 1, 0, 1), (1, 0.00, 40, 0.00, 60, 0.00, 1, 0, 1), (3, 0.00, 20, 0.10, 4, 0.00, 1, 0, 1),
    (6, 0.00, 120, 0.00, 9, 0.20, 1, 0, 1), (25, 0.30, 60, 0.00, 50, 0.00, 1, 0, 1), (2, 0.00, 2, 0.00, 3, 0.00, 1, 0, 1),
    (150, 0.05, 10, 0.00, 8, 1.00, 1, 0, 1), (18, 0.00, 15, 0.00, 7, 0.60, 1, 0, 1), (4, 1.00, 55, 0.00, 62, 0.00, 1, 0, 1),
    (1, 0.00, 1, 0.00, 1, 0.00, 1, 0, 1), (33, 0.00, 4, 1.00, 0, 0.00, 1, 0, 1), (9, 0.50, 30, 0.00, 41, 0.00, 1, 0, 1),
    (4, 0.00, 4, 0.00, 30, 0.00, 1, 0, 1), (2, 0.00, 1, 1.00, 2, 0.00, 1, 0, 1), (1, 1.00, 3, 0.00, 2, 0.00, 1, 0, 1),
    (5, 0.00, 0, 0.00, 0, 0.00, 1, 0, 1), (1, 0.00, 0, 0.00, 1, 1.00, 1, 0, 1), (7, 0.70, 8, 0.60, 6, 0.90, 1, 0, 1),
    (3, 0.00, 2, 0.00, 0, 0.00, 1, 0, 1), (10, 0.00, 5, 0.00, 3, 1.00, 1, 0, 1), (2, 1.00, 5, 0.00, 4, 0.00, 1, 0, 1),
    (6, 0.00, 7, 0.00, 1, 0.00, 1, 0, 1), (4, 0.25, 1, 1.00, 2, 0.50, 1, 0, 1), (8, 0.00, 3, 0.00, 5, 0.00, 1, 0, 1),
    # asides of any kind, inside an article too
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0), (2, 1.00, 0, 0.00, 2, 1.00, 0, 1, 0), (9, 0.00, 1, 1.00, 11, 0.00, 0, 1, 0),
    (14, 0.10, 80, 0.00, 0, 0.00, 0, 1, 0), (30, 0.00, 60, 0.00, 25, 0.00, 0, 1, 0), (60, 0.00, 30, 0.00, 45, 0.00, 0, 1, 0),
    (22, 0.00, 90, 0.00, 80, 0.00, 1, 1, 0), (40, 0.05, 70, 0.00, 16, 0.30, 1, 1, 0), (3, 0.66, 88, 0.00, 12, 0.00, 1, 1, 0),
    (120, 0.00, 40, 0.00, 30, 0.00, 0, 1, 0), (5, 0.00, 3, 0.00, 8, 0.00, 1, 1, 0), (18, 0.40, 6, 0.00, 5, 1.00, 0, 1, 0),
    # plain layouts without such marks: long text blocks with few links, and short blocks between them
    (90, 0.00, 75, 0.00, 60, 0.00, 0, 0, 1), (55, 0.04, 10, 0.00, 80, 0.00, 0, 0, 1), (35, 0.10, 60, 0.05, 40, 0.00, 0, 0, 1),
    (24, 0.00, 48, 0.00, 36, 0.00, 0, 0, 1), (9, 0.00, 3, 1.00, 70, 0.00, 0, 0, 1), (7, 0.00, 65, 0.00, 58, 0.02, 0, 0, 1),
    (14, 0.00, 50, 0.00, 33, 0.00, 0, 0, 1), (40, 0.00, 2, 1.00, 4, 0.80, 0, 0, 1), (20, 0.00, 44, 0.00, 5, 1.00, 0, 0, 1),
    (3, 0.00, 30, 0.00, 42, 0.00, 0, 0, 1), (28, 0.20, 35, 0.00, 26, 0.10, 0, 0, 1), (110, 0.15, 9, 0.00, 12, 0.00, 0, 0, 1),
    (60, 0.00, 70, 0.00, 2, 1.00, 0, 0, 1), (48, 0.00, 55, 0.00, 3, 0.00, 0, 0, 1), (30, 0.10, 40, 0.00, 1, 1.00, 0, 0, 1),
    (100, 0.00, 5, 1.00, 2, 1.00, 0, 0, 1), (85, 0.00, 90, 0.00, 0, 0.00, 0, 0, 1), (22, 0.00, 64, 0.00, 1, 1.00, 0, 0, 1),
    # plain layouts: menus, link lists, captions, footers
    (2, 1.00, 2, 1.00, 80, 0.00, 0, 0, 0), (1, 1.00, 3, 1.00, 45, 0.00, 0, 0, 0), (4, 0.75, 2, 1.00, 120, 0.00, 0, 0, 0),
    (3, 1.00, 70, 0.00, 50, 0.00, 0, 0, 0), (12, 0.80, 1, 1.00, 66, 0.00, 0, 0, 0), (5, 1.00, 0, 0.00, 90, 0.05, 0, 0, 0),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0), (3, 1.00, 2, 1.00, 4, 1.00, 0, 0, 0), (6, 0.80, 5, 1.00, 7, 0.90, 0, 0, 0),
    (4, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0), (10, 0.60, 12, 0.50, 6, 0.70, 0, 0, 0), (25, 0.70, 20, 0.60, 30, 0.80, 0, 0, 0),
    (5, 0.00, 4, 0.00, 3, 0.00, 0, 0, 0), (8, 0.30, 6, 0.00, 0, 0.00, 0, 0, 0), (2, 0.00, 0, 0.00, 1, 1.00, 0, 0, 0),
    (7, 0.00, 3, 0.00, 6, 0.50, 0, 0, 0), (45, 0.65, 10, 0.50, 14, 0.40, 0, 0, 0), (4, 0.50, 60, 0.00, 3, 1.00, 0, 0, 0),
    (6, 0.00, 5, 1.00, 0, 0.00, 0, 0, 0), (9, 0.00, 8, 0.00, 2, 1.00, 0, 0, 0), (12, 0.50, 70, 0.00, 0, 0.00, 0, 0, 0),
)


@dataclass
class Node:
    """A leaf (answer) or a split: rows with ``x[feature] <= cut`` go left."""
    answer: bool
    feature: int = -1
    cut: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None


def grow(table=LABELLED, depth: int = 6, least: int = 1) -> Node:
    """A classification tree by Gini impurity; cuts lie half way between neighbouring values."""
    rows = np.asarray(table, dtype=float)

    def gini(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return 2 * p * (1 - p) * len(y)

    def build(part: np.ndarray, left_depth: int) -> Node:
        y = part[:, -1]
        leaf = Node(bool(y.mean() >= 0.5))
        if left_depth == 0 or len(set(y)) < 2:
            return leaf
        best = (gini(y) - 1e-9, None)
        for f in range(rows.shape[1] - 1):
            values = np.unique(part[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = part[:, f] <= cut
                if min(low.sum(), (~low).sum()) >= least and (score := gini(y[low]) + gini(y[~low])) < best[0]:
                    best = (score, (f, float(cut)))
        if best[1] is None:
            return leaf
        f, cut = best[1]
        low = part[:, f] <= cut
        return Node(leaf.answer, f, cut, build(part[low], left_depth - 1), build(part[~low], left_depth - 1))
    return build(rows, depth)


def answer(tree: Node, x: tuple) -> bool:
    while tree.feature >= 0:
        tree = tree.left if x[tree.feature] <= tree.cut else tree.right
    return tree.answer


@dataclass
class Block:
    text: str
    words: int
    links: float     # share of words inside links
    in_main: bool
    in_aside: bool
    form: int = 0    # number of the form around it, or 0


NO_STATE = (False, 0, False, 0)


@dataclass
class _Reader:
    """Collects text pieces into blocks while tags go by."""
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, bool, int, bool, int]] = field(default_factory=list)  # tag, main, aside (1: a layout name, 2: for sure), dropped, form
    forms: int = 0
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    anchors: int = 0

    @property
    def state(self) -> tuple[bool, int, bool, int]:
        return self.stack[-1][1:] if self.stack else NO_STATE

    def text(self, raw: str) -> None:
        if raw and not self.state[2]:
            self.pieces.append(raw)
            if self.anchors:
                self.linked.append(raw)

    def flush(self) -> None:
        if self.pieces:
            words = entities.unescape("".join(self.pieces)).split()
            if words:
                inside = len(entities.unescape(" ".join(self.linked)).split())
                main, aside, _, form = self.state
                self.blocks.append(Block(" ".join(words), len(words), min(1.0, inside / len(words)), main, aside > 0, form))
            self.pieces, self.linked = [], []

    def open(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.anchors += 1
        if tag in VOID:
            if tag == "br":
                self.text(" ")
            elif tag not in INLINE:
                self.flush()
            return
        block = tag not in INLINE
        if block:
            self.flush()
            ends = OPTIONAL_END.get(tag, {"p"} if tag in CLOSES_P else ())
            while self.stack and self.stack[-1][0] in ends:
                self.stack.pop()
        main, aside, dropped, form = self.state
        named_main, named_aside, hidden = _marks(attributes) if attributes.strip(" /") else (False, 0, False)
        own_aside = 2 if tag in ASIDE_TAGS and not (tag in ("header", "figcaption") and main) else named_aside and min(named_aside, 2)
        if tag in ("html", "body") and named_aside < 3:
            own_aside = 0
        if tag in MAIN_TAGS:
            own_aside = 2 if named_aside == 3 else 0
            main, aside = main or not own_aside, 0 if aside == 1 else aside
        main = main or named_main and not own_aside
        aside = max(aside, own_aside)
        if not block and (aside != self.state[1] or hidden):
            self.flush()
        if tag == "form":
            self.forms += 1
            form = self.forms
        if not attributes.rstrip().endswith("/"):
            self.stack.append((tag, main, aside, dropped or hidden or tag in DROPPED, form))

    def close(self, tag: str) -> None:
        if tag == "a":
            self.anchors = max(0, self.anchors - 1)
        if tag not in INLINE:
            self.flush()
            self.anchors = 0
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in INLINE and (any(s[0] not in INLINE for s in self.stack[i + 1:])):
                    return  # an inline end never closes a block
                if tag in INLINE and self.stack[i][1:] != (self.stack[i - 1][1:] if i else NO_STATE):
                    self.flush()
                del self.stack[i:]
                return


def _marks(attributes: str) -> tuple[bool, int, bool]:
    """Whether class, id and role name a main part; an aside (1: by a part of a name, 2: by a whole name or role, 3: as
    content foreign to any article); whether the element is hidden."""
    main, aside, hidden = False, 0, False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for one in value.split():
                parts = TOKEN.findall(one)
                parts = parts[:next((i for i, x in enumerate(parts) if x in STATES), len(parts))]
                if FOREIGN_WORDS.intersection(parts):
                    aside = 3
                elif ASIDE_WORDS.intersection(parts):
                    aside = max(aside, 2 if len(parts) == 1 else 1)
                main = main or not MAIN_WORDS.isdisjoint(parts)
        elif name == "role":
            aside, main = max(aside, 1 if value == "form" else 3 if value in ASIDE_ROLES else 0), main or value == "main"
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return main and not aside, aside, hidden


def blocks(page: str) -> list[Block]:
    out, at, skip_to = _Reader(), 0, 0
    for m in TAG.finditer(page):
        if m.start() < skip_to:
            continue
        out.text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if page.startswith("<![CDATA[", m.start()):
                out.text(page[m.start() + 9:m.end()].removesuffix("]]>"))
            continue
        if m[1] or m[4]:
            out.close(tag)
        elif tag in RAW and not (m[3] or m[6] or "").rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if tag not in DROPPED:
                out.text(page[at:end.start() if end else len(page)])
            at = skip_to = end.end() if end else len(page)
        else:
            out.open(tag, m[3] or m[6] or "")
    out.text(page[at:])
    out.flush()
    return _without_controls(out.blocks)


def _without_controls(found: list[Block]) -> list[Block]:
    """Short blocks of a form go as its controls do, unless long blocks hold most of its text: then the form only wraps the page."""
    long, words = Counter(), Counter()
    for b in found:
        words[b.form] += b.words
        long[b.form] += b.words * (b.words >= LONG_BLOCK)
    return [b for b in found if not b.form or b.words >= LONG_BLOCK or 2 * long[b.form] >= words[b.form]]


def main_blocks(page: str, tree: Node) -> list[str]:
    found = blocks(page)
    none = Block("", 0, 0.0, False, False)
    out = []
    for i, b in enumerate(found):
        before, after = found[i - 1] if i else none, found[i + 1] if i + 1 < len(found) else none
        if answer(tree, (b.words, b.links, before.words, before.links, after.words, after.links, b.in_main, b.in_aside)):
            out.append(b.text)
    return out


def extracted(pages: DataFrame, depth: int = 6) -> DataFrame:
    """page_id, url, text, n_chars and the numbers of blocks kept and found, one row for each page."""
    tree = grow(depth=depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = ["\n\n".join(main_blocks(h, tree)) if h else "" for h in part.column(2).to_pylist()]
                yield {"page_id": part.column(0), "url": part.column(1), "text": texts, "n_chars": [len(t) for t in texts]}
    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
