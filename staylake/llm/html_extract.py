"""Main text of web pages by wrapper induction.

Each page is parsed once into a tree of block elements and its text blocks.
Runs of siblings of the same shape fold into one node, so that pages of a host
have few distinct shapes.  Per host the most frequent shape is the reference;
every other shape is aligned with it by simple tree matching, which names its
nodes by the reference's nodes.  A slot whose text is constant over a host's
pages is template and goes; varying slots are content.  Elements that their
tag, class or role marks as menus, adverts and the like are never content.
An article or main element is a hint: it decides where a host has too few
different pages, and its h1 is never template.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import emit, ship, stored

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>"
    r"|<[!?/][^>]*>", re.S)
UNENDED = re.compile(r"<[a-zA-Z!?/]")
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
RAW_TEXT = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW_TEXT}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    # formulas are part of their sentence
    "maction", "math", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo",
    "mover", "mpadded", "mphantom", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub",
    "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "semantics"}
# Source forms of a formula, beside the formula itself.
ANNOTATIONS = {"annotation", "annotation-xml"}
QUOTING = {"code", "kbd", "samp"}  # a class in here names a kind of token, not of content
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
# An opening tag closes these open elements, up to the nearest one that holds them.
CLOSED_BY = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"})}
NEVER_IN_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
    "pre", "section", "table", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SKIPPED_TAGS = {
    "head", "nav", "footer", "aside", "button", "select", "canvas", "object", "dialog", "audio",
    "video", *RAW_TEXT}
# A drawing ends at its end tag, or where one of these begins, as in browsers.
DRAWING = re.compile(r"<(/?)svg\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.I)
BREAKOUT = re.compile(
    r"<(?:/?(?:body|p|div|h[1-6]|ul|ol|dl|li|table|blockquote|pre|article|main|section)\b"
    r"|foreignobject\b)", re.I)
# Text in these speaks for a form that holds the page, not one to fill in.
PROSE_TAGS = HEADINGS | {"p", "li", "blockquote", "td", "dd", "pre", "figcaption"}
SKIPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "discussion", "disqus", "footer", "login", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "promotions", "recommended", "related", "replies",
    "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget"}
COMMENT_WORDS = {"comment", "comments", "commentlist", "reply", "replies"}
COMMENT_PARTS = {"aside", "div", "ol", "section", "ul"}  # their ids count inside main parts, too
# Parts marked by these words are never content, by the others unless they hold
# most of what varies on a host.
FIRM_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "disqus", "respond",
    "sponsor", "sponsored", *COMMENT_WORDS}
# Words that change nothing about the words they stand with, as in site-footer.
NEUTRAL_WORDS = {
    "area", "bar", "block", "bottom", "box", "container", "inner", "left", "link", "links", "list",
    "main", "outer", "page", "post", "posts", "right", "section", "site", "slot", "top", "unit",
    "wrap", "wrapper"}
HEADER_WORDS = {"header"}
MAIN_TAGS = {"article", "main"}
UNMARKED = (frozenset(), frozenset(), "", False)
MARKS = re.compile(r"[%(),/]")
OUTSIDE, CONTENT, TITLE, MARKED = 0, 1, 2, 3  # a block's place; titles of main parts always stay
MAX_DEPTH = 200  # deeper elements count as their ancestor there; no text is lost
KEPT_SCORES = 1_000_000  # scores held at a time for each level of two trees
MIN_PAGES = 3
SLOT_ROWS = 50_000  # named nodes that a task holds at a time, and those of one shape


class Node:
    __slots__ = ("tag", "label", "children", "skipped", "marked", "main", "depth", "parent", "form",
                 "prose")

    def __init__(self, tag, label, parent, skipped, main, marked=False):
        self.tag, self.label, self.parent = tag, label, parent
        self.children: list[Node] = []
        self.skipped, self.main = skipped, main
        self.depth = parent.depth + 1 if parent else 0
        self.form = parent.form if parent else 0  # number of the outermost form, from 1
        self.prose = tag in PROSE_TAGS or (parent.prose if parent else False)
        above = parent.marked if parent else None
        self.marked = above or (self if marked else None)  # the outermost marked element


def _marks(value: str, but: frozenset[str] = frozenset()) -> set[str]:
    """Words of a class, id or role that mark it.

    A name counts if all its words are marking or neutral, at least one marking:
    cookie-notice and site-footer do, content-sidebar-wrap does not.
    """
    out: set[str] = set()
    for name in value.split():
        words = set(re.findall(r"[a-z0-9]+", name))
        marking = words & (SKIPPED_WORDS | HEADER_WORDS) - but
        if marking and words <= marking | NEUTRAL_WORDS:
            out |= marking
    return out


@lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[frozenset[str], frozenset[str], str, bool]:
    """Marking words of class and role, and of the id; the first class; if hidden."""
    words: set[str] = set()
    ids: set[str] = set()
    first, hidden = "", False
    for name, a, b, c in ATTRIBUTE.findall(text):
        name, value = name.lower(), html.unescape(a or b or c).lower()
        if name in ("class", "role"):
            words |= _marks(value)
            if name == "class" and value.split():
                first = value.split()[0]
        elif name == "id":
            ids |= _marks(value, frozenset({"discussion"}))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
    return frozenset(words), frozenset(ids), first, hidden


def _skip(tag: str, words: frozenset[str], ids: frozenset[str], hidden: bool,
          in_main: bool) -> tuple[bool, bool]:
    """Whether an element is never content, and whether a word marks it.

    Inside article and main, and on headings, an id names a section, but for
    parts that it names comments.
    """
    if tag in ("html", "body"):
        return False, False
    if tag in MAIN_TAGS:
        return hidden or (in_main and bool(words & COMMENT_WORDS)), False
    if tag in SKIPPED_TAGS or hidden or (tag == "header" and not in_main):
        return True, False
    if not in_main and tag not in HEADINGS:
        words = words | ids
    elif in_main and tag in COMMENT_PARTS:
        words = words | (ids & COMMENT_WORDS)
    if in_main:
        words = words - HEADER_WORDS
    return bool(words & FIRM_WORDS), bool(words) or tag == "form"


def parse(page: str) -> tuple[Node, list[list]]:
    """The tree of block elements and the blocks (node, text, link characters).

    A form that holds the page, a main part or more prose than there is text
    beside that prose, is read as any container.
    """
    root, blocks = _parse(page, frozenset())
    prose: dict[int, int] = {}
    other: dict[int, int] = {}
    holders = set()
    for node, text, _ in blocks:
        if node.form and node.main:
            holders.add(node.form)
        kind = prose if node.form and node.prose else other
        kind[node.form] = kind.get(node.form, 0) + (
            len(text) if node.form or not node.marked else 0)
    holders |= {form for form, chars in prose.items()
                if chars > other.get(0, 0) + other.get(form, 0)}
    return _parse(page, frozenset(holders)) if holders else (root, blocks)


def _parse(page: str, open_forms: frozenset[int]) -> tuple[Node, list[list]]:
    root = node = Node("", "", None, False, False)
    blocks: list[list] = []
    pieces: list[str] = []
    links = linked = forms = quoting = 0
    skipped_inline: list[str] = []
    last_drawing = page.lower().rfind("</svg")

    def close_block():
        nonlocal links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append([node, text, links])
            pieces.clear()
        links = 0

    def add(text: str):
        nonlocal links
        if text and not node.skipped and not skipped_inline:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if linked:
                links += len(text.strip())

    at, size = 0, len(page)
    last_end = page.rfind(">") + 1  # no tag ends after this
    while at < last_end:
        found = TAG.search(page, at, last_end)
        if found is None:
            break
        add(page[at:found.start()])
        at = found.end()
        closing, tag, rest = found.groups()
        if tag is None:
            if found.group().startswith("<!--") and not found.group().endswith("-->"):
                at = size  # a comment that never ends
            continue
        tag = tag.lower()
        if tag in RAW_TEXT and not closing:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else size
            continue
        if tag == "svg":
            if not closing and not rest.rstrip().endswith("/"):
                at = _after_drawing(page, at, last_drawing)
            continue
        if tag in ANNOTATIONS:
            if closing and skipped_inline and skipped_inline[-1] == tag:
                skipped_inline.pop()
            elif not closing and not rest.rstrip().endswith("/"):
                skipped_inline.append(tag)
            continue
        if tag in INLINE:
            if tag in QUOTING:
                quoting = max(0, quoting + (-1 if closing else 1))
            if tag == "a":
                linked = 0 if closing else 1
            if skipped_inline:  # inside a hidden or advert span
                if closing and skipped_inline[-1] == tag:
                    skipped_inline.pop()
                elif not closing and skipped_inline[-1] == tag:
                    skipped_inline.append(tag)
            elif not closing and rest and tag != "a":
                words, _, _, hidden = _attributes(rest)
                if hidden or (words & SKIPPED_WORDS and not quoting and node.tag != "pre"):
                    skipped_inline.append(tag)
            continue
        if tag in ("br", "wbr", "img"):
            pieces.append(" ")
            continue
        close_block()
        linked = quoting = 0
        skipped_inline.clear()
        if tag in VOID:
            continue
        if closing:
            over = node
            while over.parent is not None and over.tag != tag:
                over = over.parent
            if over.parent is not None:
                node = over.parent
            continue
        if node.tag == "p" and tag in NEVER_IN_P:
            node = node.parent
        if tag in CLOSED_BY:
            closed, held_by = CLOSED_BY[tag]
            over, last = node, None
            while over.parent is not None and over.tag not in held_by:
                if over.tag in closed:
                    last = over
                over = over.parent
            if last is not None:
                node = last.parent
        words, ids, first, hidden = _attributes(rest) if rest else UNMARKED
        never, marked = _skip(tag, words, ids, hidden, node.main)
        forms += tag == "form"
        if tag == "form" and forms in open_forms:
            marked = bool(words)
        # a main part inside a header or an aside is the main part all the same
        child = Node(tag, _escaped(f"{tag}.{first}" if first else tag), node,
                     never or (node.skipped and tag != "main"), node.main or tag in MAIN_TAGS, marked)
        if tag == "form" and not child.form and forms not in open_forms:
            child.form = forms
        if not node.skipped and child.depth <= MAX_DEPTH:
            node.children.append(child)
        node = child
    unended = UNENDED.search(page, at)
    add(page[at:unended.start() if unended else size])
    close_block()
    return root, blocks


def _after_drawing(page: str, at: int, last: int) -> int:
    """Where the content goes on after a drawing that begins before ``at``."""
    end, depth = at, 1
    while depth:
        if end > last:
            end = -1
            break
        found = DRAWING.search(page, end)
        if found is None:
            end = -1
            break
        end = found.end()
        if found.group(1):
            depth -= 1
        elif not found.group(2).rstrip().endswith("/"):
            depth += 1
    if end < 0:
        return at  # never ends: its tags hold no text of their own
    out = BREAKOUT.search(page, at, end)
    if out and not out.group().lower().startswith("<foreign"):
        return out.start()
    return end


def _signature(root: Node) -> dict[int, str]:
    """Shape of every subtree, runs of equal siblings folded."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    shapes: dict[int, str] = {}
    for node in reversed(order):
        parts = []
        for child in node.children:
            s = shapes[id(child)]
            if not parts or parts[-1] != s:
                parts.append(s)
        shapes[id(node)] = f"{node.label}({','.join(parts)})"
    return shapes


def _escaped(label: str) -> str:
    """A label without the marks that shapes and paths are written with."""
    return MARKS.sub(lambda m: f"%{ord(m.group()):02x}", label)


def folded(root: Node) -> tuple[str, dict[int, int]]:
    """The page's shape and the number of each node in it, in preorder."""
    shapes = _signature(root)
    numbers: dict[int, int] = {}
    stack, n = [[root]], 0
    while stack:
        group = stack.pop()
        for node in group:
            numbers[id(node)] = n
        n += 1
        runs: list[list[Node]] = []
        for node in group:
            at, before = -1, None
            for child in node.children:
                if shapes[id(child)] != before:
                    at, before = at + 1, shapes[id(child)]
                    if at == len(runs):
                        runs.append([])
                runs[at].append(child)
        stack += reversed(runs)
    return shapes[id(root)], numbers


# --------------------------------------------------------- simple tree matching

class Shape:
    """A shape string as arrays: label, children and path of each node."""

    def __init__(self, text: str):
        self.labels: list[str] = []
        self.children: list[list[int]] = []
        self.paths: list[str] = []
        stack: list[int] = []
        for label, mark in re.findall(r"([^(),]*)([(),])", text):
            if mark == "(":
                n = len(self.labels)
                self.labels.append(label)
                self.children.append([])
                self.paths.append((self.paths[stack[-1]] + "/" if stack else "") + label)
                if stack:
                    self.children[stack[-1]].append(n)
                stack.append(n)
            elif mark == ")":
                stack.pop()


class Subtrees:
    """Numbers equal subtrees alike, so that each pair of them is scored once."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.children: list[tuple[int, ...]] = []
        self.labels: list[str] = []
        self.sizes: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}
        self.least = 0  # pairs of smaller trees are scored again, not kept

    def numbers(self, shape: Shape) -> list[int]:
        """The subtree number of every node of a shape."""
        out = [0] * len(shape.labels)
        for n in range(len(out) - 1, -1, -1):  # preorder: children come later
            below = tuple(out[c] for c in shape.children[n])
            key = (shape.labels[n], below)
            if key not in self.number:
                self.number[key] = len(self.labels)
                self.labels.append(shape.labels[n])
                self.children.append(below)
                self.sizes.append(1 + sum(self.sizes[c] for c in below))
            out[n] = self.number[key]
        return out

    def score(self, x: int, y: int) -> int:
        """Nodes that simple tree matching pairs in two subtrees."""
        if x == y:
            return self.sizes[x]
        if self.labels[x] != self.labels[y]:
            return 0
        if not self.children[x] or not self.children[y]:
            return 1
        known = self.scores.get((x, y))
        if known is not None:
            return known
        head, left, right, _ = self.differing(x, y)
        same = self.children[x][:head] + self.children[x][head + len(left):]
        got = 1 + sum(self.sizes[c] for c in same)
        if len(left) * len(right) > 200:
            got += int(self.rows(left, right, np.zeros(len(right) + 1, np.int64))[-1])
        elif left and right:
            row = [0] * (len(right) + 1)
            for c in left:
                before, row = row, [0]
                for n, d in enumerate(right):
                    row.append(max(row[n], before[n + 1], before[n] + self.score(c, d)))
            got += row[-1]
        if self.sizes[x] * self.sizes[y] >= self.least:
            self.scores[x, y] = got
        return got

    def differing(self, x: int, y: int):
        """Both nodes' children between the equal ones at their start and end.

        Equal subtrees score as much as any partner could give them, so equal
        first or last children may always be paired.
        """
        left, right = self.children[x], self.children[y]
        least, head, tail = min(len(left), len(right)), 0, 0
        while head < least and left[head] == right[head]:
            head += 1
        while tail < least - head and left[-1 - tail] == right[-1 - tail]:
            tail += 1
        return head, left[head:len(left) - tail], right[head:len(right) - tail], tail

    def rows(self, left, right, row, keep=None):
        """The last row of the table of best scores, from ``row`` on."""
        kinds = list(dict.fromkeys(right))
        place = {k: n for n, k in enumerate(kinds)}
        at = np.array([place[d] for d in right], dtype=np.int64)
        weights: dict[int, np.ndarray] = {}
        for n, c in enumerate(left):
            if keep is not None:
                keep(n, row)
            if c not in weights:
                weights[c] = np.array([self.score(c, d) for d in kinds], dtype=np.int64)
            best = np.maximum(row[1:], row[:-1] + weights[c][at]) if len(at) else row[1:]
            row = np.concatenate(([0], np.maximum.accumulate(best)))
        return row

    def pairs(self, x: int, y: int) -> list[tuple[int, int]]:
        """Positions of the children that a best matching of two nodes pairs.

        Every ``step``-th row is kept and the rows between are made again, so
        the table of n by m takes memory of m times the root of n.
        """
        head, left, right, tail = self.differing(x, y)
        n, m = len(self.children[x]), len(self.children[y])
        out = [(k, k) for k in range(head)] + [(n - k, m - k) for k in range(1, tail + 1)]
        if not left or not right:
            return out
        step, kept = math.isqrt(len(left)) + 1, {}

        def keep(k, row):
            if k % step == 0:
                kept[k] = row

        self.rows(left, right, np.zeros(len(right) + 1, np.int64), keep)
        j = len(right)
        for start in sorted(kept, reverse=True):
            part, grid = left[start:start + step], []
            grid.append(self.rows(part, right, kept[start], lambda _, row: grid.append(row)))
            i = len(part)
            while i and j:
                got = self.score(part[i - 1], right[j - 1])
                if got and grid[i][j] == grid[i - 1][j - 1] + got:
                    i, j = i - 1, j - 1
                    out.append((head + start + i, head + j))
                elif grid[i][j] == grid[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
        return out


def align(a: Shape, b: Shape) -> dict[int, int]:
    """Nodes of ``a`` to nodes of ``b`` by simple tree matching."""
    trees = Subtrees()
    left, right = trees.numbers(a), trees.numbers(b)
    trees.least = len(left) * len(right) // KEPT_SCORES
    matched: dict[int, int] = {}
    stack = [(0, 0)] if a.labels[0] == b.labels[0] else []
    while stack:
        i, j = stack.pop()
        matched[i] = j
        stack += [(a.children[i][x], b.children[j][y])
                  for x, y in trees.pairs(left[i], right[j])]
    return matched


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(rows):
        return pd.DataFrame(rows, columns=["host", "shape_id", "node", "slot"])

    for rows in batches:
        out = []
        for host, shape_id, shape, reference in rows[["host", "shape_id", "shape", "reference"]
                                                     ].itertuples(index=False):
            own = Shape(shape)
            names = align(own, Shape(reference))
            out += [(host, shape_id, n, f"={names[n]}" if n in names else path)
                    for n, path in enumerate(own.paths)]
            if len(out) >= SLOT_ROWS:
                yield frame(out)
                out = []
        yield frame(out)


# ------------------------------------------------------------------- on Spark

def page_blocks(page: str) -> tuple[str, list[tuple[int, int, int, str]]]:
    """A page's shape and its blocks (node, place, marked element or -1, text).

    Beside an article or main element that holds at least as much text as the
    rest without links, the rest is ``OUTSIDE``: content only if its slot varies.
    An article in a marked element counts as unmarked where nothing else is.
    """
    root, blocks = parse(page)
    shape, numbers = folded(root)
    plain = [b for b in blocks if not b[0].marked]
    if not plain:
        plain = [b for b in blocks if b[0].main]
    free = {id(b[0]) for b in plain}
    inside = sum(len(text) for node, text, _ in plain if node.main)
    rest = sum(len(text) - links for node, text, links in plain if not node.main)
    around = OUTSIDE if inside and inside >= rest else CONTENT

    def place(node: Node) -> int:
        if id(node) not in free:
            return MARKED
        if not node.main:
            return around
        return TITLE if node.tag == "h1" else CONTENT

    def number(node: Node) -> int:
        while id(node) not in numbers:
            node = node.parent
        return numbers[id(node)]

    return shape, [(number(n), place(n), -1 if id(n) in free else number(n.marked), text)
                   for n, text, _ in blocks]


def content_blocks(page: str) -> tuple[str, list[tuple[int, int, str]]]:
    """A page's shape and the blocks that are content without other pages."""
    shape, blocks = page_blocks(page)
    return shape, [(n, p, t) for n, p, _, t in blocks if p not in (OUTSIDE, MARKED)]


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, shape, blocks) of every page, one parse each."""
    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    block = pa.struct([("node", pa.int32()), ("place", pa.int32()), ("mark", pa.int32()),
                       ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, url, host, page in zip(*batch.columns):
                    shape, found = page_blocks(page.as_py())
                    yield (sum(len(t) for _, _, _, t in found) + len(shape),
                           (key.as_py(), url.as_py(), host.as_py(), shape,
                            [{"node": n, "place": p, "mark": m, "text": t} for n, p, m, t in found]))

        first = next(batches, None)
        if first is None:
            return
        batches = chain([first], batches)
        yield from emit(rows(), pa.schema([
            ("page_id", first.schema.field(0).type), ("url", pa.string()), ("host", pa.string()),
            ("shape", pa.string()), ("blocks", pa.list_(block))]))

    host = F.lower(F.regexp_extract("url", r"^[^:/?#]+://([^/?#]*)", 1))
    return pages.select(
        "page_id", F.col("url").cast("string").alias("url"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).mapInArrow(run, f"page_id {kind}, url string, host string, shape string, "
                      "blocks array<struct<node:int,place:int,mark:int,text:string>>")


def wrappers(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, shape_id, template, varying, overruled): node numbers by their slot.

    A slot is judged if at least ``min_pages`` different pages of the host have
    it: template if all have the same text, else varying.  Pages of equal content count once, and near copies share one
    count: a page counts 1 / n if half of its text, without the host's constant
    slots, stands on n pages or more.  A marked element is overruled if its varying slots
    hold more text than the host's unmarked ones.
    """
    filled = parsed.where(F.size("blocks") > 0).withColumn("shape_id", F.xxhash64("shape"))
    shapes = stored(filled.groupBy("host", "shape_id").agg(
        F.first("shape").alias("shape"), F.count(F.lit(1)).alias("pages")), "html-shapes")
    reference = stored(shapes.groupBy("host").agg(F.max_by(
        "shape", F.struct("pages", "shape_id")).alias("reference")), "html-references")
    pairs = shapes.join(reference, "host").select("host", "shape_id", "shape", "reference")
    aligned = stored(pairs.repartition("host", "shape_id")  # a host's shapes in many tasks
                     .mapInPandas(_aligned, "host string, shape_id long, node int, slot string"),
                     "html-slots")
    hashed = F.transform("blocks", lambda b: F.struct(
        b["node"].alias("node"), b["mark"].alias("mark"), F.xxhash64(b["text"]).alias("text"),
        F.length(b["text"]).alias("chars")))
    pages = (filled.select("host", "shape_id", hashed.alias("blocks"))
             .groupBy("host", F.xxhash64("blocks.text").alias("page"))
             .agg(F.min(F.struct("shape_id", "blocks")).alias("p")))
    each = (pages.select("host", "page", "p.shape_id", F.explode("p.blocks").alias("b"))
            .select("host", "page", "shape_id", "b.node", "b.mark", "b.text", "b.chars")
            .join(aligned, ["host", "shape_id", "node"]))
    texts = stored(each.groupBy("host", "page", "slot", "text").agg(
        F.sum("chars").alias("chars"),
        F.sum(F.when(F.col("mark") < 0, F.col("chars")).otherwise(0)).alias("plain")), "html-texts")
    spread = texts.groupBy("host", "slot").agg(
        (F.min("text") == F.max("text")).alias("constant"))
    holders = texts.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("holders"))
    # one row per text of a slot before the join: a constant slot is one row
    shared = holders.join(spread.where("not constant"), ["host", "slot"])
    weights = (texts.join(shared, ["host", "slot", "text"]).groupBy("host", "page")
               .agg((1 / F.percentile("holders", 0.5, F.col("chars"))).alias("weight")))
    evidence = (texts.select("host", "slot", "page").distinct().join(weights, ["host", "page"])
                .groupBy("host", "slot").agg(F.sum("weight").alias("pages")))
    slots = stored(spread.join(evidence, ["host", "slot"])
                   .where(F.col("pages") >= min_pages - 1e-6)
                   .select("host", "slot", "constant"), "html-judged")
    varying = slots.where("not constant")
    plain = (texts.groupBy("host", "slot").agg(F.sum("plain").alias("plain"))
             .join(varying, ["host", "slot"]).groupBy("host").agg(F.sum("plain").alias("plain")))
    overruled = (each.where(F.col("mark") >= 0).join(varying, ["host", "slot"])
                 .groupBy("host", "shape_id", F.col("mark").alias("node"))
                 .agg(F.sum("chars").alias("chars"))
                 .join(aligned, ["host", "shape_id", "node"])
                 .groupBy("host", "slot").agg(F.sum("chars").alias("chars"))
                 .join(plain, "host").where("chars > plain")
                 .select("host", "slot", F.lit(True).alias("overruled")))
    known = aligned.join(slots, ["host", "slot"], "left").join(overruled, ["host", "slot"], "left")

    def nodes(condition):
        return F.collect_set(F.when(condition, F.col("node")))

    return (known.where("constant is not null or overruled").groupBy("host", "shape_id").agg(
        nodes(F.col("constant")).alias("template"), nodes(~F.col("constant")).alias("varying"),
        nodes(F.col("overruled")).alias("overruled")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row.

    Blocks are joined by a line feed, white space inside a block is one
    space, character references are decoded.  Null or empty html, and pages
    without content, give an empty text.  Unclosed elements and tags are read
    as browsers do.  Null ids and urls and repeated rows keep their rows
    (pages without a host are one host); other columns are ignored.
    """
    parsed = stored(parsed_pages(pages), "html-parsed")
    template = stored(wrappers(parsed), "html-wrappers").select(
        F.col("host").alias("_host"), F.col("shape_id").alias("_shape"), "template", "varying", "overruled")
    joined = parsed.join(template, (F.col("host") == F.col("_host"))
                         & (F.xxhash64("shape") == F.col("_shape")), "left")
    def held(nodes, node):
        return F.array_contains(F.coalesce(nodes, F.array().cast("array<int>")), node)

    kept = F.filter("blocks", lambda b: (b["place"] == TITLE) | F.when(
        b["place"] == OUTSIDE, held("varying", b["node"])).otherwise(
        ~held("template", b["node"])
        & ((b["place"] != MARKED) | held("overruled", b["mark"]))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return (joined.select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
