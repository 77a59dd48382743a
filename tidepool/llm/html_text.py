"""Main text of HTML pages by tag-path ratios.

Every text node of a page belongs to a root-to-leaf tag path. Per path, the
mean text length and punctuation of its nodes are taken and smoothed over the
tree of paths: a path's share in another's value falls to a quarter with each step
between the two. The smoothed ratios are fused (their product, doubled inside an
``article`` or ``main``) and held against half of their mean over the page's
characters: the nodes of the paths above it are content. Menus, adverts and notices live on
paths of short, unpunctuated nodes and stay below.

Short nodes of an article (headings, list items, cells) belong to it as well:
the element that holds a content node (the next one above paragraphs, lists
and tables; the ``article`` or ``main`` around it if there is one) is taken
whole, but for blocks of links alone outside such an element. A heading goes
with the text that it leads. An element's name alone never makes a node
content. An advert that has no name and lies on the article's own path cannot
be told from it.

Names are features that take a path out: elements (``nav``, ``footer``,
``form``, ``script`` ...) and words of a class or id, each judged for its own
element: around the article (the heaviest ``article`` or ``main``), or around
most of the punctuated text, such a word names the page's layout and does not
count, while those below it still do. Reader comments never count as the
article, however much text they hold.

A page is one row and its work is one pass over its tags; nothing is
shuffled. Defined cases: null, empty or tagless-and-blank html gives ''; text
without any tag is one block; unclosed tags, comments and quotes end with the
page; ``br`` is white space inside its block; repeated rows are extracted each
for themselves; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are never part of the article.
BOILER = set("nav footer aside form head menu dialog button select option label fieldset object canvas audio video map datalist".split())
#: Words of a class, id or role that mark boilerplate.
HINTS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment comments "
    "disqus reply replies respond share sharing social related recommended widget widgets pagination pager toolbar login signup contentinfo complementary".split())
#: Of these, words of reader comments: they are never the article, however much they hold.
COMMENTS = set("comment comments disqus reply replies respond".split())
#: Words beside a hint that make it a layout's or a thing's name ("has-comments", "ad-free").
NEUTRAL = set("has no with without non free page layout wrapper container".split())
ROOTS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag of these ends an open element of the given kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
#: Elements that hold single texts or rows of them, and those around everything.
TEXTUAL = HEADINGS | set("address blockquote caption dd dl dt figcaption legend li ol p pre table tbody td tfoot th thead tr ul".split())
OUTER = {"#page", "html", "body"}
#: Share of a path's value that one step of the path tree passes on, weight of a
#: path inside ROOTS, and the share of the mean ratio that makes the threshold.
DECAY = 0.25
ROOT_WEIGHT = 2.0
THRESHOLD = 0.5

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?。、，！？]")


class Path:
    """A tag path as its last step and the path above; equal paths of a page are one object."""

    __slots__ = ("above", "number", "link", "root")

    def __init__(self, above: "Path | None", tag: str, number: int):
        self.above, self.number = above, number  # a path's number is above that of the path above it
        self.link = tag == "a" or bool(above and above.link)
        self.root = tag in ROOTS or bool(above and above.root)


class Element:
    __slots__ = ("tag", "above", "path", "boiler", "root", "heading", "hint", "outer", "talk")

    def __init__(self, tag: str, attrs: str, above: "Element | None", paths: dict[tuple, Path]):
        marks = sorted({p.lower() for m in MARKED.findall(attrs) for p in PIECES.findall(m)}) if attrs else []
        self.tag, self.above = tag, above
        step = (above.path.number if above else -1, tag, *marks)
        if step not in paths:
            paths[step] = Path(above.path if above else None, tag, len(paths))
        self.path = paths[step]
        self.root = self if tag in ROOTS else above.root if above else None
        self.heading = tag in HEADINGS or bool(above and above.heading)
        #: whether this element or one above it is boilerplate by its element
        self.boiler = bool(above and above.boiler) or tag in BOILER or (tag == "header" and self.root is None) or (
            tag in ROOTS and not {"comment", "comments"}.isdisjoint(marks))
        #: the nearest element from here up with a boilerplate word, and the next one above that
        self.outer = above.hint if above else None
        words = HINTS.intersection(marks)
        if "free" in marks or tag in HEADINGS:
            words = set()
        #: reader comments, unless the word is part of a layout's name
        self.talk = not COMMENTS.isdisjoint(words) and NEUTRAL.isdisjoint(marks)
        hinted = tag not in ("html", "body") and tag not in ROOTS and bool(words)
        self.hint: Element | None = self if hinted else self.outer


class Leaf:
    __slots__ = ("text", "element", "block")

    def __init__(self, text: str, element: Element, block: int):
        self.text, self.element, self.block = text, element, block


def leaves(page: str) -> list[Leaf]:
    """Text nodes in page order with their elements; nodes of one block share
    its number (white space between them is kept in the text)."""
    paths: dict[tuple, Path] = {}
    stack = [Element("#page", "", None, paths)]
    held: dict[str, int] = {}  # open elements by tag: an end tag without one ends nothing
    out: list[Leaf] = []
    block, pos, n = 0, 0, len(page)

    def close(k: int) -> None:
        for e in stack[k:]:
            held[e.tag] -= 1
        del stack[k:]

    def add(raw: str) -> None:
        if raw:
            out.append(Leaf(html.unescape(raw), stack[-1], block))

    while pos < n:
        m = TAG.search(page, pos)
        if not m:
            add(page[pos:])
            break
        add(page[pos : m.start()])
        pos = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue  # a comment or declaration
        tag = tag.lower()
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            block += 1
        if closing:
            for k in range(len(stack) - 1, 0, -1) if held.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end tag does not reach out of its block
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS:  # ends an open paragraph, and list items and cells of its kind
            ends = CLOSES.get(tag, set()) | {"p"} | (HEADINGS if tag in HEADINGS else set())
            for k in range(len(stack) - 1, 0, -1) if any(map(held.get, ends)) else ():
                if stack[k].tag in ends:
                    close(k)
                elif stack[k].tag in SCOPES.get(tag, {"table"} if tag in ("tr", "td", "th") else ()) or (
                        stack[k].tag in BLOCKS and tag not in CLOSES):
                    break
        if not attrs.rstrip().endswith("/") or tag in BLOCKS:
            stack.append(Element(tag, attrs, stack[-1], paths))
            held[tag] = held.get(tag, 0) + 1
    return out


def ratios(nodes: list[Leaf]) -> list[float]:
    """Fused, smoothed tag-path ratio of each node.

    The value of a path is the mean over all paths with nodes, weighted with
    DECAY to the power of the steps between the two in the path tree. Two
    passes give all of them: sums from the leaves up, then what lies outside of
    a path's branch from the root down.
    """
    sums: dict[Path, list[float]] = {}
    for x in nodes:
        s = sums.setdefault(x.element.path, [0, 0, 0])
        s[0] += 1
        s[1] += len(x.text)
        s[2] += len(PUNCTUATION.findall(x.text))
    value = {p: (1.0, t / k, q / k) for p, (k, t, q) in sums.items()}
    for p in sums:
        q = p.above
        while q and q not in value:
            value[q] = (0.0, 0.0, 0.0)
            q = q.above
    order = sorted(value, key=lambda p: p.number)
    for p in reversed(order):
        if p.above:
            value[p.above] = tuple(u + DECAY * v for u, v in zip(value[p.above], value[p]))
    for p in order:
        if p.above:
            value[p] = tuple(v + DECAY * (u - DECAY * v) for u, v in zip(value[p.above], value[p]))
    fused = {p: (t / w) * (q / w + 0.1) * (ROOT_WEIGHT if p.root else 1.0) for p, (w, t, q) in value.items() if p in sums}
    return [fused[x.element.path] for x in nodes]


def above(e: Element | None) -> Iterator[Element]:
    """The elements with a boilerplate word from here up."""
    while e:
        yield e
        e = e.outer


def standing_hints(said: list[Leaf]) -> dict[Element, bool]:
    """For each element with a boilerplate word whether it, or one above it,
    is boilerplate. A word does not count on an element around the article,
    or around more than half of the punctuated text."""
    order: dict[Element, int] = {}  # outer ones first
    weight: dict[Element, int] = {}
    roots: dict[Element, list[int]] = {}
    free, total = [0, 0], 0
    for x in said:
        e, size = x.element, len(x.text)
        w = size if PUNCTUATION.search(x.text) else 0
        total += w
        new = []
        for h in above(e.hint):
            if h in order:
                break
            new.append(h)
        for h in reversed(new):
            order[h] = len(order)
        if e.hint:
            weight[e.hint] = weight.get(e.hint, 0) + w
        if e.root:
            # an article's weight is what stands in it under no word of its own
            if e.hint is None:
                free = [free[0] + w, free[1] + size]
            elif e.hint is e.root.hint:
                p, t = roots.get(e.root, (0, 0))
                roots[e.root] = [p + w, t + size]
    for h in reversed(order):
        if h.outer:
            weight[h.outer] = weight.get(h.outer, 0) + weight.get(h, 0)
    best = max(roots, key=roots.__getitem__, default=None)
    layout: set[Element] = set()
    if best and roots[best] > free:
        layout, free = set(above(best.hint)), roots[best]
    out: dict[Element, bool] = {}
    for h in order:
        heavy = weight.get(h, 0)  # a root without a punctuated text still stands against a lighter one
        most = 2 * heavy > total and (not free[0] and free[1] < heavy or (h.root is not None and h.root.tag == "article"))
        out[h] = bool(h.outer and out[h.outer]) or not (h in layout or most and not h.talk)
    return out


def holder(e: Element) -> Element:
    """The element that is taken whole if one of its texts is content."""
    if e.root:
        return e.root
    while e.above and (e.tag not in BLOCKS or e.tag in TEXTUAL):
        e = e.above
    return e


def content(nodes: list[Leaf]) -> list[Leaf]:
    """The nodes of the article."""
    said = [x for x in nodes if x.text.strip()]
    if not said:
        return []
    standing = standing_hints([x for x in said if not x.element.boiler])
    # (an element with a boilerplate word that holds blanks alone has no verdict)
    gone = lambda e: e.boiler or (e.hint is not None and standing.get(e.hint, True))
    free = [x for x in said if not gone(x.element)]
    if not free:
        return []
    score = ratios(free)
    sizes = [len(x.text) for x in free]
    limit = THRESHOLD * sum(v * k for v, k in zip(score, sizes)) / sum(sizes)
    chosen = [x for x, v in zip(free, score) if v >= limit]
    boxes = {box for x in chosen if (box := holder(x.element)).tag not in OUTER}
    inside: dict[Element, bool] = {}
    for x in free:
        chain, e = [], x.element
        while e and e not in inside and e not in boxes:
            chain.append(e)
            e = e.above
        inside.update(dict.fromkeys(chain, e is not None and (e in boxes or inside[e])))
    blocks = {x.block for x in chosen} | {
        x.block for x in free if (x.element in boxes or inside[x.element]) and (x.element.root or not x.element.path.link)}
    leads = False  # whether the text that follows, but for headings, is kept
    for x in reversed(free):
        if not x.element.heading:
            leads = x.block in blocks
        elif leads:
            blocks.add(x.block)
    # white space nodes stay, they separate the words of their block
    return [x for x in nodes if x.block in blocks and not gone(x.element)]


def main_text(page: str | None) -> str:
    """The article's blocks, one per line."""
    if not page:
        return ""
    blocks: dict[int, list[str]] = {}
    for x in content(leaves(page)):
        blocks.setdefault(x.block, []).append(x.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def with_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` plus the main text of each whole page."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype="object")

    return pages.withColumn(out, extract(F.col(html_col)))


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, main text and its code points."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return with_main_text(slim).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
