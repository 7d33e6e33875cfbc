"""Operator 2: main-text extraction from raw pages by tree scoring.

A page is read into a light tree.  Markup that is never article text
(scripts, styles, navigation, headers and footers of the page, sidebars,
forms, adverts, notices, reader comments) is left out by element, role and
class or id.  A form, or a name of which only one word says furniture
("share-price"), is left out only where the points agree: it stays if it
holds most of the page's and no article lies outside.  Every paragraph passes points for its length and
commas to its ancestors, all of it to the parent and half as much with every
step up; a container's points are discounted by the share of its text that
lies in links.  The best container is widened to the ``article`` or ``main``
element around it if there is one; otherwise those of its siblings that score
well or read like paragraphs are kept with it.  All blocks of what is kept
come out in page order; nothing else is dropped or capped.

Rows are independent: one pass over the table, no shuffle, one page in memory
at a time.  The time for a page grows with its length, however its tags are
nested, unclosed or quoted: a tag ends at the first ``>`` outside a quoted
attribute value, sizes and points are summed once from the leaves up, and what
an open element needs to know of those around it is carried on the way down.

Defined cases: null, empty or text-free html gives an empty text; unclosed or
stray tags are repaired (a block ends an open paragraph; an unclosed frame or
drawing is left out alone, an unclosed script or style with all that follows); a page without any
paragraph keeps its body's blocks; repeated rows are kept; other input
columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetzone.llm.common import columns

# HTML element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noembed noframes object canvas".split())
DROPPED = RAW | set("head nav footer aside form button select option input menu dialog audio video map".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody td tfoot th thead tr ul caption""".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
#: An open element ended by the start of one of these siblings, inside the nearest of the limits.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Whole words of class, id and role that mark page furniture.
FURNITURE = set("""ad ads adv advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs byline-share
comment comments commentlist consent cookie cookies copyright disqus footer gdpr legal masthead menu modal nav navbar
navigation newsletter notice notices outbrain pager pagination paywall popup promo promoted promotion recommended related
respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola tags toc toolbar tooltip
topbar widget widgets alert warning-banner replies reply reader-comments infobar""".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar alertdialog".split())
HEADER_WORDS = {"site", "page", "top", "global", "main", "masthead"}
#: A name with one of these words describes a layout, not furniture ("no-sidebar").
LAYOUT_WORDS = {"no", "has", "with", "without"}
#: Names of reader comments, but of a section where they stand inside an article.
DISCUSSION = {"discussion", "discussions"}
#: Elements whose unclosed start leaves out the rest of the page.
_TO_THE_END = {"script", "style", "xmp"}
#: Share of the page's points above which a form or a one-word name is no furniture.
MOST = 0.5
_COMMENTS = {"comment", "comments", "commentlist", "reply", "replies", "respond"}
_PROTECTED = {"html", "body", "main", "article"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SKIP = re.compile(r"[\s/]*")
_KEY = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    """An element; ``items`` holds child nodes and text in page order.

    ``block`` is the nearest block element around it (or itself), ``open``
    that block's count of open inline elements by tag, ``near`` the nearest
    element that ends or limits each kind of ``SIBLINGS``, ``article`` whether
    it lies in an article; ``size``, ``linked``, ``commas``, ``points`` and
    ``score`` are summed by :func:`_sum_up`.
    """
    __slots__ = ("tag", "attrs", "parent", "items", "drop", "block", "open", "near", "article", "safe",
                 "size", "linked", "commas", "points", "score", "scored")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items, self.drop, self.safe = [], "", False
        own = tag in BLOCKS or parent is None
        self.block = self if own else parent.block
        self.open = {} if own else None
        self.near = parent.near if parent else {}
        if tag in _LIMITS:
            self.near = self.near | {kind: self for kind in _LIMITS[tag]}
        self.article = tag in ("article", "main") or bool(parent and parent.article)


#: Kinds of ``SIBLINGS`` that an element ends or limits.
_LIMITS: dict[str, list[str]] = {}
for _kind, (_ends, _bounds) in SIBLINGS.items():
    for _tag in _ends | _bounds:
        _LIMITS.setdefault(_tag, []).append(_kind)


_COMMENT_ENDS = ("-->", "--!>")


class _Tags:
    """The tags of a page: (start, end, closing, name, attributes) one after the other."""

    def __init__(self, page: str):
        self.page = page
        # Behind these nothing is ever closed.
        self.last = {q: page.rfind(q) for q in ('"', "'", *_COMMENT_ENDS)}

    def next(self, at: int):
        """The next tag or comment from ``at`` on; name empty for what is no element; None at the end."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0:
                return None
            if page.startswith("<!--", start):
                ends = [page.find(c, start + 4) + len(c) for c in _COMMENT_ENDS if self.last[c] >= start + 4]
                return start, min(ends, default=len(page)), False, "", {}
            closing = page.startswith("/", start + 1)
            name = _NAME.match(page, start + 1 + closing)
            if name:
                end, attrs = self._attributes(name.end())
                if end < 0:
                    return None                              # no tag ends any more
                return start, end, closing, name[0].lower(), attrs
            if page[start + 1:start + 2] in ("!", "?", "/"):
                end = page.find(">", start)
                return None if end < 0 else (start, end + 1, False, "", {})
            at = start + 1

    def _attributes(self, at: int) -> tuple[int, dict]:
        """End of the tag (-1 if there is none) and its attributes."""
        page, out = self.page, {}
        while True:
            at = _SKIP.match(page, at).end()
            if at >= len(page):
                return -1, out
            if page[at] == ">":
                return at + 1, out
            key = _KEY.match(page, at)
            at = key.end()
            value, equals = "", _EQUALS.match(page, at)
            if equals:
                at = equals.end()
                quote = page[at:at + 1]
                if quote and quote in "\"'" and self.last[quote] > at:
                    stop = page.find(quote, at + 1)
                    value, at = page[at + 1:stop], stop + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0], bare.end()
            out.setdefault(key[0].lower(), html_lib.unescape(value))


def parse(page: str) -> Node:
    """The page's tree, with furniture marked ``drop``."""
    root = node = Node("html", {}, None)
    tags, at, n = _Tags(page), 0, len(page)
    opened: dict[str, int] = {}             # open elements by tag
    unclosed: set[str] = set()              # raw elements that are closed nowhere in the rest of the page
    seen_body = False

    def leave(to: Node) -> Node:
        x = node
        while x is not to:
            opened[x.tag] -= 1
            if x.open is None:
                x.block.open[x.tag] -= 1
            x = x.parent
        return to

    while at < n:
        found = tags.next(at)
        if not found:
            node.items.append(page[at:])
            break
        start, end, closing, tag, attrs = found
        if start > at:
            node.items.append(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            # An end tag of an inline element never closes past the block around it.
            if (opened if tag in BLOCKS else node.block.open).get(tag):
                x = node
                while x.tag != tag:
                    x = x.parent
                node = leave(x.parent)
            continue
        if tag == "html" or tag == "body" and seen_body:
            continue
        seen_body |= tag == "body"
        if tag in CLOSES_P and node.block.tag == "p":
            node = leave(node.block.parent)
        if tag in HEADINGS and node.tag in HEADINGS:
            node = leave(node.parent)
        limit = node.near.get(tag)
        if limit is not None and limit.tag in SIBLINGS[tag][0] and limit.parent is not None:
            node = leave(limit.parent)
        child = Node(tag, attrs, node)
        child.drop = _furniture(child)
        if tag in ("article", "main", "h1") and not child.drop:
            # A wrapper that holds the article is no furniture, whatever its layout class says.
            x = node
            while x is not None and not x.safe:
                x.safe, x.drop = True, "" if x.drop in ("names", "weak") else x.drop
                x = x.parent
        node.items.append(child)
        if tag in VOID or page.endswith("/>", start, end) and tag in RAW:
            continue
        if tag in RAW:
            close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if close:
                at = close.end()
            else:
                unclosed.add(tag)
                at = n if tag in _TO_THE_END else at
            continue
        if tag == "plaintext":
            break
        node = child
        opened[tag] = opened.get(tag, 0) + 1
        if child.open is None:
            child.block.open[tag] = child.block.open.get(tag, 0) + 1
    return root


def _furniture(x: Node) -> str:
    """Why an element is page furniture: its element, role or visibility ("kind"), its names, or only
    a form or one word of a name ("weak"); else empty."""
    if x.tag == "form":
        return "weak"
    if x.tag in DROPPED:
        return "kind"
    a = x.attrs
    inside = bool(x.parent and x.parent.article)
    if x.tag == "header":
        return "" if inside else "kind"
    if not a:
        return ""
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return "kind"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
        return "kind"
    return _named_furniture(x, inside)


def _named_furniture(x: Node, inside: bool) -> str:
    """Whether the class or id marks page furniture: as a whole ("names") or by its first or last word ("weak")."""
    names = f"{x.attrs.get('class', '')} {x.attrs.get('id', '')}".lower().split()
    if x.tag in _PROTECTED:
        return "names" if x.tag == "article" and any(w in ("comment", "comments", "reply", "ad", "advert") for w in names) else ""
    found = ""
    for name in names:
        words = _WORD.findall(name)
        if not words or LAYOUT_WORDS & set(words):
            continue
        if name in FURNITURE or {words[0], words[-1]} & _COMMENTS or not inside and set(words) & DISCUSSION:
            return "names"
        if words[-1] == "header" and not inside and (len(words) == 1 or words[0] in HEADER_WORDS):
            return "names"
        if words[0] in FURNITURE or words[-1] in FURNITURE:
            found = "weak"
    return found


_PARAGRAPHS = {"p", "pre", "blockquote"}


def _holds_text(x: Node) -> bool:
    return x.tag in ("div", "section", "article", "td") and any(isinstance(c, str) and c.strip() for c in x.items)


def _own_points(x: Node) -> float:
    """Points of a paragraph (or a container with text of its own) for its length and commas, less its links."""
    if not x.size or x.tag not in _PARAGRAPHS and not _holds_text(x):
        return 0.0
    return (1 + x.commas + min(x.size / 100, 30)) * (1 - min(1.0, x.linked / x.size))


def _sum_up(root: Node, dropped: set) -> list[Node]:
    """All elements but the ``dropped`` ones in page order, their sizes and points summed from the leaves up."""
    order, stack = [], [(root, False)]
    while stack:
        x, link = stack.pop()
        link = link or x.tag == "a"
        x.size = x.linked = x.commas = 0
        x.points = x.score = 0.0
        x.scored = False
        order.append(x)
        for c in reversed(x.items):
            if isinstance(c, str):
                size = len(" ".join(c.split()))
                x.size += size
                x.linked += size if link else 0
                x.commas += c.count(",") + c.count("，")
            elif c.drop not in dropped:
                stack.append((c, link))
    for x in reversed(order):
        own = _own_points(x)
        if own:
            holder = x if x.tag not in _PARAGRAPHS else x.parent
            holder.score += own
            holder.scored = True
        x.points += own
        up = x.parent
        if up is not None:
            up.size, up.linked, up.commas = up.size + x.size, up.linked + x.linked, up.commas + x.commas
            up.points += x.points
    for x in reversed(order):
        if x.parent is not None and x.scored:
            x.parent.score += x.score / 2
            x.parent.scored = True
    return order


def _links(x: Node) -> float:
    return min(1.0, x.linked / max(x.size, 1))


def blocks(nodes: list[Node]) -> list[str]:
    """The blocks' texts in page order: white space as one space, empty ones left out."""
    out, open_text = [], []

    def flush():
        line = " ".join(html_lib.unescape("".join(open_text)).split())
        open_text.clear()
        if line:
            out.append(line)

    for top in nodes:
        flush()
        stack = [(iter(top.items), True)]
        while stack:
            items, block = stack[-1]
            for x in items:
                if isinstance(x, str):
                    open_text.append(x)
                elif x.drop:
                    if x.tag in BLOCKS:
                        flush()
                elif x.tag == "br":
                    open_text.append("\n")
                else:
                    inner = x.tag in BLOCKS
                    if inner:
                        flush()
                    stack.append((iter(x.items), inner))
                    break
            else:
                stack.pop()
                if block:
                    flush()
    flush()
    return out


def main_nodes(root: Node) -> list[Node]:
    """The best container with the siblings that belong to it."""
    elements = _sum_up(root, {"kind", "names"})
    marked = any(x.tag in ("article", "main") and x.points for x in elements)
    for x in elements:
        if x.drop == "weak" and x.points > MOST * root.points and (x.article or not marked):
            x.drop = ""
    elements = _sum_up(root, {"kind", "names", "weak"})
    scored = [x for x in elements if x.scored and x.tag != "html"]
    body = next((x for x in elements if x.tag == "body"), root)
    if not scored:
        return [next((x for x in elements if x.tag in ("article", "main")), body)]
    best = max(scored, key=lambda x: x.score * (1 - _links(x)))
    around = best
    while around is not None:
        if around.tag in ("article", "main"):
            best = around
        around = around.parent
    if best.tag in ("article", "main", "body") or best.parent is None:
        return [best]
    floor = best.score * 0.2
    kept = []
    for x in best.parent.items:
        if isinstance(x, str) or x.drop:
            continue
        if x is best or x.score >= floor:
            kept.append(x)
        elif x.tag in HEADINGS | _PARAGRAPHS and _links(x) < 0.25:
            if x.tag in HEADINGS or x.size > 80 or any(
                    re.search(r"[.!?]\s|[.!?]$", line) for line in blocks([x])):
                kept.append(x)
    return kept


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    nodes = main_nodes(parse(page))
    return "\n".join(line for x in nodes for line in blocks([x]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts = [extract(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row of ``pages`` (page_id, url, html)."""
    return columns(pages, page_id="long", url="string", html="string").mapInArrow(
        _rows, "page_id long, url string, text string, n_chars long")
