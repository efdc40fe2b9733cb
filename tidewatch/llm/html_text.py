"""Main text of web pages by scoring the containers of their paragraphs."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.S,
)
_WHO = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Never part of an article.
DROPPED = frozenset(
    "script style noscript template svg canvas iframe object embed head nav footer aside form button input select"
    " textarea option dialog menu title xmp noembed noframes audio video map".split()
)
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
CONTAINER = frozenset("article main section div body td blockquote ul ol dl table tbody tr figure".split())
#: Words in a class, id or role that mark menus, notices, adverts and comments.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar"
    " breadcrumb breadcrumbs header masthead footer sidebar aside related recommended cookie cookies consent notice notices"
    " gdpr popup modal overlay alert newsletter subscribe subscription signup login share sharing social comment comments"
    " disqus respond reply replies discussion pagination pager toolbar search widget copyright complementary contentinfo form".split()
)
#: Of these, what is never the article however much of a page it is.
_OTHERS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond"
    " reply replies discussion cookie cookies consent gdpr newsletter".split()
)
#: What follows one of these in a name is said about the layout: with-sidebar, has-comments.
_LAYOUT = frozenset("has with no not without is show hide".split())
#: Words in a class or id that say an element holds the article.
_CONTENT = frozenset("content main article post entry page body story text".split())
#: How far classes are believed: any unwanted word, only names that say nothing else, not at all.
_ANY, _WHOLE, _NONE = range(3)
#: Below this share of the page's text the classes are believed less.
_SMALL = 0.1
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_FENCE = frozenset("ul ol dl table article section main body div".split())


class Node:
    __slots__ = ("name", "parent", "children", "doubt", "sure", "bad", "never", "points", "free", "chars", "links")

    def __init__(self, name: str, parent: Node | None, attrs: str = ""):
        self.name, self.parent = name, parent
        self.children: list[Node | str] = []
        #: What its names say: unwanted at all, and never the article (both by any word and by whole names).
        self.doubt, self.sure = _unwanted(name, attrs)
        self.never = parent is not None and (parent.never or _never(name, attrs))
        self.bad = False
        self.points = 0.0
        #: Characters below outside links and outside what is never part of an article; of the wanted text: all, in links.
        self.free = self.chars = self.links = 0


def _never(name: str, attrs: str) -> bool:
    """Whether an element is no part of an article, whatever its class says."""
    return name in DROPPED or (name not in ("html", "body") and bool(attrs) and bool(_HIDDEN.search(attrs)))


def _unwanted(name: str, attrs: str) -> tuple[int, bool]:
    """(how far classes must be believed to leave the element out, whether its size cannot save it).

    A name whose last word is unwanted and not its only one says what it is
    (page-header, article-comments, content-ad). Elsewhere an unwanted word
    counts unless a word for content stands beside it (content-sidebar-wrap).
    The first number is 2 if only all unwanted words count, 3 if names without
    any other word do too, 0 if nothing is unwanted.
    """
    if not attrs or name in ("html", "body", "article", "main"):
        return 0, False
    words = []
    for m in _WHO.finditer(attrs):
        for one in (m[1] or m[2] or m[3] or "").split():
            own = [w.lower() for w in _WORDS.findall(one)]
            words.append(own[: next((i for i, w in enumerate(own) if w in _LAYOUT), len(own))])
    every = {w for own in words for w in own}
    if not every & UNWANTED:
        return 0, False
    compound = {own[-1] for own in words if len(own) > 1 and own[-1] in UNWANTED}
    if not compound and every & _CONTENT:
        return 0, False
    whole = any(own and set(own) <= UNWANTED for own in words) or bool(compound & _OTHERS)
    return 3 if whole else 2, bool((compound or every) & _OTHERS)


class _Open:
    """The open elements of a page: every element is opened and closed once, and whether a name is open is looked up."""

    def __init__(self, root: Node):
        self.stack, self.counts, self.inline = [root], {}, [{}]

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.counts[node.name] = self.counts.get(node.name, 0) + 1
        if node.name in BLOCK:
            self.inline.append({})
        else:
            self.inline[-1][node.name] = self.inline[-1].get(node.name, 0) + 1

    def pop(self) -> Node:
        node = self.stack.pop()
        self.counts[node.name] -= 1
        if node.name in BLOCK:
            self.inline.pop()
        else:
            self.inline[-1][node.name] -= 1
        return node

    def close(self, name: str) -> None:
        """Close the innermost element of the name; an inline end tag does not reach over the block around it."""
        if (self.counts if name in BLOCK else self.inline[-1]).get(name, 0):
            while self.pop().name != name:
                pass

    def close_paragraph(self) -> None:
        """A block ends the paragraph around it."""
        inline = sum(self.inline[-1].values()) if self.counts.get("p") else 0
        if self.counts.get("p") and self.stack[-1 - inline].name == "p":
            self.close("p")

    def close_others(self, ends: frozenset[str]) -> None:
        """An item ends the items before it in its list or table."""
        if not any(self.counts.get(e) for e in ends):
            return
        last = None
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].name in _FENCE:
                break
            if self.stack[at].name in ends:
                last = at
        if last is not None:
            while len(self.stack) > last:
                self.pop()


def parse(page: str) -> Node:
    """A tree of the page: elements with their children in order, texts as strings; time grows with the page's length."""
    root = Node("#root", None)
    opened = _Open(root)
    place, size = 0, len(page)
    while place < size:
        tag = _TAG.search(page, place)
        if tag is None:
            opened.stack[-1].children.append(page[place:])
            break
        if tag.start() > place:
            opened.stack[-1].children.append(page[place : tag.start()])
        place = tag.end()
        name = tag["name"]
        if name is None:
            if tag[0].startswith("<![CDATA["):
                opened.stack[-1].children.append(tag[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if tag["close"]:
            opened.close(name)
            continue
        attrs = tag["attrs"] or ""
        if name in BLOCK:
            opened.close_paragraph()
        if ends := _CLOSED_BY.get(name):
            opened.close_others(ends)
        node = Node(name, opened.stack[-1], attrs)
        opened.stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, place)
            place = end.end() if end else size
        elif name not in VOID and not attrs.endswith("/"):
            opened.push(node)
    return root


def _nodes(root: Node) -> list[Node]:
    """All elements, parents first."""
    order, stack = [], [root]
    while stack:
        here = stack.pop()
        order.append(here)
        stack.extend(c for c in here.children if isinstance(c, Node))
    return order


def _free(order: list[Node]) -> int:
    """Count the characters that may belong to an article, whatever the classes say; those of the page."""
    for here in reversed(order):
        if not here.never and here.name != "a":
            here.free = sum(len(c.strip()) if isinstance(c, str) else c.free for c in here.children)
    return order[0].free


def _judge(order: list[Node], believed: int, whole: int) -> None:
    """Say which elements are left out. One that holds over half of the page's text is no sidebar, whatever its name is."""
    for here in order:
        here.points = 0.0
        named = here.doubt >= (2 if believed == _ANY else 3) and believed != _NONE and (here.sure or 2 * here.free <= whole)
        here.bad = here.never or named or (here.parent is not None and here.parent.bad)


def _measure(order: list[Node]) -> None:
    """Sizes of the wanted text below every element, and points for paragraphs and what is around them, bottom-up once."""
    commas_of: dict[int, int] = {}
    for here in reversed(order):
        if here.bad:
            continue
        chars = links = commas = own = 0
        for child in here.children:
            if isinstance(child, str):
                text = child.strip()
                chars += len(text)
                own += len(text)
                commas += text.count(",") + text.count("、") + text.count("，")
            elif not child.bad:
                chars, links, commas = chars + child.chars, links + child.links, commas + commas_of.pop(id(child))
                if child.name not in BLOCK:
                    own += child.chars
        here.chars, here.links = chars, chars if here.name == "a" else links
        commas_of[id(here)] = commas
        if chars and (here.name in PARAGRAPH or (here.name in CONTAINER and own >= 25)):
            points = (1 + commas + min(chars / 100, 3)) * (1 - links / chars)
            if here.name not in PARAGRAPH:
                here.points += points
            above, share = here.parent, 1.0
            for level in range(1, 5):
                if above is None:
                    break
                above.points += points * share
                share = 1 / (2 if level == 1 else 3 * level)
                above = above.parent


def blocks_of(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below the nodes in page order, white space collapsed, empty ones left out."""
    found: list[str] = []
    open_text: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(open_text))).strip()
        open_text.clear()
        if text:
            found.append(text)

    for top in nodes:
        stack: list[Node | str | None] = [top]
        while stack:
            here = stack.pop()
            if here is None:
                close()
            elif isinstance(here, str):
                open_text.append(here)
            elif not here.bad:
                if here.name in BLOCK or here.name == "#root":
                    close()
                    stack.append(None)
                elif here.name == "br":
                    open_text.append(" ")
                stack.extend(reversed(here.children))
        close()
    return found


def main_text(page: str | None) -> str:
    """The article of a page: blocks joined by an empty line; empty where there is none.

    If classes leave little of the page's text, only names made of unwanted
    words alone are believed, and if they leave nothing, none is.
    """
    if not page:
        return ""
    order = _nodes(parse(page))
    whole = _free(order)
    text = _best_text(order, _ANY, whole)
    if len(text) < _SMALL * whole:
        text = max(text, _best_text(order, _WHOLE, whole), key=len)
    return text or (_best_text(order, _NONE, whole) if whole else "")


def _best_text(order: list[Node], believed: int, whole: int) -> str:
    _judge(order, believed, whole)
    _measure(order)
    best, most = None, 0.0
    for here in order:
        if here.points > 0 and not here.bad:
            points = here.points * (1 - here.links / max(here.chars, 1))
            if points > most:
                best, most = here, points
    if best is None:
        return "\n\n".join(blocks_of([order[0]]))
    # The page itself says where the article is.
    up = best
    while up is not None:
        if up.name in ("article", "main"):
            best = up
            break
        up = up.parent
    kept = [best]
    if best.parent is not None and best.name not in ("article", "main"):
        kept = []
        for sibling in best.parent.children:
            if sibling is best:
                kept.append(best)
            elif isinstance(sibling, Node) and not sibling.bad:
                chars, links = sibling.chars, sibling.links
                dense = links / max(chars, 1)
                if sibling.points * (1 - dense) >= max(3.0, most * 0.2) or (sibling.name in PARAGRAPH and chars and dense < 0.25):
                    kept.append(sibling)
    elif best.name == "article" and best.parent is not None:
        kept = [c for c in best.parent.children if isinstance(c, Node) and not c.bad and c.name == "article"]
    return "\n\n".join(blocks_of(kept))


def extract_text(pages: DataFrame, column: str = "html") -> Column:
    """The main text of every page; null counts as empty, and a page without text gives an empty one.

    Repeated pages give their text again, an empty table no rows. Time and
    memory of a task grow with the length of its longest page.
    """
    prepare(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    return extract(F.col(column))
