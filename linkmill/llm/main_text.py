"""Main text of web pages by tree scoring: paragraphs pass points to their ancestors, links discount them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import table

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_QUOTED_REST = re.compile(r"""([^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+)>""")
_PLAIN_REST = re.compile(r"([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?i)(?:^|[\s"'/])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|$)""")
_SPACE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text at all; it ends at their own end tag whatever stands between.
_RAW = frozenset("script style textarea xmp iframe noembed noframes title".split())
#: Elements that stay inside a line of text.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
#: Elements that hold no text of a page.
_SKIPPED = frozenset(
    "button select option datalist template noscript object svg math canvas audio video map dialog head".split()
)
#: Elements that mark what is no article, as the words below do. A mark isn't final: see _free_blocks.
_MARKED_TAGS = frozenset("nav footer aside form menu header".split())
#: Words in class or id, or roles, that mark what is no article: menus, sidebars, notices, adverts, comments.
_MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside"
    " menu nav navbar navigation breadcrumb breadcrumbs header footer foot masthead cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup social share sharing sharebar related recommended"
    " recommendations comment comments commentlist disqus reply replies respond responses toolbar pagination pager widget login"
    " complementary contentinfo search skip outbrain taboola".split()
)
#: Words of a class that say what a part lacks or an outer element has: has-sidebar, no-ads, ad-free mark nothing.
_DENIES, _DENIES_AFTER = frozenset("has no not non with without is".split()), frozenset(["free"])
#: Words beside which a marked word still marks an article, whose class may speak of what stands below it.
_PLACES = frozenset(
    "site main page top bottom left right primary secondary global area list section block box bar link links item items"
    " icon icons button buttons slot text body content wrapper container post posts thread".split()
)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Marks of what others say or what stands beside the article: these need more than half of a page to be its text.
_FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent"
    " gdpr related recommended recommendations comment comments disqus reply replies respond responses outbrain taboola"
    " nav footer menu".split()
)
#: Share of links from which a block beside the best container is a menu.
_LINKED = 0.5
#: Shares of a page's points that a mark must hold to be no mark.
_MOST, _NEARLY_ALL = 0.5, 0.8
_MARKED_ARTICLE = frozenset("ad ads advert advertisement sponsored comment comments reply promo related".split())
_ENDS_PARAGRAPH = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "p": "p"}
_SCOPE = frozenset("table ul ol dl article section main div body html td th li blockquote".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Points that a container starts with.
_START = {"article": 20.0, "main": 15.0, "section": 3.0, "div": 3.0, "td": 2.0, "blockquote": 2.0, "pre": 2.0}


class _Node:
    __slots__ = ("tag", "parent", "index", "chars", "links", "points", "skipped", "mark", "held", "marks")

    def __init__(self, tag: str, parent: _Node | None, index: int, skipped: bool, mark: str):
        self.tag, self.parent, self.index, self.skipped, self.mark = tag, parent, index, skipped, mark
        self.chars = self.links = self.marks = 0
        self.points, self.held = _START.get(tag, 0.0), 0.0


#: Text of one line: what it says, whether a link says it, and the innermost element around it.
_Part = tuple[str, bool, _Node]


def _is_hidden(tag: str, attributes: str) -> bool:
    if tag in _SKIPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _marking(token: str, strict: bool) -> list[str]:
    """The words by which a class, an id or a role marks; ``strict`` if it must say nothing else."""
    words = [w.lower() for w in _WORD.findall(token) if len(w) > 1]
    if strict:
        found = [w for w in words if w in _MARKED_ARTICLE]
        return found if all(w in _MARKED or w in _PLACES for w in words) else []
    denied = next((i for i, w in enumerate(words) if w in _DENIES), len(words))
    return [w for w, after in zip(words[:denied], [*words[1:], ""]) if w in _MARKED and after not in _DENIES_AFTER]


def _mark(tag: str, attributes: str, inside_article: bool) -> str:
    """The word or tag that marks an element as no article, or an empty text."""
    if tag in _MARKED_TAGS and not (tag == "header" and inside_article):
        return tag
    if not attributes or tag in ("html", "body"):
        return ""
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in value.strip("\"'").split():
                found = _marking(token, tag in ("article", "main"))
                if found:
                    return next((w for w in found if w in _FOREIGN), found[0])
    return ""


def _read(html: str) -> tuple[list[_Node], list[tuple[_Node, list[_Part]]]]:
    """The elements in page order, and the blocks of text outside skipped elements, marked ones included."""
    root = _Node("html", None, 0, False, "")
    nodes, stack, blocks = [root], [root], []
    open_tags: dict[str, int] = {}
    parts: list[_Part] = []
    plain, at, articles = False, 0, 0

    def block_node() -> _Node:
        for node in reversed(stack):
            if node.tag not in _INLINE:
                return node
        return root

    def code() -> bool:
        """Inside listings, where a comment is no reader's."""
        return open_tags.get("pre", 0) > 0 or open_tags.get("code", 0) > 0

    def flush() -> None:
        if parts:
            blocks.append((block_node(), parts.copy()))
            parts.clear()

    def close(upto: int) -> None:
        nonlocal articles
        while len(stack) > upto:
            node = stack.pop()
            open_tags[node.tag] -= 1
            articles -= node.tag in ("article", "main")

    def say(text: str) -> None:
        if text and not stack[-1].skipped:
            parts.append((unescape(text), open_tags.get("a", 0) > 0, stack[-1]))

    while True:
        found = _MARKUP.search(html, at)
        if not found:
            say(html[at:])
            break
        say(html[at : found.start()])
        tag = found[2]
        if tag is None:
            at = found.end()
            continue
        tag = tag.lower()
        rest = None if plain else _QUOTED_REST.match(html, found.end())
        if rest is None:
            # A quote that never closes: from here on a tag ends at the next sign.
            plain, rest = True, _PLAIN_REST.match(html, found.end())
            if rest is None:
                break
        at = rest.end()
        if found[1]:
            if tag == "br":
                parts.append((" ", False, stack[-1]))
            elif open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag and (tag not in _INLINE or stack[depth].tag in _INLINE):
                    depth -= 1
                if stack[depth].tag == tag:
                    if tag not in _INLINE:
                        flush()
                    close(depth)
            elif tag not in _INLINE:
                flush()
            continue
        if tag in _VOID:
            if tag in ("br", "wbr"):
                if tag == "br" and not stack[-1].skipped:
                    parts.append((" ", False, stack[-1]))
            elif tag == "hr":
                flush()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in ("html", "body"):
            continue
        if tag not in _INLINE:
            flush()
            if open_tags.get("p"):
                _close_within(stack, ("p",), close)
            ends = _ENDS_PARAGRAPH.get(tag)
            if ends and tag != "p":
                _close_within(stack, ends.split(), close)
        skipped = stack[-1].skipped or _is_hidden(tag, rest[1])
        node = _Node(tag, stack[-1], len(nodes), skipped, "" if skipped or code() else _mark(tag, rest[1], articles > 0))
        nodes.append(node)
        if rest[1].endswith("/") and tag not in _INLINE and tag in ("svg", "math"):
            continue
        stack.append(node)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        articles += tag in ("article", "main")
    flush()
    open_tags["html"] = open_tags.get("html", 0) + 1
    close(0)
    return nodes, blocks


def _close_within(stack: list[_Node], tags, close) -> None:
    """End the nearest open element of ``tags``, unless a container stands between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            close(depth)
            return
        if stack[depth].tag in _SCOPE:
            return


def _density(node: _Node) -> float:
    return node.links / node.chars if node.chars else 0.0


def _said(parts: list[_Part]) -> tuple[str, int]:
    """The text of a block, and how many characters of it are links."""
    text = _SPACE.sub(" ", "".join(p for p, _, _ in parts)).strip()
    return text, min(sum(len(_SPACE.sub(" ", p).strip()) for p, link, _ in parts if link), len(text))


def _points(text: str, linked: int) -> float:
    points = 1 + text.count(",") + text.count("،") + text.count("、") + min(len(text) / 100, 3)
    return points * (1 - linked / len(text))


def _note_marks(nodes: list[_Node], bits: dict[str, int]) -> None:
    """The set of marks of each element and of all above it."""
    for node in nodes:
        node.marks = (node.parent.marks if node.parent else 0) | (bits[node.mark] if node.mark else 0)


def _unmark(nodes: list[_Node], own: list[float]) -> None:
    """Take off marks that the page's text belies. ``own`` are the points of the text right in each element.

    - A header inside an article that holds an h1 is the article's.
    - An article or main with more points than all unmarked text takes off the marks above it.
    - A marked element with most of the page's points is unmarked; so are all elements of one mark that hold them
      together, as where each paragraph has its widget.
    - Beside an unmarked article with text, only marks inside an article can go. Marks of what others say stay there;
      without such an article they must hold nearly all points.
    """
    bits = {mark: 1 << n for n, mark in enumerate(dict.fromkeys(n.mark for n in nodes if n.mark))}
    if not bits:
        return
    _note_marks(nodes, bits)
    for node in reversed(nodes):
        node.held += own[node.index]
        if node.parent is not None:
            node.parent.held += node.held
    total = nodes[0].held
    articles = [n for n in nodes if n.tag in ("article", "main") and not n.mark and n.held]
    within = [False] * len(nodes)
    for node in nodes:
        within[node.index] = node.parent is not None and (within[node.parent.index] or node.parent.tag in ("article", "main"))
        if node.tag == "h1" and within[node.index]:
            # What has an article's title is the article's own header.
            up = node.parent
            while up is not None and up.tag not in ("article", "main"):
                up.mark, up = "" if up.mark == "header" else up.mark, up.parent
    _note_marks(nodes, bits)

    def unmarked() -> float:
        return sum(p for node, p in zip(nodes, own, strict=True) if not node.marks)

    best = max(articles, key=lambda n: (n.held, -n.index), default=None)
    if best is not None and best.marks and best.held > unmarked():
        up = best.parent
        while up is not None:
            up.mark, up = "", up.parent
        _note_marks(nodes, bits)
    # Each round takes off one mark at least.
    for _ in bits:
        if unmarked() > _MOST * total:
            return
        free = any(own[n.index] and not n.marks and (within[n.index] or n.tag in ("article", "main")) for n in nodes)

        def belied(node: _Node, held: float, free: bool = free) -> bool:
            foreign = node.mark in _FOREIGN
            if free and (foreign or not within[node.index]):
                return False
            return held > (_NEARLY_ALL if foreign else _MOST) * total

        gone = [n for n in nodes if n.mark and belied(n, n.held)]
        if not gone:
            together = dict.fromkeys(bits, 0.0)
            for node in nodes:
                if node.mark and not (node.parent.marks & bits[node.mark]):
                    together[node.mark] += node.held
            gone = [n for n in nodes if n.mark and belied(n, together[n.mark])]
        if not gone:
            return
        for node in gone:
            node.mark = ""
        _note_marks(nodes, bits)


def _free_blocks(nodes: list[_Node], blocks: list[tuple[_Node, list[_Part]]]) -> list[tuple[_Node, str, int]]:
    """The blocks outside marked elements as (element, text, link chars), after the scores had their say on marks."""
    own = [0.0] * len(nodes)
    for node, parts in blocks:
        text, linked = _said(parts)
        if text:
            points = _points(text, linked) if node.tag not in _HEADINGS else 0.5 * (1 - linked / len(text))
            every = sum(len(p) for p, _, _ in parts)
            for p, _, inner in parts:
                own[inner.index] += points * len(p) / every
    _unmark(nodes, own)
    found = []
    for node, parts in blocks:
        text, linked = _said([p for p in parts if not p[2].marks])
        if text:
            found.append((node, text, linked))
    return found


def main_text(html: str) -> str:
    """The blocks of the article and of its good siblings, in page order, joined by one space.

    On a page without an article or main these are the blocks of the best container, and all others but menus: those
    that are links by less than half, short ones and headings too.
    """
    nodes, blocks = _read(html)
    blocks = _free_blocks(nodes, blocks)
    if not blocks:
        return ""
    for node, text, linked in blocks:
        node.chars += len(text)
        node.links += linked
        if node.tag in _HEADINGS:
            continue
        points = _points(text, linked)
        # A block that is a paragraph passes its points on; text that stands right in a container counts there.
        up, share = (node if node.tag in _SCOPE else node.parent or node), 1.0
        while up is not None and share >= 0.25:
            up.points += points * share
            up, share = up.parent, share / 2
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links
    holders = [n for n in nodes if n.chars and not n.marks and (n.tag in _SCOPE or n.parent is None)]
    score = {n.index: n.points * (1 - _density(n)) for n in holders}
    best = max(holders, key=lambda n: (score[n.index], -n.index))
    # Inside an article, that article is the container.
    up = best
    while up.parent is not None:
        up = up.parent
        if up.tag in ("article", "main") and not up.marks:
            best = up
    kept = {best.index}
    article = best.tag in ("article", "main")
    if article and best.parent is not None:
        least = max(5.0, 0.2 * score.get(best.index, 0.0))
        for node in nodes:
            if node.parent is best.parent and node is not best and node.chars and not node.marks:
                good = node.tag in _SCOPE and score.get(node.index, 0.0) >= least
                prose = node.tag in ("p", "pre", "h1") and _density(node) < 0.25 and (node.tag == "h1" or node.chars > 80)
                if good or prose:
                    kept.add(node.index)
    # Elements stand in page order, so a parent is decided before its children.
    inside, menus = [False] * len(nodes), [False] * len(nodes)
    for node in nodes:
        up = node.parent
        menu = node.tag in ("ul", "ol") and node.chars > 0 and _density(node) > 0.8
        menus[node.index] = menu or up is not None and menus[up.index]
        inside[node.index] = (up is not None and inside[up.index] or node.index in kept) and not menu

    def stays(node: _Node, text: str, linked: int) -> bool:
        return inside[node.index] or not article and not menus[node.index] and linked < _LINKED * len(text)

    return " ".join(text for node, text, linked in blocks if stays(node, text, linked))


@F.pandas_udf(T.StringType())
def _main_texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([main_text(html) for html in part], dtype=object)


def extract_text(html: Column) -> Column:
    return _main_texts(F.coalesce(html, F.lit("")))


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) in place of the html; columns of these names are replaced.

    Narrow: each page by itself, whole, without a shuffle; repeated rows stay. Null, empty and textless html give an
    empty text. Broken markup is read as far as it goes: open elements end with their parents, and an unclosed quote
    or comment costs one more look at the rest of the page, not one for every tag.
    """
    own = ("text", "n_chars", html)
    text = pages.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in own], extract_text(F.col(f"`{html}`")).alias("text")
    )
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", "n_chars")
