"""Reading one HTML page: small helpers for the extraction tasks, and a JVM-side clean-up of markup."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkmill.functions.scalars import has_text, strip

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li"
    " main nav ol p pre section table td th tr ul".split()
)
SKIPPED = frozenset("script style noscript template nav header footer aside".split())
CONTAINERS = frozenset("article main section div td body".split())

#: Share of a container's text from which one container in it stands for it.
NEARLY_ALL = 0.75

# Fixed value: a paragraph needs this many pieces between single spaces.
MIN_PARAGRAPH_WORDS = 4


class SoleStrings(HTMLParser):
    """Collects, for every ``<p>``, its text if a chain of only children leads to one string, else nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []
        self.open: list[dict] = []
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and self.counts.get("p"):
            self.handle_endtag("p")
        self._add_child(None)
        if tag not in VOID:
            self.counts[tag] = self.counts.get(tag, 0) + 1
            self.open.append({"tag": tag, "children": 0, "text": None, "ends_in_text": False})

    def handle_startendtag(self, tag, attrs):
        self._add_child(None)

    def handle_data(self, data):
        if self.open and self.open[-1]["ends_in_text"]:
            if self.open[-1]["children"] == 1:
                self.open[-1]["text"] += data
        else:
            self._add_child(data)

    def handle_comment(self, data):
        self._add_child(data)
        if self.open:
            self.open[-1]["ends_in_text"] = False

    def handle_endtag(self, tag):
        if self.counts.get(tag):
            while self._close_last() != tag:
                pass

    def close(self):
        super().close()
        while self.open:
            self._close_last()

    def _add_child(self, text):
        if self.open:
            node = self.open[-1]
            node["children"] += 1
            node["text"] = text if node["children"] == 1 else None
            node["ends_in_text"] = text is not None

    def _close_last(self) -> str:
        node = self.open.pop()
        self.counts[node["tag"]] -= 1
        if node["tag"] == "p" and node["text"] is not None:
            self.found.append(node["text"])
        if self.open and self.open[-1]["children"] == 1:
            self.open[-1]["text"] = node["text"]
        return node["tag"]


def paragraph_text(html: str) -> tuple[str, int, int]:
    """(text, words, paragraphs): plain paragraphs of at least four words, NFKD, joined by a space."""
    reader = SoleStrings()
    reader.feed(html)
    reader.close()
    normal = (unicodedata.normalize("NFKD", s) for s in reader.found)
    kept = [s.strip() for s in normal if s.count(" ") + 1 >= MIN_PARAGRAPH_WORDS]
    return " ".join(kept), sum(s.count(" ") + 1 for s in kept), len(kept)


class ArticleReader(HTMLParser):
    """Collects title, language and the text of all blocks by the container they stand in.

    The page's title heading is no block. Elements that are left open end with their parents, the skipped ones too.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.lang = "", ""
        self.in_title = False
        #: Open block elements, from the outside in, with the number of the container that their text belongs to.
        self.open: list[tuple[str, int]] = [("body", 0)]
        self.counts: dict[str, int] = {"body": 1}
        self.skip = 0
        self.blocks: list[tuple[int, bool, str]] = []
        self.buffer: list[str] = []
        #: The container that each container stands in.
        self.parents = [0]

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "html" and values.get("lang"):
            self.lang = self._primary(values["lang"])
        elif tag == "meta" and not self.lang and (values.get("http-equiv") or "").lower() == "content-language":
            self.lang = self._primary(values.get("content") or "")
        elif tag == "title" and not self.title:
            self.in_title = True
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID or tag not in BLOCKS | SKIPPED | CONTAINERS or tag == "body":
            if tag == "hr":
                self._flush()
            return
        self._flush()
        if self.counts.get("p") and self.open[-1][0] == "p":
            self._leave()
        number = self.open[-1][1]
        if tag in CONTAINERS:
            self.parents.append(number)
            number = len(self.parents) - 1
        self.open.append((tag, number))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.skip += tag in SKIPPED

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        elif tag in BLOCKS or tag in SKIPPED:
            self._flush()
            if self.counts.get(tag):
                while self._leave() != tag:
                    pass

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip and not self.counts.get("h1"):
            self.buffer.append(data)

    def close(self):
        super().close()
        self._flush()

    @staticmethod
    def _primary(code: str) -> str:
        """The primary subtag of a language code."""
        return code.split(",")[0].strip().replace("_", "-").split("-")[0].lower()

    def _leave(self) -> str:
        tag, _ = self.open.pop()
        self.counts[tag] -= 1
        self.skip -= tag in SKIPPED
        return tag

    def _flush(self):
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        if text and not self.skip:
            self.blocks.append((self.open[-1][1], bool(self.counts.get("article")), text))

    def main_text(self) -> str:
        """The blocks of the article; without one, those of the innermost container that holds nearly all of the text
        around it. So sections beside each other all stay, and what is small beside one container goes."""
        inside = [text for _, in_article, text in self.blocks if in_article]
        if inside:
            return "\n\n".join(inside)
        sizes = [0] * len(self.parents)
        for container, _, text in self.blocks:
            sizes[container] += len(text)
        fullest = list(range(len(sizes)))
        for container in range(len(sizes) - 1, 0, -1):  # a container comes after the one it stands in
            parent = self.parents[container]
            sizes[parent] += sizes[container]
            if fullest[parent] == parent or sizes[container] >= sizes[fullest[parent]]:
                fullest[parent] = container
        best = 0
        while fullest[best] != best and sizes[fullest[best]] >= NEARLY_ALL * sizes[best]:
            best = fullest[best]
        within = [False] * len(sizes)
        within[best] = True
        for container in range(best + 1, len(sizes)):
            within[container] = within[self.parents[container]]
        return "\n\n".join(text for container, _, text in self.blocks if within[container])


def article(html: str) -> tuple[str, str, str]:
    """(title, language, main text)."""
    reader = ArticleReader()
    reader.feed(html)
    reader.close()
    return " ".join(reader.title.split()), reader.lang, reader.main_text()


#: Markup without text, removed with its content.
DROPPED_MARKUP = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->|<!doctype[^>]*>"


#: Scripts inside tags: event handlers, and links that run a script. A value in quotes, with the tag's end ahead.
INLINE_SCRIPT = (
    r"""(?is)\s(?:on[a-z]+\s*=\s*(?:"[^"]*"|'[^']*')|(?:href|src|action)\s*=\s*(?:"\s*javascript:[^"]*"|'\s*javascript:[^']*'))"""
    r"(?=[^<>]*>)"
)


def clean_markup(html: Column) -> Column:
    """Scripts, also those inside tags, styles and comments removed, white space minified but for ``<pre>``; null if no
    text is left between the tags."""
    bare = F.regexp_replace(F.regexp_replace(html, DROPPED_MARKUP, ""), INLINE_SCRIPT, "")

    def minified(part: Column) -> Column:
        small = F.regexp_replace(F.regexp_replace(part, r"\s+", " "), r"> <", "><")
        return F.when(part.rlike(r"(?is)^<pre\b"), part).otherwise(F.regexp_replace(small, r"(?<=>) \z|\A (?=<)", ""))

    parts = F.split(bare, r"(?is)(?=<pre\b)|(?<=</pre>)", -1)
    small = F.trim(F.array_join(F.transform(parts, minified), ""))
    visible = F.regexp_replace(F.regexp_replace(small, r"(?is)<title\b[^>]*>.*?</title\s*>", ""), "<[^>]*>", "")
    return F.when(has_text(visible), small)


def simple_paragraphs(html: Column) -> Column:
    """The strings of attribute-free ``<p>`` elements without inner markup, entities undone; stays in the JVM."""
    found = F.regexp_extract_all(html, F.lit("<p>([^<]*)</p>"), F.lit(1))
    return F.transform(found, unescape_basic)


def unescape_basic(text: Column) -> Column:
    """The entities every HTML writer uses; ``&amp;`` last, so that nothing is undone twice."""
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def long_paragraphs(paragraphs: Column) -> Column:
    """Paragraphs of at least four space-separated pieces, stripped."""
    kept = F.filter(paragraphs, lambda p: F.size(F.split(p, " ", -1)) >= MIN_PARAGRAPH_WORDS)
    return F.transform(kept, strip)
