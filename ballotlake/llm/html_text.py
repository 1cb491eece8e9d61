"""Main text of web pages by composite text density.

A page becomes a tree of elements. Parts that are never article text (menus, page headers, footers,
sidebars, notices, adverts, controls of forms, scripts, styles, reader comments) are told by element, role
and class, and are left out before anything is measured, however long they are. One stays if it encloses the
page's own article: an article or main element with text, of those that lie in the fewest menus, headers,
footers, sidebars, comments and the like (an article that is a comment or advert itself does not count, nor
does one inside comments, a sidebar or footer if the page has text outside of all such parts). A class that says what its element has or lacks ("has-sidebar", "no-ads") does not make it that part. On a
page without article and main element whose text lies in named parts altogether, one of them must be its wrapper:
the largest is opened, and so on inside until text is found. For every node the characters, tags, link
characters and link tags below it give its composite text density: characters per tag, adjusted by
the share of links. The density sum of a node adds its children's densities. The node with the largest
sum is the heart of the page; the smallest density on its path to the body is the threshold, and
wherever a node reaches it, the subtree with the largest sum below it is taken as content. A taken node
inside an article or main element is widened to that element, so no short paragraph of an article is
lost. A heart that encloses articles whose density sums outweigh all else below it moves into the
heaviest of them; a single word without a sentence mark beside such an article is a label and is not taken.

Every step is linear in the page: open elements are kept by name, so no tag walks through the open ones.

Defined results: null or empty html gives an empty text; unclosed and misplaced tags are closed as
browsers do for paragraphs, items and cells; a page without a body is read as one; plain text without
tags is one block; equal rows give equal rows; an empty table gives no rows. Further columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
# Elements that end the block of text before and after them.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul video audio canvas head".split()
)
NEVER = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map nav footer aside "
    "button select textarea input label legend menu dialog title xmp noembed noframes".split()
)
# Of these, the ones that a page may wrongly put around its article.
AROUND = frozenset("nav footer aside header menu dialog label".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
# Words of class and id values that mark parts around an article.
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar "
    "cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations pagination pager "
    "comment comments commentlist disqus respond replies reply widget widgets toolbar skip hidden".split()
)
# Of these, the ones of an article that is not the page's own.
OTHERS = frozenset("comment comments commentlist respond replies reply related recommended recommendations sponsored promo advert ad".split())
# Parts of a class that say what its element has or lacks.
MODIFIERS = frozenset("has have no non not with without enabled disabled layout".split())
CLOSES = {  # a start tag that ends open elements of these names, up to the nearest of the limits
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEEPERS = frozenset(("article", "main"))
# How an element is left out; BY_OTHER: by the name of a part that holds articles of its own kind, OTHER: such an article.
ALWAYS, BY_TAG, BY_NAME, BY_OTHER, OTHER = 1, 2, 3, 4, 5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*+)(?P<rest>(?:[^><\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/><]*+)(?P<rest2>[^><]*+)>",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…。！？؟।]")


def _left_out(name: str, rest: str, inside: bool) -> int:
    """Whether the element is never article text: ALWAYS, or unless it holds the page's; inside: within an article or main element."""
    if name in NEVER or name == "header" and not inside:
        return BY_TAG if name in AROUND else ALWAYS
    if not rest or name in ("html", "body"):
        return 0
    for key, *values in _NAMED.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden":
            return 0 if name in KEEPERS else ALWAYS
        if key == "aria-hidden" and value == "true":
            return BY_NAME
        if key == "role":
            if value in NEVER_ROLES:
                return BY_NAME
        elif key != "aria-hidden":
            named = [parts for token in value.split() if MODIFIERS.isdisjoint(parts := _PARTS.findall(token))]
            if any(not NEVER_NAMES.isdisjoint(parts) for parts in named):
                others = any(not OTHERS.isdisjoint(parts) for parts in named)
                return BY_NAME if not others else OTHER if name == "article" else BY_OTHER
    return 0


class _Page:
    """The tree in lists: parent, element name; and the runs of text with their node and block."""

    def __init__(self, source: str):
        self.parent, self.name, self.out, self.why = [-1], ["body"], [False], [0]
        self.texts: list[tuple[int, int, str]] = []
        self.block = 0
        # Open elements, the depths at which each name is open, and those of blocks.
        self.stack, self.open, self.open_blocks, self.inside = [0], {}, [], 0
        stack, at = self.stack, 0
        while at < len(source):
            found = _TAG.search(source, at)
            if found is None:
                self._text(stack[-1], source[at:])
                break
            if found.start() > at:
                self._text(stack[-1], source[at:found.start()])
            at = found.end()
            name = found["name"] or found["name2"]
            if name is None:
                if found[0].startswith("<![CDATA["):
                    self._text(stack[-1], found[0][9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if name == "br":
                self._text(stack[-1], " ")
                continue
            if name in BLOCKS:
                self.block += 1
            if name in ("html", "body"):
                continue
            if found["end"] or found["end2"]:
                if self.open.get(name):
                    self._close(self.open[name][-1])
                continue
            self._implied(name)
            rest = found["rest"] if found["name"] else found["rest2"]
            node = len(self.parent)
            self.parent.append(stack[-1])
            self.name.append(name)
            self.why.append(_left_out(name, rest, self.inside > 0))
            self.out.append(self.out[stack[-1]] or self.why[node] == ALWAYS)
            if name in VOID or rest.endswith("/") and name not in BLOCKS and name not in RAW:
                continue
            if name in RAW:
                close = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                if not self.out[node]:
                    self._text(node, source[at:close.start() if close else len(source)])
                at = close.end() if close else len(source)
                continue
            self.open.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                self.open_blocks.append(len(stack))
            stack.append(node)
            self.inside += name in KEEPERS
        self._leave_out()

    def _close(self, depth: int) -> None:
        """Closes the open elements from a depth on."""
        while len(self.stack) > depth:
            name = self.name[self.stack.pop()]
            self.open[name].pop()
            if name in BLOCKS:
                self.open_blocks.pop()
            self.inside -= name in KEEPERS

    def _leave_out(self) -> None:
        """Leaves out what is told by name or element, unless it holds the page's own article."""
        number = len(self.parent)
        chars, linked = [0] * number, [False] * number
        apart = [0] * number  # parts around each node that may hold articles
        foreign = [False] * number  # one of them is made for articles of others
        part = list(range(number))  # the innermost part that would be left out, around each node
        for node in range(1, number):
            up, why = self.parent[node], self.why[node]
            linked[node] = linked[up] or self.name[node] == "a"
            apart[node] = apart[up] + (why in (BY_TAG, BY_OTHER))
            foreign[node] = foreign[up] or why == BY_OTHER or self.name[node] in ("aside", "footer")
            part[node] = node if why and why != OTHER or self.out[node] else part[up]
        part[0] = 0
        plain = [0] * number  # characters by innermost part, without links
        for node, _, text in self.texts:
            size = sum(map(len, text.split()))
            chars[node] += size
            plain[part[node]] += 0 if linked[node] else size
        for node in range(number - 1, 0, -1):
            chars[self.parent[node]] += chars[node]
        articles = [n for n in range(1, number) if chars[n] and self.name[n] in KEEPERS and self.why[n] != OTHER and not self.out[n]]
        fewest = min((apart[n] for n in articles), default=0)
        if fewest and plain[0]:
            # There is other text, so that an article in comments or a sidebar is not the page's own.
            articles = [n for n in articles if self.name[n] == "main" or not foreign[n]]
            fewest = min((apart[n] for n in articles), default=0)
        kept = [False] * number  # encloses, or is, what stays
        for node in articles:
            kept[node] = apart[node] == fewest
        if not articles:
            for node in self._wrappers(part, plain, chars):
                kept[node] = True
        for node in range(number - 1, 0, -1):
            kept[self.parent[node]] |= kept[node]
        for node in range(1, number):
            if self.why[node] in (BY_NAME, BY_OTHER) and self.name[node] not in KEEPERS or self.why[node] == BY_TAG:
                self.out[node] |= not kept[node]
            self.out[node] |= self.out[self.parent[node]]
        self.texts = [found for found in self.texts if not self.out[found[0]]]

    def _wrappers(self, part: list[int], plain: list[int], chars: list[int]) -> list[int]:
        """Named parts to be opened where no text lies outside of all of them: the largest, then within it."""
        inner: dict[int, list[int]] = {}
        for node in range(1, len(part)):
            if part[node] == node and self.why[node] in (BY_NAME, BY_OTHER) and chars[node]:
                inner.setdefault(part[self.parent[node]], []).append(node)
        opened, at = [], 0
        while not plain[at] and at in inner:
            at = max(inner[at], key=lambda n: (chars[n], -n))
            opened.append(at)
        return opened

    def _implied(self, name: str) -> None:
        """Closes what the start tag ends."""
        if name in BLOCKS and self.open_blocks and self.name[self.stack[self.open_blocks[-1]]] == "p":
            self._close(self.open_blocks[-1])
            return
        if name in CLOSES:
            ends, limits = (max((self.open[n][-1] for n in names if self.open.get(n)), default=0) for names in CLOSES[name])
            if ends > limits:
                self._close(ends)

    def _text(self, node: int, text: str) -> None:
        if not self.out[node]:
            self.texts.append((node, self.block, entities.unescape(text)))

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite text density and density sum of every node; children come after their parents."""
        number = len(self.parent)
        chars, links, tags, link_tags = [0] * number, [0] * number, [0] * number, [0] * number
        in_link = [False] * number
        for node in range(number):
            up = self.parent[node]
            in_link[node] = self.name[node] == "a" or up >= 0 and in_link[up]
        for node, _, text in self.texts:
            size = sum(map(len, text.split()))
            chars[node] += size
            if in_link[node]:
                links[node] += size
        for node in range(number - 1, 0, -1):
            if self.out[node]:
                continue
            up = self.parent[node]
            chars[up] += chars[node]
            links[up] += links[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (self.name[node] == "a")
        self.chars = chars
        share = links[0] / max(chars[0], 1)
        density, total = [0.0] * number, [0.0] * number
        for node in range(number - 1, -1, -1):
            if chars[node] and not self.out[node]:
                c, lc = chars[node], links[node]
                t, lt = max(tags[node], 1), max(link_tags[node], 1)
                base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
                density[node] = c / t * (math.log(c / max(lc, 1) * t / lt + 1e-9) / math.log(base + 1e-9) if base > 1 else
                                         math.log(c / max(lc, 1) * t / lt + math.e))
            if node:
                total[self.parent[node]] += density[node]
        return density, total

    def content(self) -> set[int]:
        """Nodes whose subtrees are the content."""
        density, total = self.densities()
        number = len(self.parent)
        # The outermost article or main element around each node, and whether a node encloses one.
        keeper, encloses = [-1] * number, [False] * number
        for node in range(1, number):
            up = self.parent[node]
            if keeper[up] >= 0:
                keeper[node] = keeper[up]
            elif self.name[node] in KEEPERS and not self.out[node]:
                keeper[node] = node
        for node in range(number - 1, 0, -1):
            encloses[self.parent[node]] |= encloses[node] or keeper[node] == node
        heart = max(range(number), key=lambda n: (total[n], density[n], -n))
        if keeper[heart] < 0 and encloses[heart]:
            below, articles, rest = [False] * number, [], 0.0
            for node in range(heart, number):
                up = self.parent[node]
                # Only nodes that enclose an article hand the search on to their children.
                below[node] = node == heart or up >= 0 and below[up] and encloses[up] and keeper[up] < 0
                if below[node] and keeper[node] == node:
                    articles.append(node)
                elif below[node] and not encloses[node]:
                    rest += max(total[node], density[node])
            if sum(max(total[n], density[n]) for n in articles) > rest:
                heart = max(articles, key=lambda n: (total[n], density[n], -n))
        path, node = [], heart
        while node >= 0:
            path.append(node)
            node = self.parent[node]
        threshold = min(density[n] for n in path)
        # The largest density sum at or below each node, and where it is.
        peak = list(range(number))
        for node in range(number - 1, 0, -1):
            up = self.parent[node]
            if (total[peak[node]], -peak[node]) > (total[peak[up]], -peak[up]):
                peak[up] = peak[node]
        on_path = set(path)
        if keeper[heart] >= 0:
            peak = [heart if node in on_path else peak[node] for node in range(number)]
        chosen = {heart} | {
            peak[node] for node in range(number)
            if not self.out[node] and density[node] > 0 and density[node] >= threshold
        }
        chosen = {keeper[node] if keeper[node] >= 0 else node for node in chosen}
        if keeper[heart] >= 0:
            beside = {node for node in chosen if keeper[node] < 0}
            taken = self._below(beside)
            words = [word for node, _, text in self.texts if taken[node] for word in text.split()]
            if len(words) == 1 and not _SENTENCE.search(words[0]):
                chosen -= beside
        return chosen

    def _below(self, chosen: set[int]) -> list[bool]:
        """Whether a node is one of the chosen or below one."""
        taken = [False] * len(self.parent)
        for node in range(len(self.parent)):
            up = self.parent[node]
            taken[node] = not self.out[node] and (node in chosen or up >= 0 and taken[up])
        return taken

    def main_text(self) -> str:
        taken = self._below(self.content())
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.texts:
            if taken[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return _Page(source).main_text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return extract(common.table(spark, folder, "pages"))
