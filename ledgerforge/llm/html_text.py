"""Main text of web pages by equivalence classes of tokens across the pages of a host.

A token is an element with its path of open elements, or a block of text with its path. Its occurrence vector says how often each
page of the host has it; tokens with equal vectors form a class. A large class found on nearly all pages of a host is of its
template. A rarer one is of the template of a layout if it nests: on all its pages its texts have one order and lie in the same gaps
of each ordered class that has all these pages, and the slots left beside it are filled by text that differs from page to page and
is not less than its own (else it is a copied article).

The template's containers nest as the pages' elements do; what a container holds besides the template's texts and its inner
containers is a slot. The slots of all pages of a host tell the article: it is where most pages have most of their text outside
links, with what lies within it and the heading before it. Within it nothing goes for its links or for being repeated; the template's
texts go from containers of their own, which have no other text on the page, and where they frame the article's text on both sides.
Names of tags, classes and ids part menus, notices, adverts, forms and comments from the rest; they decide alone on pages without
such a template.

Vectors are never built: a class is known by the exclusive-or of one hash per page and count, an aggregate that combines on the
map side, so a host with a third of all pages is no burden. Pages are parsed twice: once to a narrow table of what their elements and
blocks are, which classes, places and slots are read from, and once for their text; in between only templates travel.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ledgerforge.llm.common import written

#: A class is valid with this many pages and tokens, on this share of the host's pages.
LEAST_PAGES, LEAST_TOKENS, LEAST_SHARE = 10, 4, 0.9
#: From this share of the host's pages on, a class that nests is of a layout's template.
LAYOUT_SHARE = 0.1
#: A slot beside the article's is a part of it with this share of its text, at most this share of it in links, if it differs on this share of pages.
PART_TEXT, PART_LINKS, PART_FILLS = 0.25, 0.3, 0.9

# HTML's elements by how they are read.
_RAW = ("script", "style", "noscript", "template", "iframe", "svg", "canvas", "audio", "video", "textarea", "title", "xmp", "noembed", "noframes")
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_BLOCK = frozenset(
    ("address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
)
_CONTAINERS = frozenset(("article", "aside", "body", "center", "div", "footer", "form", "header", "main", "menu", "nav", "section", "td"))
#: These are containers if they have a class or an id.
_LABELLED = frozenset(("blockquote", "details", "dl", "figure", "ol", "table", "ul"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ENDS_P = _BLOCK - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup"}
_DROPPED = frozenset(("nav", "footer", "aside", "form", "fieldset", "select", "button", "menu", "dialog", "head", "label", "input"))
#: A class or id names what isn't the article if one of its words is of the first list, and all others are of these two.
_NAMED = frozenset(
    ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets")
)
_NEUTRAL = frozenset(
    ("area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "entry", "form", "global", "group", "holder", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "overlay", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "stories", "text", "thread", "title", "top", "unit", "wrap", "wrapper")
)
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.DOTALL)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in _RAW}
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_OWN_NUMBER = re.compile(r"[-_]\d+|\d{3}")
_SPACE = re.compile(r"\s+")


def named(name: str) -> bool:
    """Whether a class or id says that its element isn't the article's."""
    words = [w.lower() for w in _WORD.findall(name)]
    return not _NAMED.isdisjoint(words) and all(w in _NAMED or w in _NEUTRAL or len(w) == 1 or w.isdigit() for w in words)


def set_aside(tag: str, attributes: dict[str, str], inside: int) -> bool:
    """Whether an element by its name or attributes isn't article text. inside: 0, or 1 in `main`, or 2 in an article."""
    if tag in _DROPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main") or tag in _HEADINGS:
        return False
    labels = [*attributes.get("class", "").split(), *attributes.get("id", "").split()]
    if tag == "article":
        return any("comment" in x.lower() for x in labels)
    if any(map(named, labels)):
        return True
    if "header" in labels and not inside:
        return True
    style = attributes.get("style", "").replace(" ", "").lower()
    return attributes.get("role", "").lower() in _ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style


class Element(NamedTuple):
    parent: int
    tag: str
    token: int
    container: bool


class Block(NamedTuple):
    element: int
    text: str
    links: int  # characters in links
    inside: int  # 2 within an article, 1 within main, else 0
    aside: bool


class Page:
    """The elements of a page (that of a block each, the first for the page itself) and its blocks of text, both in order."""

    def __init__(self, source: str):
        self.elements: list[Element] = [Element(-1, "", 0, False)]
        self.blocks: list[Block] = []
        self.order: list[int] = []  # elements, and blocks as their complements
        self.stack: list[tuple[str, int, int, bool]] = []  # tag, element, inside, set aside
        self.run: list[str] = []
        self.links = self.linked = 0  # links open, and characters in links of the run
        self.headers: dict[int, bool] = {}  # headers of `main` outside an article: whether they have a main heading
        at, n = 0, len(source)
        for m in _TOKEN.finditer(source) if "<" in source else ():
            start, end = m.span()
            if start < at:
                continue  # within raw text
            if start > at:
                self._add(source[at:start])
            at = end
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                self._close(tag)
            else:
                self._open(tag, m[3])
                if tag in _RAW_END and not m[3].rstrip().endswith("/"):
                    close = _RAW_END[tag].search(source, at)
                    at = close.end() if close else n
        if at < n:
            self._add(source[at:])
        self._flush()
        if not all(self.headers.values()):
            self.blocks = [b._replace(aside=True) if any(not self.headers.get(e, True) for e in self.chain(b.element)) else b for b in self.blocks]

    def chain(self, element: int) -> Iterator[int]:
        """The element and those around it, inner ones first."""
        while element > 0:
            yield element
            element = self.elements[element].parent

    def _add(self, text: str) -> None:
        self.run.append(text)
        if self.links:
            self.linked += len(text)

    def _flush(self) -> None:
        if self.run:
            text = _SPACE.sub(" ", html.unescape("".join(self.run))).strip()
            self.run = []
            if text:
                _, element, inside, aside = self.stack[-1] if self.stack else ("", 0, 0, False)
                self.order.append(~len(self.blocks))
                self.blocks.append(Block(element, text, min(self.linked, len(text)), inside, aside))
        self.linked = 0

    def _open(self, tag: str, attributes: str) -> None:
        if tag in _VOID or tag in _RAW_END:
            if tag == "br":
                self.run.append(" ")
            elif tag in _BLOCK:
                self._flush()
            return
        block = tag in _BLOCK
        if block:
            self._flush()
            if tag in _ENDS_P:
                self._end_p()
            if tag in ("li", "dd", "dt", "option", "tr", "td", "th"):
                self._end_like(tag)
        _, element, inside, aside = self.stack[-1] if self.stack else ("", 0, 0, False)
        known = {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes and "=" in attributes or "hidden" in attributes else {}
        before, aside = aside, aside or set_aside(tag, known, inside)
        if not block and aside and not before:
            self._flush()  # an inline element that is set aside ends the text before it
        if block:
            # numbers in classes and ids are the page's own
            labels = sorted(x for x in f"{known.get('class', '')} {known.get('id', '')}".split() if not _OWN_NUMBER.search(x))
            path = f"{self.elements[element].token:x}/{tag} {' '.join(labels)}"
            self.order.append(len(self.elements))
            self.elements.append(Element(element, tag, xxhash.xxh3_64_intdigest(path) & ~1, tag in _CONTAINERS or bool(labels) and tag in _LABELLED))
            element = len(self.elements) - 1
            if tag == "header" and inside == 1:
                self.headers[element] = False
            elif tag == "h1":
                self.headers.update((e, True) for e in self.chain(element) if e in self.headers)
        if not attributes.rstrip().endswith("/") or block:
            self.stack.append((tag, element, 2 if tag == "article" else max(inside, int(tag == "main")), aside))
            self.links += tag == "a"

    def _cut(self, k: int) -> None:
        self.links -= sum(x[0] == "a" for x in self.stack[k:])
        del self.stack[k:]

    def _end_p(self) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == "p":
                self._cut(k)
                return
            if self.stack[k][0] in _BLOCK:
                return

    def _end_like(self, tag: str) -> None:
        """An item, row or cell ends the one that is open in the same list or table."""
        same, bound = {"li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)), "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}[tag]
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in same:
                self._cut(k)
                return
            if self.stack[k][0] in bound:
                return

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if tag in _BLOCK or self.stack[k][3] != (self.stack[k - 1][3] if k else False):
                    self._flush()
                self._cut(k)
                return
            if self.stack[k][0] in _BLOCK and tag not in _BLOCK:
                return  # an inline end tag doesn't close a block
        if tag in _BLOCK:
            self._flush()

    def token(self, block: Block) -> int:
        """A text's token: odd, while those of elements are even."""
        return xxhash.xxh3_64_intdigest(f"{self.elements[block.element].token:x}\n{block.text}") | 1

    def tokens(self) -> list[int]:
        """64-bit hashes of elements and texts with their paths, in the page's order."""
        return [self.elements[k].token if k >= 0 else self.token(self.blocks[~k]) for k in self.order]

    def marked(self) -> list[Block]:
        """The blocks of the article as markup tells it, or of all where no element is one, without those set aside."""
        article = any(b.inside and not b.aside for b in self.blocks)
        return [b for b in self.blocks if not b.aside and (b.inside or not article)]

    def text(self, template=frozenset(), mains=()) -> str:
        """The article's blocks without what is the site's.

        mains: (main, parts) containers by rank; the first that the page has holds the article, its parts are of it too. Where the page
        has none of them, markup tells the article; where that doesn't either, all texts of the template are the site's.
        """
        own = {e.token for e in self.elements} if mains else ()
        region = next(({main, *parts} for main, parts in mains if main in own), None)
        if region is None:
            kept = self.marked()
            if not any(b.inside for b in kept):
                return "\n".join(b.text for b in kept if self.token(b) not in template)
            return "\n".join(b.text for b in self.without_site(kept, {k for k, e in enumerate(self.elements) if e.tag in ("article", "main")}, template))
        within = [False]
        for e in self.elements[1:]:
            within.append(e.token in region or within[e.parent])
        of = [b for b in self.blocks if not b.aside]
        kept = self.without_site([b for b in of if within[b.element]], {k for k, e in enumerate(self.elements) if e.token in region}, template)
        first = next((k for k, b in enumerate(of) if within[b.element]), 0)
        tags = [self.elements[b.element].tag for b in kept]
        if "h1" not in tags and (not tags or tags[0] not in _HEADINGS):  # the heading before it, with what lies between
            before = [b for b in of[:first] if self.token(b) not in template]
            head = max((k for k, b in enumerate(before) if self.elements[b.element].tag == "h1"), default=len(before))
            kept = before[head:] + kept
        return "\n".join(b.text for b in kept)

    def without_site(self, blocks: list[Block], roots: set[int], template) -> list[Block]:
        """An article's blocks without the template's texts in containers within the roots that hold nothing else, and without those before
        and after all other text if there are such on both sides, LEAST_TOKENS together."""
        site = [self.token(b) in template for b in blocks]
        if not any(site):
            return blocks
        around = [[e for e in self.chain(b.element) if self.elements[e].container] for b in blocks]
        around = [es[: next((k for k, e in enumerate(es) if e in roots), len(es))] for es in around]  # those within the innermost root
        filled = {e for es, of_site in zip(around, site, strict=True) if not of_site for e in es}
        left = [(b, of_site) for b, of_site, es in zip(blocks, site, around, strict=True) if not of_site or filled.issuperset(es)]
        own = [k for k, (_, of_site) in enumerate(left) if not of_site]
        if own and own[0] and own[-1] < len(left) - 1 and own[0] + len(left) - 1 - own[-1] >= LEAST_TOKENS:
            left = left[own[0] : own[-1] + 1]
        return [b for b, _ in left]


def host_of(url: Column) -> Column:
    """The host in lower case, '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: What a page's elements and blocks are, without its text: parents and elements by number, texts by their hashes and sizes.
PARSED = "host string, e_token array<long>, e_parent array<int>, e_container array<boolean>, b_token array<long>, b_text array<long>, b_element array<int>, b_chars array<int>, b_links array<int>, b_inside array<int>, b_aside array<boolean>, place array<int>"
PARSED_NAMES = [x.split()[0] for x in PARSED.split(", ")]


def parsed(pages: DataFrame) -> DataFrame:
    """Each page (url, html) as a row of PARSED; pages that are such rows already stay."""
    if "e_token" in pages.columns:
        return pages
    kinds = {"string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    arrow = [kinds[x.split()[1]] for x in PARSED.split(", ")]
    signed = lambda xs: np.array(xs, np.uint64).view(np.int64)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                rows = []
                for host, source in zip(batch.column(0).slice(a, 200), batch.column(1).slice(a, 200), strict=True):
                    page = Page(source.as_py() or "")
                    e, b = list(zip(*page.elements, strict=True)), list(zip(*page.blocks, strict=True)) or [()] * 5
                    texts = [xxhash.xxh3_64_intdigest(t) for t in b[1]]
                    rows.append((host.as_py(), signed(e[2]), e[0], e[3], signed([page.token(x) for x in page.blocks]), signed(texts), b[0], list(map(len, b[1])), b[2], b[3], b[4], page.order))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), arrow, strict=True)], PARSED_NAMES)

    return written(_hosted(pages).mapInArrow(parse, PARSED), "parsed")


class Outline:
    """A page as a row of PARSED tells it."""

    def __init__(self, row: tuple):
        self.host = row[0].as_py()
        e_token, self.parent, self.container, b_token, self.b_text, self.b_element, self.b_chars, self.b_links, self.b_inside, self.b_aside, place = (x.values.to_numpy(zero_copy_only=False) for x in row[1:12])
        self.e_token, self.b_token = e_token.view(np.uint64), b_token.view(np.uint64)
        # in the page's order
        self.tokens = np.where(place >= 0, self.e_token[np.maximum(place, 0)], self.b_token[np.maximum(~place, 0)] if len(b_token) else 0).astype(np.uint64)

    def marked(self) -> np.ndarray:
        """The blocks of the article as markup tells it, or of all where no element is one, without those set aside."""
        kept = ~self.b_aside
        inside = kept & (self.b_inside > 0)
        return np.flatnonzero(inside if inside.any() else kept)

    def slots(self, template) -> list[int]:
        """For each element the innermost of the template's containers that it is or lies in, 0 for none."""
        out = [0]
        for k, (token, up, container) in enumerate(zip(self.e_token[1:].tolist(), self.parent[1:].tolist(), self.container[1:].tolist(), strict=True), 1):
            out.append(k if container and token in template else out[up])
        return out


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, token, page (a hash of the row's place in the scan and of the count) for each distinct token of each page."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            hosts, tokens, vector = [], [], []
            for values in zip(*batch.columns, strict=True):
                page = Outline(values)
                found, counts = np.unique(np.append(page.tokens, np.uint64(0)), return_counts=True)
                seed = xxhash.xxh3_64_intdigest(row.to_bytes(8, "little"))
                hosts += [page.host] * len(found)
                tokens.append(found.view(np.int64))
                mixed = (counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(seed)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                vector.append((mixed ^ (mixed >> np.uint64(31))).view(np.int64))
                row += 1
            if hosts:
                yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(np.concatenate(tokens)), pa.array(np.concatenate(vector))], ["host", "token", "page"])

    return parsed(pages).mapInArrow(walk, "host string, token long, page long")


def classes(pages: DataFrame) -> DataFrame:
    """host, id, tokens, shared: the host's large classes, and whether nearly all of its pages have them.

    Token 0 stands for the page itself, so its count is the host's.
    """
    tokens = page_tokens(pages).groupBy("host", "token").agg(F.bit_xor("page").alias("vector"), F.count("*").alias("pages"))
    # what few pages have can't be of a template; most text is such, so little is left here
    tokens = written(tokens.where((F.col("pages") >= LEAST_PAGES) | (F.col("token") == 0)), "tokens")
    sizes = tokens.where("token = 0").select("host", F.col("pages").alias("of"))
    common = tokens.where("token <> 0").join(sizes, "host").where(F.col("pages") >= LAYOUT_SHARE * F.col("of"))
    found = common.groupBy("host", "vector", "pages", "of").agg(F.collect_set("token").alias("tokens")).where(F.size("tokens") >= LEAST_TOKENS)
    return found.select("host", F.xxhash64("vector", "pages").alias("id"), "tokens", (F.col("pages") >= LEAST_SHARE * F.col("of")).alias("shared"))


def _digest(values) -> int:
    return xxhash.xxh3_64_intdigest(repr(values)) >> 2


def _order(found: list[int]) -> int:
    """A hash of the order in which tokens come, once or again and again; -1 if they come in several."""
    n = len(set(found))
    return _digest(found[:n]) if n == 0 or (len(found) % n == 0 and found == found[:n] * (len(found) // n)) else -1


def _gaps(texts: list[tuple[int, int]], places: list[int], tokens: list[int]) -> int:
    """A hash of the gaps, each known by the tokens around it, in which texts (place, token) lie."""
    gaps = set()
    for place, token in texts:
        k = bisect_left(places, place)
        gaps.add((token, tokens[places[k - 1]] if k else 0, tokens[places[k]] if k < len(places) else 0))
    return _digest(sorted(gaps))


def class_places(rows: DataFrame) -> DataFrame:
    """For each page, class of texts that isn't shared, and class of the page: the places of the first in the second; its own order for all.

    rows: PARSED's columns and classes. Out: host, id, other, a and b (by all tokens of `other`, and by its texts), fill (a hash of the text
    that is of no class), fill_chars, own_chars (of the class within the article).
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, known = ("host", "id", "other", "a", "b", "fill", "fill_chars", "own_chars"), None, {}
        sure: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = []
                for *values, found in zip(*(c.slice(start, 200) for c in batch.columns), strict=True):
                    page = Outline(values)
                    if last != page.host:
                        last, known = page.host, {unsigned(x): c["id"] for c in found.as_py() for x in c["tokens"]}
                        sure = {c["id"] for c in found.as_py() if c["shared"]}
                    tokens, places, own = page.tokens.tolist(), {}, {}
                    for k, x in enumerate(tokens):
                        if x in known:
                            places.setdefault(known[x], []).append(k)
                    article = [(int(page.b_chars[k]), int(page.b_text[k]), known.get(int(page.b_token[k]))) for k in page.marked()]
                    for n, _, c in article:
                        own[c] = own.get(c, 0) + n
                    fill = _digest([t for _, t, c in article if c is None])
                    both = {c: (at, [k for k in at if tokens[k] & 1]) for c, at in places.items()}
                    for c, (at, texts) in both.items():
                        rest = (fill, own.get(None, 0), own.get(c, 0))
                        out.append((last, c, c, _order([tokens[k] for k in at]), _order([tokens[k] for k in texts]), *rest))
                        if texts and c not in sure:
                            pairs = [(k, tokens[k]) for k in texts]
                            out += [(last, c, d, _gaps(pairs, x, tokens), _gaps(pairs, y, tokens), *rest) for d, (x, y) in both.items() if d != c]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string() if k == 0 else pa.int64()) for k in range(len(names))], names)

    return rows.select(*PARSED_NAMES, "classes").mapInArrow(walk, "host string, id long, other long, a long, b long, fill long, fill_chars long, own_chars long")


def layouts(places: DataFrame) -> DataFrame:
    """host, id: the classes that nest, of those in `places`, and leave slots."""
    one = lambda c: ((F.min(c) == F.max(c)) & (F.min(c) >= 0)).alias(f"one_{c}")
    facts = written(places.groupBy("host", "id", "other").agg(one("a"), one("b"), F.count("*").alias("pages"), F.sum("fill_chars").alias("fill_chars"), F.sum("own_chars").alias("own_chars")), "places")
    own = facts.where("id = other")
    fills = places.where("id = other").groupBy("host", "id", "fill").count().groupBy("host", "id").agg(F.count("*").alias("fills"))
    inner = facts.where("id <> other").join(own.select("host", "id", F.col("pages").alias("of")), ["host", "id"]).where("pages = of")
    outer = own.select("host", F.col("id").alias("other"), F.col("one_a").alias("by_a"), F.col("one_b").alias("by_b"))
    moved = inner.join(outer, ["host", "other"]).where("CASE WHEN by_a THEN NOT one_a WHEN by_b THEN NOT one_b ELSE false END").select("host", "id").distinct()
    slotted = own.where("one_b AND own_chars <= fill_chars").join(fills, ["host", "id"]).where("2 * fills > pages")
    return slotted.select("host", "id").join(moved, ["host", "id"], "left_anti")


def page_slots(rows: DataFrame) -> DataFrame:
    """Per page (rows: PARSED's columns and template) and container of the template: host, slot, outer (the container around it), chars and links
    (characters, and those in links, of its slot: what inner containers, the template's texts and set-aside elements leave), fill (a hash
    of that text), won (whether no slot of the page has more text outside links)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, template = ("host", "slot", "outer", "chars", "links", "fill", "won"), None, frozenset()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = []
                for *values, tokens in zip(*(c.slice(start, 200) for c in batch.columns), strict=True):
                    page = Outline(values)
                    if last != page.host:
                        last, template = page.host, frozenset(map(unsigned, tokens.as_py()))
                    inner, token = page.slots(template), page.e_token.tolist()
                    found: dict[int, list] = {}
                    for k in range(1, len(token)):
                        if inner[k] == k:
                            found.setdefault(token[k], [token[inner[page.parent[k]]], 0, 0, []])
                    for b in np.flatnonzero(~page.b_aside).tolist():
                        if (k := inner[page.b_element[b]]) and int(page.b_token[b]) not in template:
                            slot = found[token[k]]
                            slot[1:] = slot[1] + int(page.b_chars[b]), slot[2] + int(page.b_links[b]), [*slot[3][-1:], _digest((slot[3], int(page.b_text[b])))]
                    most = max((x[1] - x[2] for x in found.values()), default=0)
                    out += [(last, t - (t >> 63 << 64), o - (o >> 63 << 64), n, links, fill[-1] if fill else 0, most > 0 and n - links == most) for t, (o, n, links, fill) in found.items()]
                kinds = (pa.string(), *[pa.int64()] * 5, pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(len(names))], names)

    return rows.select(*PARSED_NAMES, "template").mapInArrow(walk, "host string, slot long, outer long, chars long, links long, fill long, won boolean")


def articles(slots: DataFrame) -> DataFrame:
    """host, mains: the containers of the host's articles by the pages they won, each with its parts."""
    facts = slots.groupBy("host", "slot").agg(
        F.min("outer").alias("outer"), F.count("*").alias("pages"), F.count_if("won").alias("won"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.count_if(F.col("chars") > 0).alias("filled"),
        F.approx_count_distinct(F.when(F.col("chars") > 0, F.col("fill")), 0.02).alias("fills"),
    )

    def choose(table: pa.Table) -> pa.Table:
        """A host has no more containers than ten pages: each is on a tenth of its pages."""
        of = {r["slot"]: r for r in table.to_pylist()}
        plain = lambda r: (r["chars"] - r["links"]) / max(1, r["filled"])
        prose = lambda r, beside: r["filled"] and plain(r) >= PART_TEXT * plain(beside) and r["links"] <= PART_LINKS * r["chars"] and r["fills"] >= PART_FILLS * r["filled"]

        def around(slot: int) -> Iterator[int]:
            while (slot := of[slot]["outer"]) in of:
                yield slot

        mains: list[dict] = []
        for slot in sorted((s for s in of if of[s]["won"]), key=lambda s: (-of[s]["won"], -of[s]["chars"], s)):
            main = next((s for s in reversed(list(around(slot))) if prose(of[s], of[slot])), slot)  # a container of as much text holds it
            if any(main == m["main"] or main in m["parts"] for m in mains):
                continue
            parts = [s for s in of if s != main and of[s]["outer"] == of[main]["outer"] and prose(of[s], of[slot])]
            mains.append({"main": main, "parts": sorted(parts)})
        return pa.table({"host": table["host"][:1], "mains": pa.array([mains], pa.list_(pa.struct([("main", pa.int64()), ("parts", pa.list_(pa.int64()))])))})

    return facts.groupBy("host").applyInArrow(choose, "host string, mains array<struct<main:bigint,parts:array<bigint>>>")


def _with(rows: DataFrame, found: DataFrame, columns: list[str], how: str, most: int) -> DataFrame:
    """rows, with their host's columns of found: by a broadcast while the arrays have up to `most` tokens, by a shuffle beyond that."""
    sizes = {"classes": lambda: F.aggregate("classes", F.lit(0), lambda n, c: n + F.size(c["tokens"]))}
    few = (found.agg(F.sum(sum((sizes.get(c, lambda c=c: F.size(c))() for c in columns), F.lit(0)))).first()[0] or 0) <= most
    return rows.join(F.broadcast(found) if few else found, "host", how)


def templates(pages: DataFrame, *, broadcast_tokens: int = 500_000) -> DataFrame:
    """host, template: the tokens of the classes that nearly all of the host's pages have, and of those of its layouts."""
    pages = parsed(pages)
    found = written(classes(pages), "classes")
    kept = found.where("shared")
    rarer = found.where("NOT shared").where(F.exists("tokens", lambda x: x.bitwiseAND(F.lit(1)) == 1))
    if rarer.limit(1).count():
        asked = found.join(rarer.select("host").distinct(), "host", "left_semi").groupBy("host").agg(F.collect_list(F.struct("id", "tokens", "shared")).alias("classes"))
        places = written(class_places(_with(pages, written(asked, "asked"), ["classes"], "inner", broadcast_tokens)), "on_pages")
        kept = kept.unionByName(rarer.join(layouts(places), ["host", "id"], "left_semi"))
    # a layout of markup alone needs no place: its containers nest as elements do
    markup = found.where("NOT shared").where(~F.exists("tokens", lambda x: x.bitwiseAND(F.lit(1)) == 1))
    return kept.unionByName(markup).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("template"))


def _hosted(pages: DataFrame) -> DataFrame:
    return pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))


def unsigned(x: int) -> int:
    return x & 0xFFFFFFFFFFFFFFFF


def extract(pages: DataFrame, *, broadcast_tokens: int = 500_000) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, text (blocks in order, joined by a line end), n_chars.

    A null or empty html has an empty text; pages without a host, or of hosts with fewer than LEAST_PAGES pages, have no template, so
    markup alone tells their article. Text of many pages of a host is only taken for the site's if it shares the occurrences of
    LEAST_TOKENS tokens; within the article it stays but in boxes of its own and frames (without_site). Repeated rows are pages of their own; other columns of pages don't matter. Templates are broadcast up to
    `broadcast_tokens` tokens, joined by a shuffle beyond that.
    """
    hosted = parsed(pages.where(host_of(F.col("url").cast("string")) != ""))
    found = written(templates(hosted, broadcast_tokens=broadcast_tokens), "templates")
    plan = found.withColumn("mains", F.lit(None).cast("array<struct<main:bigint,parts:array<bigint>>>"))
    if found.limit(1).count():
        chosen = articles(page_slots(_with(hosted, found, ["template"], "inner", broadcast_tokens)))
        plan = written(found.join(chosen, "host", "left"), "plans")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = _with(rows.withColumn("host", host_of(F.col("url"))), plan, ["template"], "left", broadcast_tokens).select("page_id", "url", "html", "host", "template", "mains")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, plan = None, (frozenset(), ())
        for batch in batches:
            texts = []
            for source, at, tokens, mains in zip(*(batch.column(k) for k in range(2, 6)), strict=True):
                if last != (now := at.as_py()):
                    last = now
                    regions = [(unsigned(m["main"]), frozenset(map(unsigned, m["parts"]))) for m in mains.as_py() or ()]
                    plan = frozenset(map(unsigned, tokens.as_py() or ())), regions
                texts.append(Page(source.as_py() or "").text(*plan))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
