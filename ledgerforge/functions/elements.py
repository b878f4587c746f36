"""Elements of pages: those of asked classes, properties or tags, with what they lie in, and items of microdata by their scopes.

One pass over a page with a stack of open elements gives an array of the elements that are asked for; what they mean is told by column
expressions over that array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.functions.slices import sliced
from ledgerforge.functions.text import blank_to_null

#: what: '.class', '@property', 'tag', or '@@' for an item; at, until: the places of its start and end; scope: the place of the item around
#: it, 0 for none; parts: its texts in order, trimmed.
_TEXT = T.StringType()
ELEMENT = T.StructType().add("what", _TEXT).add("at", T.IntegerType()).add("until", T.IntegerType()).add("scope", T.IntegerType()).add("kind", _TEXT).add("parts", T.ArrayType(_TEXT)).add("attributes", T.MapType(_TEXT, _TEXT))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))


class _Reader(HTMLParser):
    def __init__(self, wanted: frozenset[str]):
        super().__init__()
        self.wanted, self.place, self.found, self.texts = wanted, 0, [], []
        self.open: list[tuple[str, int, int, list[dict]]] = []  # tag, place, item around or of its own, records
        self.items = any(w[0] == "@" for w in wanted)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.place += 1
        known = {k: v or "" for k, v in attrs}
        scope = self.open[-1][2] if self.open else 0
        item = self.items and ("itemscope" in known or "itemtype" in known)
        names = [tag, *(f".{c}" for c in known.get("class", "").split()), *(f"@{p}" for p in known.get("itemprop", "").split())]
        records = [self._record(w, scope, known) for w in dict.fromkeys(names) if w in self.wanted] + [self._record("@@", scope, known)] * item
        self.found += records
        if tag in _VOID:
            self._end(records)
        else:
            self.open.append((tag, self.place, self.place if item else scope, records))

    def _record(self, what: str, scope: int, known: dict[str, str]) -> dict:
        return {"what": what, "at": self.place, "until": 0, "scope": scope, "kind": known.get("itemtype"), "parts": len(self.texts), "attributes": known}

    def _end(self, records: list[dict]) -> None:
        for r in records:
            if not r["until"]:
                # an item's texts are its properties'
                r["until"], r["parts"] = self.place, [] if r["what"] == "@@" else self.texts[r["parts"] :]

    def handle_endtag(self, tag: str) -> None:
        if any(o[0] == tag for o in self.open):
            while True:
                name, _, _, records = self.open.pop()
                self._end(records)
                if name == tag:
                    return

    def handle_data(self, data: str) -> None:
        text = " ".join(data.split())
        if text and not any(o[0] in ("script", "style") for o in self.open[-1:]):
            self.texts.append(text)

    def result(self) -> list[dict]:
        while self.open:
            self._end(self.open.pop()[3])
        return self.found


def elements(*wanted: str) -> Callable[[Column], Column]:
    """A function of a column of pages: the array of ELEMENTs that are wanted, in order; null pages have none."""
    names = frozenset(wanted)

    @F.pandas_udf(T.ArrayType(ELEMENT))
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(page: str | None) -> list[dict]:
            reader = _Reader(names)
            reader.feed(page or "")
            reader.close()
            return reader.result()

        for pages in sliced(batches):
            yield pages.map(one)

    return read


def those(found: Column, what: str) -> Column:
    return F.filter(found, lambda e: e["what"] == what)


def inside(found: Column, outer: Column) -> Column:
    """Of the elements those within the outer one."""
    return F.filter(found, lambda e: (e["at"] > outer["at"]) & (e["at"] <= outer["until"]))


def first(found: Column, what: str) -> Column:
    """The first element of that name; null if there is none."""
    return F.try_element_at(those(found, what), F.lit(1))


def text(element: Column) -> Column:
    """An element's text, a space between its parts; null if it has none."""
    return blank_to_null(F.array_join(element["parts"], " "))


def attribute(element: Column, name: str) -> Column:
    return blank_to_null(F.try_element_at(element["attributes"], F.lit(name)))


def labelled(parts: Column, *labels: str) -> Column:
    """What follows a label and a colon in the first text that has it, up to the next colon; labels in lower case."""
    pairs = F.flatten(F.transform(parts, lambda t: _pairs(F.split(t, "[:：]"))))
    ends = lambda name: F.array_contains(F.array(*map(F.lit, labels)), name) | F.exists(F.array(*map(F.lit, labels)), lambda x: F.endswith(name, F.concat(F.lit(" "), x)))
    hit = F.filter(pairs, lambda p: ends(F.lower(F.trim(p["name"]))))
    return blank_to_null(F.try_element_at(hit, F.lit(1))["value"])


def _pairs(pieces: Column) -> Column:
    return F.zip_with(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), F.slice(pieces, 2, F.size(pieces)), lambda a, b: F.struct(a.alias("name"), b.alias("value")))


_GTINS = ("gtin13", "gtin", "gtin12", "gtin14", "gtin8")
_FIELDS = ["name", "sku", "mpn", "gtin", "brand", "price", "currency", "availability", "image"]
_PRODUCT = frozenset(f"@{p}" for p in ("name", "sku", "mpn", *_GTINS, "brand", "price", "priceCurrency", "availability", "image"))


def _value(element: dict | None) -> str | None:
    """A property's value: its content, else what it links to, else its text."""
    if element is None:
        return None
    known = element["attributes"]
    found = next((known[k] for k in ("content", "href", "src") if known.get(k, "").strip()), " ".join(element["parts"]))
    return found.strip() or None


@F.pandas_udf(T.StructType([T.StructField(f, _TEXT) for f in _FIELDS]))
def product(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Of each page's first item that is a Product; all null without one.

    A property is the item's own: what belongs to an inner item (a brand's name, a review's) isn't. A brand that is an item is known by its
    name; price, currency and availability may be those of an item within, an offer.
    """

    def one(page: str | None) -> dict:
        reader = _Reader(_PRODUCT)
        reader.feed(page or "")
        reader.close()
        found = reader.result()
        item = next((e for e in found if e["what"] == "@@" and (e["kind"] or "").lower().rstrip("/").endswith("schema.org/product")), None)
        if item is None:
            return dict.fromkeys(_FIELDS)
        own = lambda name, at=item["at"]: next((e for e in found if e["what"] == f"@{name}" and e["scope"] == at), None)
        below = lambda name: _value(next((e for e in found if e["what"] == f"@{name}" and item["at"] < e["at"] <= item["until"]), None))
        brand = own("brand")
        out = {k: _value(own(k)) for k in ("name", "sku", "mpn", "image")} | {"gtin": next((v for g in _GTINS if (v := _value(own(g)))), None)}
        out["brand"] = brand and (_value(own("name", brand["at"])) or _value(brand))
        return out | {"price": below("price"), "currency": below("priceCurrency"), "availability": below("availability")}

    for pages in sliced(batches):
        yield pd.DataFrame([one(p) for p in pages], columns=_FIELDS)
