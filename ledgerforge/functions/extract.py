"""Fields from pages and payloads: JSON-LD, microdata, embedded objects, titles, prices, volumes, availability."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerforge.functions.text import blank_to_null, plain_text

_LD = r'(?is)<script[^>]*type=["\']application/ld\+json["\'][^>]*>(.*?)</script>'
_GTINS = ("gtin13", "gtin", "gtin12", "gtin14", "gtin8")


def ld_products(html: Column) -> Column:
    """The product objects (variants) of all JSON-LD blocks: arrays and @graph unwrapped, @type a text or an array; broken blocks are skipped."""
    blocks = F.filter(F.transform(F.regexp_extract_all(html, F.lit(_LD), F.lit(1)), F.try_parse_json), lambda v: v.isNotNull())
    tops = F.flatten(F.transform(blocks, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    listed = F.transform(tops, lambda v: F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v)))
    one = lambda v: F.try_variant_get(v, "$['@type']", "string") == "Product"
    many = lambda v: F.array_contains(F.try_variant_get(v, "$['@type']", "array<string>"), "Product")
    return F.filter(F.flatten(listed), lambda v: F.coalesce(one(v), F.lit(False)) | F.coalesce(many(v), F.lit(False)))


def ld_product(html: Column) -> Column:
    """The first product with a name: struct(name, sku, brand, gtin); a gtin of its own comes before one of its offers."""
    named = F.filter(ld_products(html), lambda v: blank_to_null(F.try_variant_get(v, "$.name", "string")).isNotNull())
    # each field reads the product: a function's argument is found once, where an expression would read the page again for each of them
    fields = F.try_element_at(F.transform(F.slice(named, 1, 1), _ld_fields), F.lit(1))
    return F.coalesce(fields, F.struct(*(F.lit(None).cast("string").alias(c) for c in ("name", "sku", "brand", "gtin"))))


def _ld_fields(v: Column) -> Column:
    get = lambda path: blank_to_null(F.try_variant_get(v, path, "string"))
    numbers = lambda x: F.coalesce(*(blank_to_null(F.try_variant_get(x, f"$.{g}", "string")) for g in _GTINS))
    offers = F.coalesce(F.try_variant_get(v, "$.offers", "array<variant>"), F.array(F.try_variant_get(v, "$.offers", "variant")))
    offered = F.try_element_at(F.filter(F.transform(offers, numbers), lambda x: x.isNotNull()), F.lit(1))  # of the first offer that has one
    gtin = F.coalesce(numbers(v), offered)
    return F.struct(get("$.name").alias("name"), get("$.sku").alias("sku"), F.coalesce(get("$.brand.name"), get("$.brand")).alias("brand"), gtin.alias("gtin"))


def microdata(html: Column, prop: str) -> Column:
    """A property of a page that declares a Product: the content attribute before the element's text."""
    content = blank_to_null(F.regexp_extract(html, rf'(?is)itemprop=["\']{prop}["\'][^>]*?\bcontent=["\']([^"\']*)["\']', 1))
    inner = blank_to_null(F.regexp_extract(html, rf'(?is)itemprop=["\']{prop}["\'][^>]*>([^<]*)<', 1))
    return F.when(html.rlike(r'(?i)itemtype=["\'][^"\']*schema\.org/Product["\']'), F.coalesce(content, inner))


@F.pandas_udf(StringType())
def embedded_object(x: pd.Series) -> pd.Series:
    """The JSON object assigned to BCData in a page's script, as text; braces in strings don't end it."""

    def find(s: str | None) -> str | None:
        at = -1 if s is None else s.find("BCData")
        at = s.find("{", at) if at >= 0 else -1
        if at < 0:
            return None
        try:
            return json.dumps(json.JSONDecoder().raw_decode(s, at)[0])
        except ValueError:
            return None

    return x.map(find)


def heading(html: Column, references: dict[str, str] | None = None) -> Column:
    return plain_text(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), references)


def title(html: Column, references: dict[str, str] | None = None) -> Column:
    return plain_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), references)


def page_name(html: Column, references: dict[str, str] | None = None) -> Column:
    """The heading, else the title, without what follows a bar."""
    return blank_to_null(F.split_part(F.coalesce(heading(html, references), title(html, references)), F.lit("|"), F.lit(1)))


def price_minor(amount: Column, exponent: Column) -> Column:
    return F.try_divide(F.try_to_number(amount, F.lit("999999999999")).cast("double"), F.pow(F.lit(10.0), exponent))


def price_text(x: Column) -> Column:
    """A positive number without thousands separators, else null."""
    number = F.regexp_replace(x, "[,\\s£$€]", "").try_cast("double")
    return F.when(number > 0, number)


def volume_ml(*texts: Column) -> Column:
    """The first text that says so many ml."""
    return F.coalesce(*(F.nullif(F.regexp_extract(F.lower(t), r"(\d{1,4})\s*ml", 1), F.lit("")).cast("int") for t in texts))


def millilitres(text: Column) -> Column:
    """The first number that ml follows, decimals included; a comma is a point."""
    words = F.split(F.regexp_replace(F.lower(text), r"([0-9])\s*ml\b", "$1 ml"), r"[^\w.,]+")
    at = F.filter(F.sequence(F.lit(2), F.greatest(F.size(words), F.lit(2))), lambda k: (F.get(words, k - 1) == "ml") & F.replace(F.get(words, k - 2), F.lit(","), F.lit(".")).try_cast("double").isNotNull())
    return F.replace(F.get(words, F.try_element_at(at, F.lit(1)) - 2), F.lit(","), F.lit(".")).try_cast("double")


def snake(x: Column) -> Column:
    """The last part of a schema.org term, camel case to snake case."""
    return F.lower(F.regexp_replace(F.substring_index(x, "/", -1), r"(?<!^)(?=[A-Z])", "_"))


def hierarchy_term(path: Column, skip: list[str], default: str = "General") -> Column:
    """Of a '>'-separated path, the first part behind the root that isn't to be skipped."""
    parts = F.filter(F.transform(F.slice(F.split(path, ">"), F.lit(2), F.size(F.split(path, ">"))), lambda p: F.trim(p)), lambda p: ~p.isin(skip) & (p != ""))
    return F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(default))


def first_mapped(tags: Column, mapping: Column) -> Column:
    """What the first tag, in sorted order, that the map has is mapped to."""
    return F.try_element_at(mapping, F.try_element_at(F.filter(F.array_sort(tags), lambda t: F.map_contains_key(mapping, t)), F.lit(1)))


def main_image(images: Column) -> Column:
    """Of (type, order, url): a main one first, then by order."""
    return F.array_min(F.transform(images, lambda i: F.struct((i["type"] != "main").alias("rest"), i["order"], i["url"])))["url"]


def any_available(flags: Column) -> Column:
    return F.when(F.exists(flags, lambda x: x), F.lit("in_stock")).otherwise(F.lit("out_of_stock"))


def future(release: Column, run_date: Column) -> Column:
    """Whether a release date lies after the run; unknown or unreadable dates don't."""
    return F.coalesce(F.try_to_date(release, "yyyy-MM-dd") > run_date, F.lit(False))


def legacy_page(html: Column) -> Column:
    """Of an old shop page: struct(sku: its eleven-digit number, name: og:title, else title before its separator, price in pounds with raised pence)."""
    og = plain_text(F.regexp_extract(html, r'(?is)<meta[^>]*property=["\']og:title["\'][^>]*content=["\']([^"\']*)["\']', 1))
    name = blank_to_null(F.regexp_replace(F.coalesce(og, title(html)), r"\s(?:\||-|–|:)\s.*$", ""))
    sku = F.nullif(F.regexp_extract(html, r"\b(\d{11})\b", 1), F.lit(""))
    pounds, pence = (F.regexp_extract(html, r"(?is)£\s*(\d+)(?:\.(\d{2})|\s*<sup>\s*(\d{2}))?", k) for k in (1, 2))
    raised = F.regexp_extract(html, r"(?is)£\s*(\d+)(?:\.(\d{2})|\s*<sup>\s*(\d{2}))?", 3)
    price = F.concat(pounds, F.lit("."), F.coalesce(F.nullif(pence, F.lit("")), F.nullif(raised, F.lit("")), F.lit("00")))
    return F.struct(sku.alias("sku"), name.alias("name"), F.when(pounds != "", price.try_cast("double")).alias("price"))


def card_fields(card: Column) -> Column:
    """Of a listing's card: struct(hex, finish, set_name, volume_ml, packaging), synonyms in one form."""
    text = F.regexp_replace(card, "<[^>]+>", " ")
    said = F.lower(text)
    hexa = F.nullif(F.lower(F.regexp_extract(card, r"#([0-9A-Fa-f]{6})\b", 1)), F.lit(""))
    finish = F.when(said.rlike(r"\b(gloss|glossy)\b"), "Gloss").when(said.rlike(r"\b(satin|semi-?gloss)\b"), "Satin").when(said.rlike(r"\bmetal(lic)?\b"), "Metallic").when(said.rlike(r"\b(matt|matte|flat)\b"), "Matte")
    packaging = F.when(said.rlike(r"\b(spray|aerosol|can)\b"), "spray").when(said.rlike(r"\b(dropper|bottle)\b"), "dropper").when(said.rlike(r"\b(pot|jar)\b"), "pot")
    set_name = blank_to_null(F.regexp_extract(card, r"(?is)\bset\s*:\s*(?:<[^>]+>\s*)*([^<|]+)", 1))
    return F.struct(hexa.alias("hex"), finish.alias("finish"), set_name.alias("set_name"), volume_ml(text).alias("volume_ml"), packaging.alias("packaging"))


def after_colon(x: Column) -> Column:
    """What follows a title's last colon."""
    return F.trim(F.substring_index(x, ":", -1))


def bare_name(x: Column, prefix: str) -> Column:
    """A name without its brand's prefix, what stands in parentheses, volumes and pack words; capitals become words."""
    bare = F.regexp_replace(x, rf"(?i)^\s*{prefix}\s*[:-]?\s*", "")
    bare = F.regexp_replace(bare, r"\([^)]*\)", " ")
    bare = F.regexp_replace(bare, r"(?i)\b(\d+\s*ml|pack of \d+|single)\b", " ")
    bare = F.trim(F.regexp_replace(bare, r"\s+", " "))
    return F.array_join(F.transform(F.split(bare, " "), lambda w: F.when(w.rlike("^[A-Z]{2,}$"), F.initcap(w)).otherwise(w)), " ")


def single_item(sku: Column, name: Column, grams: Column, pattern: str, most: int) -> Column:
    """Whether a listing is one item: its SKU has the form, it isn't heavy, and its name isn't a set's."""
    return F.coalesce(sku.rlike(pattern) & (grams <= most) & ~F.lower(name).rlike(r"\b(set|bundle|collection|case)\b"), F.lit(False))


def seo_term(seo: Column, name: Column, candidates: list[str]) -> Column:
    """The first candidate that the first text says that says any, in any case; else the first that the name says; else null."""
    options = F.array(*map(F.lit, candidates)) if candidates else F.array().cast("array<string>")
    said = lambda x: F.try_element_at(F.filter(options, lambda c: F.contains(F.lower(x), F.lower(c))), F.lit(1))
    hits = F.filter(F.transform(F.coalesce(seo, F.array().cast("array<string>")), said), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(hits, F.lit(1)), said(name))
