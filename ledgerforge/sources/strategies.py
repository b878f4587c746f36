"""Payloads of the source platforms to observations, and the registry of strategies.

A strategy takes rows of captured payloads (body, and what else its platform needs) and returns observations: key, manufacturer, name,
sku, ean, url, image, price, availability, hints. Fetching is somebody else's work; what to fetch is operators.ledger's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions import elements, extract
from ledgerforge.functions.barcode import normalize_ean, retail_ean
from ledgerforge.functions.text import blank_to_null, plain_text, url_path
from ledgerforge.operators.enrich import ranked
from ledgerforge.sources.shared import at_most, written

Strategy = Callable[..., DataFrame]
STRATEGIES: dict[str, Strategy] = {}
#: Whether a run sees all that its source has: 'full', 'partial', or 'complete' if it fetched everything it had to.
SWEEPS: dict[str, str] = {}


def strategy(name: str, sweep: str = "complete") -> Callable[[Strategy], Strategy]:
    def add(f: Strategy) -> Strategy:
        if name in STRATEGIES:
            raise ValueError(f"two strategies are called {name}")
        STRATEGIES[name], SWEEPS[name] = f, sweep
        return f

    return add


def _items(rows: DataFrame, path: str, schema: str) -> DataFrame:
    """One row per item of the JSON array at a path, in order of arrival (`seq`: by `place` if rows have it), with the payload's other columns."""
    found = F.try_variant_get(F.try_parse_json("body"), path, f"array<struct<{schema}>>")
    return rows.withColumn("__n", F.col("place").cast("long") if "place" in rows.columns else F.monotonically_increasing_id()).select("*", F.posexplode(F.coalesce(found, F.array().cast(f"array<struct<{schema}>>"))).alias("__p", "i")).withColumn("seq", F.struct("__n", "__p"))


def observation(source: str, key: Column, **fields: Column) -> list[Column]:
    kinds = {"manufacturer": "string", "name": "string", "sku": "string", "ean": "string", "url": "string", "image": "string", "price": "double", "availability": "string", "hints": "map<string,string>"}
    archived = F.coalesce(fields.get("archived", F.lit(None)).cast("boolean"), F.lit(False)).alias("archived")
    own = {k: fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()}
    return [F.concat_ws(":", F.lit(source), key.cast("string")).alias("key"), *own.values(), archived]


def once(rows: DataFrame) -> DataFrame:
    """The first arrival of each key."""
    return ranked(rows, ["key"], [F.col("seq")]).drop("seq")


def attributed(rows: DataFrame, vendor: str, vendors: list[str] | None, manufacturers: DataFrame | None) -> DataFrame:
    """Rows of the allowed vendors (all without a list) whose vendor is a known manufacturer's (vendor, slug), with `manufacturer`."""
    if vendors is not None:
        rows = rows.where(F.coalesce(F.col(vendor), F.lit("")).isin(vendors))
    if manufacturers is None:
        return rows.withColumn("manufacturer", F.lit(None).cast("string"))
    names = manufacturers.select(F.lower("vendor").alias("__v"), F.col("slug").alias("manufacturer")).distinct()
    return rows.join(names, F.lower(vendor) == names["__v"]).drop("__v")


def detailed(rows: DataFrame, key: str, details: DataFrame | None) -> DataFrame:
    """Rows with `known`: the barcode that earlier details (key, ean) found for their key."""
    if details is None:
        return rows.withColumn("known", F.lit(None).cast("string"))
    return rows.join(details.select(F.col("key").alias("__k"), F.col("ean").alias("known")), F.col(key).cast("string") == F.col("__k"), "left").drop("__k")


@strategy("shopify")
def shopify(rows: DataFrame, source: str, *, vendors: list[str] | None = None, manufacturers: DataFrame | None = None, details: DataFrame | None = None) -> DataFrame:
    """Of the vendors in scope, attributed to their manufacturers; a barcode comes from the listing, else from earlier details (key, ean)."""
    i = _items(rows, "$.products", "handle:string,title:string,vendor:string,product_type:string,tags:array<string>,variants:array<struct<sku:string,barcode:string,price:string,available:boolean>>")
    i = detailed(attributed(i.withColumn("vendor", F.col("i.vendor")), "vendor", vendors, manufacturers), "i.handle", details)
    first = F.try_element_at("i.variants", F.lit(1))
    hints = F.map_filter(F.create_map(F.lit("productType"), F.col("i.product_type"), F.lit("vendor"), F.col("i.vendor")), lambda k, v: v.isNotNull())
    flags = F.transform(F.coalesce("i.variants", F.array()), lambda v: F.coalesce(v["available"], F.lit(False)))
    ean = F.coalesce(normalize_ean(first["barcode"]), normalize_ean(F.col("known")))
    return once(i.select(*observation(source, F.col("i.handle"), manufacturer=F.col("manufacturer"), name=F.col("i.title"), sku=first["sku"], ean=ean, price=extract.price_text(first["price"]), availability=extract.any_available(flags), hints=hints), "seq"))


@strategy("woo-store-api")
def woo(rows: DataFrame, source: str, *, manufacturer: str | None = None, details: DataFrame | None = None) -> DataFrame:
    """details (key, ean): the barcodes that product pages said, as extract.ld_product reads them."""
    i = _items(rows, "$", "id:bigint,name:string,sku:string,permalink:string,prices:struct<price:string,currency_minor_unit:int>,is_in_stock:boolean,categories:array<struct<slug:string>>")
    i = detailed(i, "i.id", details)
    hints = F.create_map(F.lit("category"), F.array_join(F.array_sort("i.categories.slug"), ","))
    return once(i.select(*observation(source, F.col("i.id"), manufacturer=F.lit(manufacturer), name=plain_text(F.col("i.name")), sku=blank_to_null(F.col("i.sku")), ean=normalize_ean(F.col("known")), url=F.col("i.permalink"), price=extract.price_minor(F.col("i.prices.price"), F.col("i.prices.currency_minor_unit")), availability=extract.any_available(F.array("i.is_in_stock")), hints=hints), "seq"))


@strategy("algolia", "full")
def algolia(rows: DataFrame, source: str) -> DataFrame:
    """Slices overlap: the first slice that has an object counts. The SKU is what follows the id's last dash."""
    i = _items(rows, "$.hits", "objectID:string,name:string,slug:string,price:double,gameHierarchy:string")
    hints = F.create_map(F.lit("faction"), extract.hierarchy_term(F.col("i.gameHierarchy"), []))
    sku = F.nullif(F.regexp_extract("i.objectID", "^.+-([^-]+)$", 1), F.lit(""))
    return once(i.select(*observation(source, F.col("i.objectID"), name=F.col("i.name"), sku=sku, url=F.col("i.slug"), price=F.col("i.price"), hints=hints), "seq"))


def capped_slices(rows: DataFrame) -> DataFrame:
    """slice, hits, pages of slices (slice, body) that say they have more hits than their pages gave: a platform's cap cut them off."""
    v = F.try_parse_json("body")
    n = F.coalesce(F.size(F.try_variant_get(v, "$.hits", "array<variant>")), F.lit(0))
    each = rows.select("slice", F.try_variant_get(v, "$.nbHits", "bigint").alias("hits"), F.try_variant_get(v, "$.nbPages", "bigint").alias("pages"), n.alias("n"))
    return each.groupBy("slice").agg(F.max("hits").alias("hits"), F.max("pages").alias("pages"), F.sum("n").alias("given")).where("hits > given").select("slice", "hits", "pages")


@strategy("appsync", "full")
def appsync(rows: DataFrame, source: str, *, factions: list[str] | None = None) -> DataFrame:
    """factions: the names that search texts, else the product's name, may say; the first said is its faction."""
    i = _items(rows, "$.data.products.products", "id:string,name:string,sku:string,inventory:int,preorder:boolean,seo:array<string>")
    state = F.when(F.col("i.preorder"), "pre_order").when(F.col("i.inventory") > 0, "in_stock").otherwise("out_of_stock")
    return once(i.select(*observation(source, F.col("i.id"), name=F.col("i.name"), sku=F.col("i.sku"), availability=state, hints=F.map_filter(F.create_map(F.lit("seo"), F.array_join("i.seo", ","), F.lit("faction"), extract.seo_term(F.col("i.seo"), F.col("i.name"), factions or [])), lambda k, v: v.isNotNull())), "seq"))


@strategy("reaper", "full")
def reaper(rows: DataFrame, source: str) -> DataFrame:
    """The page embeds an array; prices are in cents, the main image comes first. Of a set's parts the paints are its contents."""
    body = rows.withColumn("body", F.regexp_extract("body", r"(?s)products\s*=\s*(\[.*?\]);", 1))
    i = _items(body, "$", "sku:string,name:string,price:int,images:array<struct<type:string,`order`:int,url:string>>,associatedProducts:array<struct<sku:string,material:string>>")
    paints = F.filter(F.coalesce("i.associatedProducts", F.array().cast("array<struct<sku:string,material:string>>")), lambda x: (F.lower(x["material"]) == "paint") & x["sku"].isNotNull())
    contents = F.array_join(F.array_sort(F.array_distinct(F.transform(paints, lambda x: x["sku"]))), ",")
    hints = F.map_filter(F.create_map(F.lit("image"), extract.main_image(F.col("i.images")), F.lit("contents"), F.nullif(contents, F.lit(""))), lambda k, v: (k == "image") | v.isNotNull())
    return once(i.select(*observation(source, F.col("i.sku"), name=F.col("i.name"), sku=F.col("i.sku"), price=F.col("i.price") / 100.0, hints=hints), "seq"))


@strategy("wp-rest-paints", "full")
def wp_rest(rows: DataFrame, source: str, *, terms: DataFrame | None = None, media: DataFrame | None = None, paint_terms: list[str] | None = None) -> DataFrame:
    """Posts, with the names of their terms (terms: id, name) and the image of their featured medium (media: id, url), as far as they are known.

    paint_terms, where given, are the terms of paint sets: posts with none of them are no paints. Terms and media that a source doesn't
    list are left out; `missing_media` says which to ask for.
    """
    i = once(_items(rows, "$", WP_POST).select(F.col("i.id").cast("string").alias("key"), "i", "seq"))
    if terms is not None:
        named = i.select("key", F.posexplode(F.coalesce("i.categories", F.array().cast("array<bigint>"))).alias("at", "id")).join(terms.select("id", F.col("name").alias("term")).dropDuplicates(["id"]), "id")
        named = named.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "term"))), lambda x: x["term"]).alias("terms"))
        i = i.join(named, "key", "left")
    else:
        i = i.withColumn("terms", F.lit(None).cast("array<string>"))
    if paint_terms is not None:
        i = i.where(F.arrays_overlap("terms", F.array(*map(F.lit, paint_terms))))
    seen = media.select(F.col("id").alias("__m"), F.col("url").alias("image")).dropDuplicates(["__m"]) if media is not None else None
    i = i.join(seen, F.col("i.featured_media") == F.col("__m"), "left") if seen is not None else i.withColumn("image", F.lit(None).cast("string"))
    code = F.nullif(F.regexp_extract("i.slug", r"(\d{2}-?\d{3})$", 1), F.lit(""))
    hints = F.map_filter(F.create_map(F.lit("terms"), F.when(F.size("terms") > 0, F.array_join("terms", ","))), lambda k, v: v.isNotNull())
    return i.select(*observation(source, F.col("key"), name=plain_text(F.col("i.title.rendered")), sku=code, image=F.col("image"), hints=hints))


WP_POST = "id:bigint,slug:string,title:struct<rendered:string>,categories:array<bigint>,featured_media:bigint"


def missing_media(rows: DataFrame, media: DataFrame) -> DataFrame:
    """id: the featured media of posts that aren't known yet, each once."""
    asked = _items(rows, "$", WP_POST).select(F.col("i.featured_media").alias("id")).where("id > 0").distinct()
    return asked.join(media.select("id"), "id", "left_anti")


def sitemap_urls(rows: DataFrame, pattern: str) -> DataFrame:
    """url: the locations in sitemaps (body), whatever their namespace, that match."""
    urls = F.xpath("body", F.lit("//*[local-name()='loc']/text()"))
    return rows.select(F.explode(urls).alias("url")).withColumn("url", F.trim("url")).where(F.col("url").rlike(pattern)).distinct()


#: Where a page's fields may come from, the most trusted first.
ORIGINS = ("jsonld", "microdata", "embedded", "heading")


def page_fields(rows: DataFrame) -> DataFrame:
    """Rows of pages (body) with name, sku, ean, brand, and `origins`: which of ORIGINS gave each field.

    Each field is the first value that an origin has, so a page's fields may be of several. Barcodes count if they are valid. The heading
    gives names alone, and only to pages that say something else of a product. An embedded object has no names.
    """
    rows = rows.withColumns({"__ld": extract.ld_product(F.col("body")), "__micro": elements.product("body"), "__own": F.try_parse_json(extract.embedded_object("body")), "__shown": extract.page_name(F.col("body"))})
    own = lambda k: blank_to_null(F.try_variant_get("__own", f"$.product_attributes.{k}", "string"))
    none = F.lit(None).cast("string")
    said = {
        "name": (F.col("__ld.name"), F.col("__micro.name"), none), "sku": (F.col("__ld.sku"), F.col("__micro.sku"), own("sku")),
        "ean": (normalize_ean(F.col("__ld.gtin")), normalize_ean(F.col("__micro.gtin")), normalize_ean(own("upc"))), "brand": (F.col("__ld.brand"), F.col("__micro.brand"), none),
    }
    first = {f: F.try_element_at(F.filter(F.array(*(F.struct(v.alias("value"), F.lit(o).alias("origin")) for o, v in zip(ORIGINS, values, strict=False))), lambda x: x["value"].isNotNull()), F.lit(1)) for f, values in said.items()}
    rows = rows.withColumns({f"__{f}": x for f, x in first.items()})
    heading = F.when(F.coalesce(F.col("__sku.value"), F.col("__ean.value"), F.col("__brand.value")).isNotNull(), F.col("__shown"))
    name = F.coalesce("__name", F.when(heading.isNotNull(), F.struct(heading.alias("value"), F.lit(ORIGINS[3]).alias("origin"))))
    rows = rows.withColumn("__name", name)
    origins = F.map_filter(F.create_map(*(x for f in said for x in (F.lit(f), F.col(f"__{f}.origin")))), lambda k, v: v.isNotNull())
    out = rows.withColumns({**{f: F.col(f"__{f}.value") for f in said}, "origins": origins})
    return out.drop("__ld", "__micro", "__own", "__shown", *(f"__{f}" for f in said))


@strategy("sitemap-structured-data")
def structured_pages(rows: DataFrame, source: str) -> DataFrame:
    """Product pages (url, body; one row a url): page_fields of those that name a product; which origin gave the barcode is kept."""
    rows = page_fields(ranked(rows, ["url"], [F.col("body")])).where("name IS NOT NULL")
    hints = F.map_filter(F.create_map(F.lit("eanFrom"), F.try_element_at("origins", F.lit("ean")), F.lit("brand"), F.col("brand")), lambda k, v: v.isNotNull())
    return rows.select(*observation(source, url_path(F.col("url")), name=F.col("name"), sku=F.col("sku"), ean=F.col("ean"), url=F.col("url"), hints=hints))


@strategy("cdx-archive", "partial")
def latest_captures(rows: DataFrame, source: str, *, include: str = "", snapshots: DataFrame | None = None) -> DataFrame:
    """Of (original, timestamp, status), the latest good capture of each path that matches; the first of equal times. All are archived:
    they tell what there was, and never that it is listed.

    snapshots (original, timestamp, body), where given, are read as old shop pages: their name, number and price; captures without a
    snapshot that names a product are then left for a later run.
    """
    good = rows.where("status = '200'").withColumn("path", url_path(F.col("original"))).where(F.col("path").rlike(include))
    last = ranked(good, ["path"], [F.desc("timestamp"), F.col("original")])
    hints = F.create_map(F.lit("archiveTimestamp"), F.col("timestamp"))
    if snapshots is None:
        return last.select(*observation(source, F.col("path"), url=F.col("original"), hints=hints, archived=F.lit(True)))
    pages = snapshots.groupBy("original", "timestamp").agg(F.max("body").alias("body"))
    read = last.join(pages, ["original", "timestamp"]).withColumn("page", extract.legacy_page(F.col("body"))).where("page.name IS NOT NULL")
    return read.select(*observation(source, F.col("path"), name=F.col("page.name"), sku=F.col("page.sku"), price=F.col("page.price"), url=F.col("original"), hints=hints, archived=F.lit(True)))


# What a sheet's columns are called, in lower case.
SHEET_COLUMNS = {"code": ("product code", "code", "ssc"), "name": ("description", "product", "name"), "barcode": ("barcode", "ean", "upc"), "price": ("price", "rrp", "gbp rrp"), "release": ("release date", "launch date")}


def sheet_rows(cells: DataFrame) -> DataFrame:
    """seq, role, code, name, barcode, price, release of sheets' rows (sheet, role, line, cells): the header of a sheet is its first line
    that names a code and a name; what stands above it, and lines without a code, are none."""
    folded = F.transform("cells", lambda c: F.lower(F.trim(c)))
    at = {k: F.array_max(F.transform(F.array(*map(F.lit, names)), lambda n: F.array_position("__h", n))) for k, names in SHEET_COLUMNS.items()}
    heads = cells.withColumn("__h", folded).where(F.arrays_overlap("__h", F.array(*map(F.lit, SHEET_COLUMNS["code"]))) & F.arrays_overlap("__h", F.array(*map(F.lit, SHEET_COLUMNS["name"]))))
    heads = heads.groupBy("sheet").agg(F.min_by(F.struct(F.col("line").alias("__from"), "__h"), "line").alias("x")).select("sheet", "x.*")
    # columns are found once a sheet; few sheets go to the rows, whose shuffle would put each sheet into one task
    heads = written(heads.select("sheet", "__from", F.struct(*(p.alias(k) for k, p in at.items())).alias("__at")), "heads")
    each = cells.join(F.broadcast(heads) if at_most(heads, 100_000) else heads, "sheet").where(F.col("line") > F.col("__from"))
    at = {k: F.col(f"__at.{k}") for k in at}
    fields = [F.when(p > 0, blank_to_null(F.try_element_at("cells", p.cast("int")))).alias(k) for k, p in at.items()]
    return each.select(F.struct("sheet", "line").alias("seq"), "role", *fields).where("code IS NOT NULL")


def workbooks(assets: DataFrame, patterns: list[str], suffixes: tuple[str, ...] = (".xlsx", ".xlsm")) -> DataFrame:
    """url, name of the assets to read, in the order of their URLs: listed by whatever countries (country, url, name), each once; those whose
    name, else the URL's last part, is a workbook's and matches a pattern, in any case."""
    first = assets.where("url <> ''").groupBy("url").agg(F.min_by("name", F.struct("country", F.coalesce("name", F.lit("")))).alias("name"))
    named = first.withColumn("name", F.coalesce(blank_to_null(F.col("name")), F.substring_index("url", "/", -1)))
    fits = F.lit(False)
    for p in patterns:
        fits = fits | F.col("name").rlike(f"(?i){p}")
    readable = F.lit(False)
    for s in suffixes:
        readable = readable | F.endswith(F.lower("name"), F.lit(s))
    return named.where(readable & fits).orderBy("url").select("url", "name")


@strategy("trade-sheets", "partial")
def trade_sheets(rows: DataFrame, source: str, *, prefixes: list[str] | None = None, run_date: str | None = None) -> DataFrame:
    """Sheet rows (seq, role, code, name, barcode, price, and release, if known): the first value of each field in scan order; withdrawn
    and not current is gone.

    prefixes, where given, are those of retail barcodes; other numbers are none. Rows to be released after run_date don't count yet.
    """
    if run_date is not None and "release" in rows.columns:
        rows = rows.where(~extract.future(F.col("release"), F.lit(run_date).cast("date")))
    first = lambda c: F.expr(f"min_by({c}, seq) FILTER (WHERE {c} IS NOT NULL)")
    barcode = normalize_ean(F.col("barcode")) if prefixes is None else retail_ean(F.col("barcode"), prefixes)
    own = rows.withColumn("barcode", barcode).groupBy("code").agg(first("name").alias("name"), first("barcode").alias("barcode"), first("price").alias("price"), (F.bool_or(F.col("role") == "withdrawn") & ~F.bool_or(F.col("role") == "current")).alias("gone"))
    return own.select(*observation(source, F.col("code"), name=F.col("name"), sku=F.col("code"), ean=F.col("barcode"), price=extract.price_text(F.col("price")), hints=F.create_map(F.lit("status"), F.when(F.col("gone"), "discontinued").otherwise("current"))))


@strategy("barcode-db", "partial")
def barcode_lookups(rows: DataFrame, source: str) -> DataFrame:
    """Answers (ean, title, brand, names) about a manufacturer's barcodes: only those whose title or brand says one of its names."""
    said = F.lower(F.concat_ws(" ", "title", "brand"))
    sane = ranked(rows.where(F.exists("names", lambda n: F.contains(said, F.lower(n)))), ["ean"], [F.col("title"), F.col("brand")])
    return sane.select(*observation(source, F.col("ean"), name=F.col("title"), ean=normalize_ean(F.col("ean"))))


def lookup_queue(entities: DataFrame, asked: DataFrame, run_date: str, *, budget: int | None = None, again_after: int = 90) -> DataFrame:
    """ean: the barcodes to look up, those of provisional entities (entity, ean, confidence) that nobody confirmed, never asked ones first.

    asked (ean, date): what was looked up before; it is asked again after so many days, the longest ago first. A budget cuts the queue.
    """
    last = asked.groupBy("ean").agg(F.max("date").alias("date"))
    open_ = entities.where("confidence = 'provisional' AND ean IS NOT NULL").select("ean").distinct().join(last, "ean", "left")
    due = open_.where(F.col("date").isNull() | (F.date_diff(F.lit(run_date).cast("date"), "date") >= again_after))
    queue = due.orderBy(F.col("date").asc_nulls_first(), "ean").select("ean")
    return queue if budget is None else queue.limit(max(0, budget))
