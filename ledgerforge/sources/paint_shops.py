"""Payloads of paint sources: shops with collections or categories, category listings with detail pages, pages behind sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions import elements as E
from ledgerforge.functions import extract
from ledgerforge.functions.text import blank_to_null, digits, last_segment, name_key, plain_text, url_path
from ledgerforge.sources.strategies import _items, observation, strategy

# The classes with which the category shop marks its listing and detail pages, its labels, and its barcodes' first digits.
TILE, TILE_FIELDS = "products__item", {"code": "products__item-code", "text": "products__item-text", "tag": "products__item-tag"}
DETAIL, DETAIL_NAME = "detail-prodinfo__text-area", "common__square-title"
DETAIL_PATH, NUMBER_LABEL, VOLUME_LABELS, JAN_PREFIXES = "/products/detail/", "product number", ("net", "net amount"), ("45", "49")
DETAIL_IMAGE, NO_IMAGE, COVER = "js-thumb", "no-image", "js-qv-product-cover"

tile_elements = E.elements(f".{TILE}", *(f".{c}" for c in TILE_FIELDS.values()), "a", "img")
detail_elements = E.elements(f".{DETAIL}", f".{DETAIL_NAME}", f".{DETAIL_IMAGE}")
cover_elements = E.elements(f".{COVER}")


def _found(x: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def _hints(**fields: Column) -> Column:
    """A map of the fields that aren't null."""
    return F.map_filter(F.create_map(*(x for k, v in fields.items() for x in (F.lit(k), v.cast("string")))), lambda k, v: v.isNotNull())


def _joined(values: Column) -> Column:
    """Sorted and joined by commas; null if there are none."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ","))


@strategy("shopify-paints")
def shopify_paints(rows: DataFrame, source: str, *, manufacturers: DataFrame, vendors: list[str] | None = None, types: list[str] | None = None, details: DataFrame | None = None) -> DataFrame:
    """Pages of product listings (body, collection or null, place): products of known manufacturers (vendor, slug) and of the scope.

    Of a handle that collections repeat the first arrival counts, with all its collections; without collections the last. vendors and
    types limit the scope, where given. details (handle, ean) are the barcodes known so far.
    """
    i = _items(rows, "$.products", "handle:string,title:string,vendor:string,product_type:string,tags:array<string>,images:array<struct<src:string>>,variants:array<struct<sku:string,price:string,available:boolean>>")
    each = i.groupBy("i.handle").agg(F.min_by("i", "seq").alias("first"), F.max_by("i", "seq").alias("last"), F.collect_set("collection").alias("collections"))
    each = each.withColumn("i", F.when(F.size("collections") > 0, F.col("first")).otherwise(F.col("last")))
    if vendors is not None:
        each = each.where(F.coalesce("i.vendor", F.lit("")).isin(vendors))
    if types is not None:
        each = each.where(F.coalesce("i.product_type", F.lit("")).isin(types))
    named = manufacturers.select(F.lower("vendor").alias("__v"), F.col("slug").alias("__m")).distinct()
    each = each.join(named, F.lower("i.vendor") == named["__v"])
    known = details.select("handle", F.col("ean").alias("__e")) if details is not None else None
    each = each.join(known, "handle", "left") if known is not None else each.withColumn("__e", F.lit(None).cast("string"))
    first = F.try_element_at("i.variants", F.lit(1))
    flags = F.transform(F.coalesce("i.variants", F.array()), lambda v: F.coalesce(v["available"], F.lit(False)))
    hints = _hints(productType=blank_to_null(F.col("i.product_type")), vendor=F.col("i.vendor"), collections=_joined(F.col("collections")), tags=_joined(F.col("i.tags")))
    return each.select(*observation(source, F.col("handle"), manufacturer=F.col("__m"), name=F.col("i.title"), sku=blank_to_null(first["sku"]), ean=F.col("__e"), image=F.try_element_at("i.images", F.lit(1))["src"], price=extract.price_text(first["price"]), availability=extract.any_available(flags), hints=hints))


@strategy("woo-paints", "full")
def woo_paints(rows: DataFrame, source: str, *, manufacturer: str | None) -> DataFrame:
    """Pages of categories (body, place): of a product that categories repeat the last arrival counts. Without a manufacturer there are none."""
    i = _items(rows, "$", "id:bigint,name:string,sku:string,permalink:string,prices:struct<price:string,currency_minor_unit:int,currency_code:string>,is_in_stock:boolean,categories:array<struct<slug:string>>,images:array<struct<src:string>>")
    last = i.groupBy("i.id").agg(F.max_by("i", "seq").alias("i"))
    slugs = F.filter(F.coalesce("i.categories.slug", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    hints = _hints(category=F.lit("paint"), categorySlugs=_joined(slugs), currency=F.lower("i.prices.currency_code"))
    price = extract.price_minor(F.col("i.prices.price"), F.col("i.prices.currency_minor_unit"))
    out = last.select(*observation(source, F.col("id"), manufacturer=F.lit(manufacturer), name=plain_text(F.col("i.name")), sku=blank_to_null(F.col("i.sku")), url=F.col("i.permalink"), image=F.try_element_at("i.images", F.lit(1))["src"], price=price, availability=extract.any_available(F.array("i.is_in_stock")), hints=hints))
    return out if manufacturer else out.limit(0)


def numbered_urls(urls: DataFrame, include: str = "") -> DataFrame:
    """id, url, category of product URLs .../category/123-name.html that match: of an id that several have, the smallest URL."""
    steps = F.split(url_path(F.col("url")), "/")
    page, category = F.try_element_at(steps, F.lit(-1)), blank_to_null(F.try_element_at(steps, F.lit(-2)))
    number = F.split_part(page, F.lit("-"), F.lit(1))
    said = F.endswith(page, F.lit(".html")) & number.rlike("^[0-9]+$") & (F.length(page) > F.length(number) + F.length(F.lit("-.html")))
    parts = urls.where(F.col("url").rlike(include) & said & category.isNotNull()).select("url", category.alias("category"), number.alias("id"))
    return parts.groupBy("id").agg(F.min(F.struct("url", "category")).alias("x")).select("id", "x.*")


def plain_number(x: Column) -> Column:
    """A number as text, without a fraction of zeros."""
    return F.regexp_replace(x.cast("double").cast("string"), r"\.0$", "")


@strategy("sitemap-sd-paints")
def numbered_pages(rows: DataFrame, source: str, *, urls: DataFrame, manufacturer: str | None) -> DataFrame:
    """Product pages (url, body) of the URLs that numbered_urls gives, by the microdata of the page's Product; pages without a name are none."""
    page = urls.join(rows.groupBy("url").agg(F.max("body").alias("body")), "url")
    page = page.withColumn("item", E.product("body")).where("item.name IS NOT NULL")
    page = page.withColumn("found", cover_elements("body")).withColumn("cover", E.first(F.col("found"), f".{COVER}"))
    state = extract.snake(F.rtrim("item.availability", F.lit("/")))
    price = F.when(F.col("item.currency") == "EUR", F.col("item.price").try_cast("double"))
    hints = _hints(category=F.lit("paint"), categorySlug=F.col("category"), mpn=F.col("item.mpn"), volumeMl=plain_number(extract.millilitres(F.col("item.name"))))
    out = page.select(*observation(source, F.col("id"), manufacturer=F.lit(manufacturer), name=F.col("item.name"), sku=F.col("item.sku"), ean=blank_to_null(digits(F.col("item.gtin"))), url=F.col("url"), image=E.attribute(F.col("cover"), "src"), price=price, availability=blank_to_null(state), hints=hints))
    return out if manufacturer else out.limit(0)


def listing_tiles(rows: DataFrame) -> DataFrame:
    """id, url, code, text, tag, image, labels of listing pages (label, place, body): of tiles that categories repeat, the first value of
    each field that isn't empty, and the labels in order of arrival."""
    read = rows.select("place", "label", tile_elements("body").alias("found"))
    tiles = read.select("place", blank_to_null(F.col("label")).alias("label"), "found", F.posexplode(E.those(F.col("found"), f".{TILE}")).alias("at", "tile"))
    tiles = tiles.withColumn("found", E.inside(F.col("found"), F.col("tile")))
    fields = {k: E.text(E.first(F.col("found"), f".{c}")) for k, c in TILE_FIELDS.items()}
    image = E.attribute(E.first(F.col("found"), "img"), "src")
    fields["image"] = F.when(~image.contains(NO_IMAGE), image)
    links = F.filter(F.transform(E.those(F.col("found"), "a"), lambda a: a["attributes"]["href"]), lambda h: F.contains(h, F.lit(DETAIL_PATH)) & F.substring_index(h, DETAIL_PATH, -1).rlike("^[0-9]+$"))
    link = F.try_element_at(links, F.lit(1))
    each = tiles.select(F.struct("place", "at").alias("seq"), "label", link.alias("url"), F.substring_index(link, DETAIL_PATH, -1).alias("id"), *(v.alias(k) for k, v in fields.items())).where("id IS NOT NULL")
    first = lambda c: F.expr(f"min_by({c}, seq) FILTER (WHERE {c} IS NOT NULL)").alias(c)
    labels = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("seq", "label")))), lambda x: x["label"]))
    return each.groupBy("id").agg(first("url"), *(first(k) for k in fields), labels.alias("labels"))


def detail_fields(rows: DataFrame) -> DataFrame:
    """id, name, sku, ean, volume_ml, image of detail pages (id, body); no row where a page says neither a name nor a number."""
    read = rows.select("id", detail_elements("body").alias("found")).withColumn("area", E.first(F.col("found"), f".{DETAIL}")).where("area IS NOT NULL")
    name = E.text(E.first(E.inside(F.col("found"), F.col("area")), f".{DETAIL_NAME}"))
    words = F.split(E.text(F.col("area")), r"\W+")
    jan = F.try_element_at(F.filter(words, lambda w: w.rlike("^[0-9]{13}$") & F.left(w, F.lit(2)).isin(*JAN_PREFIXES)), F.lit(1))
    image = E.attribute(E.first(F.col("found"), f".{DETAIL_IMAGE}"), "data-src")
    volume = extract.millilitres(E.labelled(F.col("area.parts"), *VOLUME_LABELS))
    out = read.select("id", name.alias("name"), E.labelled(F.col("area.parts"), NUMBER_LABEL).alias("sku"), jan.alias("ean"), volume.alias("volume_ml"), F.when(~image.contains(NO_IMAGE), image).alias("image"))
    return out.where("name IS NOT NULL OR sku IS NOT NULL")


def detail_queue(tiles: DataFrame, known: DataFrame, missing: DataFrame, *, most_misses: int = 3) -> DataFrame:
    """id, url of tiles (id, url) whose detail page is to be fetched: neither known (id) nor missing (id, misses) so many times, by number."""
    gone = missing.where(F.col("misses") >= most_misses).select("id")
    return tiles.select("id", "url").join(known.select("id"), "id", "left_anti").join(gone, "id", "left_anti").orderBy(F.col("id").cast("long"), "id")


def missed(missing: DataFrame, fetched: DataFrame, found: DataFrame) -> DataFrame:
    """id, misses: one more for pages that were fetched (id, status) with 404 or said nothing (not in found); other failures don't count."""
    new = fetched.where("status = 404 OR status = 200").join(found.select("id"), "id", "left_anti").select("id", F.lit(1).alias("misses"))
    return missing.select("id", "misses").unionByName(new).groupBy("id").agg(F.sum("misses").cast("int").alias("misses"))


@strategy("mr-hobby")
def listed_paints(rows: DataFrame, source: str, *, manufacturer: str | None, details: DataFrame | None = None) -> DataFrame:
    """Listing pages (label, place, body), with what is known of details (as detail_fields gives it); a tile alone observes its product."""
    tiles = listing_tiles(rows)
    known = details.toDF("id", *(f"__{c}" for c in details.columns[1:])) if details is not None else None
    each = tiles.join(known, "id", "left") if known is not None else tiles.withColumns({f"__{c}": F.lit(None).cast("string") for c in ("name", "sku", "ean", "volume_ml", "image")})
    volume = plain_number(F.col("__volume_ml"))
    image = F.coalesce("image", "__image") if known is None or "__image" in known.columns else F.col("image")
    hints = _hints(category=F.lit("paint"), line=F.try_element_at("labels", F.lit(1)), lines=F.when(F.size("labels") > 1, _joined(F.col("labels"))), volumeMl=volume, tag=F.col("tag"))
    name = F.coalesce("__name", "text", "code", F.concat(F.lit("detail-"), "id"))
    out = each.select(*observation(source, F.col("id"), manufacturer=F.lit(manufacturer), name=name, sku=F.coalesce("__sku", "code"), ean=F.col("__ean"), url=F.col("url"), image=image, hints=hints))
    return out if manufacturer else out.limit(0)


def line_members(lines: DataFrame, member: str = r'href="[^"]*/products/([^"/]+)/?"') -> DataFrame:
    """slug, line: the name of the first line, by URL, whose page (url, body) links to the product."""
    # the name before the links are dealt: else each link would carry its page to where names are read
    named = lines.select("url", extract.page_name(F.col("body")).alias("line"), F.array_distinct(F.regexp_extract_all("body", F.lit(member), F.lit(1))).alias("slugs"))
    named = named.where("line IS NOT NULL").select("url", "line", F.explode("slugs").alias("slug"))
    return named.groupBy("slug").agg(F.min_by("line", "url").alias("line"))


@strategy("playwright-wp")
def rendered_pages(rows: DataFrame, source: str, *, lines: DataFrame, systems: DataFrame, manufacturer: str | None) -> DataFrame:
    """Product pages as a browser shows them (url, body), with their line (lines: url, body): its game system where systems (line,
    system) has one, else the line itself. Pages without a name are none."""
    each = rows.groupBy("url").agg(F.max("body").alias("body")).withColumns({"slug": last_segment(F.col("url")), "name": extract.page_name(F.col("body"))}).where("name IS NOT NULL")
    each = each.join(line_members(lines), "slug", "left").join(systems.select("line", "system"), "line", "left")
    image = _found(F.col("body"), r'(?is)<meta[^>]*property=["\']og:image["\'][^>]*content=["\']([^"\']+)["\']')
    hints = _hints(gameSystem=F.col("system"), productLine=F.when(F.col("system").isNull(), F.col("line")))
    out = each.select(*observation(source, F.col("slug"), manufacturer=F.lit(manufacturer), name=F.col("name"), url=F.col("url"), image=image, hints=hints))
    return out if manufacturer else out.limit(0)


def collection_enrichment(rows: DataFrame) -> DataFrame:
    """name_key, collection, sku, image of listings by collection (body, collection, place): the first arrival of each name counts."""
    i = _items(rows, "$.products", "title:string,images:array<struct<src:string>>,variants:array<struct<sku:string>>")
    each = i.select("seq", "collection", name_key(F.col("i.title")).alias("name_key"), blank_to_null(F.try_element_at("i.variants", F.lit(1))["sku"]).alias("sku"), F.try_element_at("i.images", F.lit(1))["src"].alias("image")).where("name_key <> ''")
    return each.groupBy("name_key").agg(F.min_by(F.struct("collection", "sku", "image"), "seq").alias("x")).select("name_key", "x.*")
