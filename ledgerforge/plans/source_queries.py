"""Queries on sources: payloads made of the star schema's rows, as platforms would send them, back to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import barcode, extract
from ledgerforge.operators import ledger, sets
from ledgerforge.plans.derive import PAINTS_SQL, check_sql, paints, table
from ledgerforge.plans.registry import query
from ledgerforge.sources import paint_shops as P
from ledgerforge.sources.strategies import STRATEGIES

I = F.col  # noqa: E741


def part_key() -> Column:
    return I("p_partkey")


def _text(x: Column) -> Column:
    return x.cast("string")


def _payloads(items: DataFrame, per: Column, item: Column, wrap: str | None, *by: str) -> DataFrame:
    """Pages (place, body, and the columns `by`) of the items (p_partkey and others) in order: JSON arrays, or objects that hold one."""
    pages = items.withColumn("place", per).groupBy("place", *by).agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("x")))), lambda r: r["x"]).alias("rows"))
    return pages.select("place", *by, F.to_json("rows" if wrap is None else F.struct(I("rows").alias(wrap))).alias("body"))


# Two collections that overlap: parts divisible by 2, and by 3; a third of the barcodes are known.
@query("""SELECT 's:h' || p_partkey AS key, 'm' || p_size % 4 AS manufacturer, 'T ' || p_partkey AS name, CASE WHEN p_partkey % 5 <> 0 THEN 'k' || p_partkey END AS sku, CASE WHEN p_partkey % 9 = 0 THEN '4' || p_partkey END AS ean,
  CAST(p_size AS DOUBLE) + 0.5 AS price, CASE WHEN p_partkey % 4 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS availability, concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN 'even' END, CASE WHEN p_partkey % 3 = 0 THEN 'three' END) AS collections
  FROM part WHERE (p_partkey % 2 = 0 OR p_partkey % 3 = 0) AND p_size % 4 <> 3 AND p_size % 5 <> 0""")
def shopify_paint_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    item = F.struct(
        F.concat(F.lit("h"), _text(part_key())).alias("handle"), F.concat(F.lit("T "), _text(part_key())).alias("title"), F.concat(F.lit("Vendor"), _text(I("p_size") % 4)).alias("vendor"), F.concat(F.lit("t"), _text(I("p_size") % 5)).alias("product_type"),
        F.array(F.struct(F.when(part_key() % 5 != 0, F.concat(F.lit("k"), _text(part_key()))).alias("sku"), F.concat(_text(I("p_size")), F.lit(".50")).alias("price"), (part_key() % 4 == 0).alias("available"))).alias("variants"),
    )
    place = F.floor(part_key() / 50).cast("int")
    pages = _payloads(p.where(part_key() % 2 == 0), place, item, "products").withColumn("collection", F.lit("even")).unionByName(_payloads(p.where(part_key() % 3 == 0), place + 1_000_000, item, "products").withColumn("collection", F.lit("three")))
    makers = spark.createDataFrame([(f"VENDOR{k}", f"m{k}") for k in range(3)], "vendor string, slug string")
    details = p.where(part_key() % 9 == 0).select(F.concat(F.lit("h"), _text(part_key())).alias("handle"), F.concat(F.lit("4"), _text(part_key())).alias("ean"))
    out = STRATEGIES["shopify-paints"](pages, "s", manufacturers=makers, types=["t1", "t2", "t3", "t4"], details=details)
    return out.select("key", "manufacturer", "name", "sku", "ean", "price", "availability", I("hints")["collections"].alias("collections"))


@query("""SELECT 'w:' || p_partkey AS key, 'N & ' || p_partkey AS name, CASE WHEN p_partkey % 3 <> 0 THEN 'k' || p_partkey END AS sku, p_size / 100.0 AS price, 'a,z' AS slugs, 'eur' AS currency FROM part""")
def woo_paint_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other part is in a second category, whose page comes later with another price: that counts, so pages repeat the same price."""
    p = table(spark, sf_dir, "part")
    item = lambda price: F.struct(part_key().alias("id"), F.concat(F.lit("N &amp; "), _text(part_key())).alias("name"), F.when(part_key() % 3 != 0, F.concat(F.lit("k"), _text(part_key()))).otherwise("").alias("sku"), F.struct(_text(price).alias("price"), F.lit(2).alias("currency_minor_unit"), F.lit("EUR").alias("currency_code")).alias("prices"), F.array(F.struct(F.lit("z").alias("slug")), F.struct(F.lit("a").alias("slug"))).alias("categories"))
    early = _payloads(p.where(part_key() % 2 == 0), F.floor(part_key() / 100).cast("int"), item(I("p_size") + 7), None)
    pages = early.unionByName(_payloads(p, F.floor(part_key() / 100).cast("int") + 1_000_000, item(I("p_size")), None))
    out = STRATEGIES["woo-paints"](pages, "w", manufacturer="m")
    return out.select("key", "name", "sku", "price", I("hints")["categorySlugs"].alias("slugs"), I("hints")["currency"].alias("currency"))


@query("""SELECT 'd:' || p_partkey AS key, 'Ink ' || p_size || ' ml' AS name, 'R' || p_partkey AS sku, CASE WHEN p_partkey % 3 = 0 THEN '8' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') END AS ean,
  CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.25 END AS price, 'out_of_stock' AS availability, CAST(p_size AS VARCHAR) AS volume, 'https://e.org/a/cat/' || p_partkey || '-x.html' AS url FROM part WHERE p_partkey % 5 <> 0""")
def numbered_product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    url = lambda path: F.concat(F.lit(f"https://e.org/{path}/cat/"), _text(part_key()), F.lit("-x.html"))
    urls = p.select(F.explode(F.array(url("b"), url("a"), F.concat(F.lit("https://e.org/blog/"), _text(part_key())))).alias("url"))
    body = F.concat(
        F.lit('<span itemprop="name">Home</span><div itemtype="https://schema.org/Product">'), F.when(part_key() % 5 != 0, F.concat(F.lit('<h1 class="h" itemprop="name"> <b>Ink</b> '), _text(I("p_size")), F.lit(" ml</h1>"))).otherwise(""),
        F.lit('<meta itemprop="sku" content="R'), _text(part_key()), F.lit('">'), F.when(part_key() % 3 == 0, F.concat(F.lit('<span itemprop="gtin13">8-'), F.lpad(_text(part_key()), 12, "0"), F.lit("</span>"))).otherwise(""),
        F.lit('<meta itemprop="price" content="'), _text(I("p_size")), F.lit('.25"><meta itemprop="priceCurrency" content="'), F.when(part_key() % 2 == 0, "EUR").otherwise("USD"), F.lit('"><link itemprop="availability" href="https://schema.org/OutOfStock"/></div>'),
    )
    pages = p.select(url("a").alias("url"), body.alias("body"))
    out = STRATEGIES["sitemap-sd-paints"](pages, "d", urls=P.numbered_urls(urls, "/cat/"), manufacturer="m")
    return out.select("key", "name", "sku", "ean", "price", "availability", I("hints")["volumeMl"].alias("volume"), "url")


@query("""SELECT 'h:' || p_partkey AS key, CASE WHEN p_partkey % 4 = 0 THEN 'Detail ' || p_partkey WHEN p_partkey % 2 = 0 THEN 'Text ' || p_partkey ELSE 'C' || p_partkey END AS name, CASE WHEN p_partkey % 4 = 0 THEN 'N-' || p_partkey ELSE 'C' || p_partkey END AS sku,
  CASE WHEN p_partkey % 4 = 0 THEN '49' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') END AS ean, CASE WHEN p_partkey % 4 = 0 THEN p_size || '.5' END AS volume, 'one' AS line, CASE WHEN p_partkey % 2 = 0 THEN 'one,two' END AS lines FROM part""")
def listed_product_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tiles in the first category without a text; the even ones again in the second, with one."""
    p = table(spark, sf_dir, "part")
    tile = lambda text: F.concat(F.lit('<li class="products__item"><a href="https://e.org/en/products/detail/'), _text(part_key()), F.lit('"><p class="products__item-code"> C'), _text(part_key()), F.lit('</p><p class="products__item-text">'), text, F.lit("</p></a></li>"))
    listing = lambda rows, text, label, first: rows.groupBy((F.floor(part_key() / 40).cast("int") + first).alias("place")).agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", tile(text).alias("t")))), lambda x: x["t"])).alias("body")).withColumn("label", F.lit(label))
    rows = listing(p, F.lit(""), "one", 0).unionByName(listing(p.where(part_key() % 2 == 0), F.concat(F.lit("<i>Text</i> "), _text(part_key())), "two", 1_000_000))
    detail = F.concat(F.lit('<div class="detail-prodinfo__text-area"><h3 class="common__square-title"> Detail '), _text(part_key()), F.lit("</h3><p>Product Number : N-"), _text(part_key()), F.lit("</p> NET Amount: "), _text(I("p_size")), F.lit(".5ml 49"), F.lpad(_text(part_key()), 11, "0"), F.lit(' </div><div class="common__container">'))
    details = P.detail_fields(p.where(part_key() % 4 == 0).select(_text(part_key()).alias("id"), detail.alias("body")))
    out = STRATEGIES["mr-hobby"](rows, "h", manufacturer="m", details=details)
    return out.select("key", "name", "sku", "ean", I("hints")["volumeMl"].alias("volume"), I("hints")["line"].alias("line"), I("hints")["lines"].alias("lines"))


@query("""SELECT 'r:p' || p_partkey AS key, 'Name ' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 AND p_partkey % 3 = 0 THEN 'sys' END AS system, CASE WHEN p_partkey % 7 = 0 AND p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'Line 5' WHEN p_partkey % 7 = 0 THEN 'Line 7' END AS line FROM part WHERE NOT (p_partkey % 35 = 0 AND p_partkey % 3 = 0)
  UNION ALL SELECT 'r:p' || p_partkey, 'Name ' || p_partkey, NULL, 'Line 5' FROM part WHERE p_partkey % 35 = 0 AND p_partkey % 3 = 0""")
def browser_product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lines whose members overlap, the first by URL counts; every third page of the second line belongs to a line with a system."""
    p = table(spark, sf_dir, "part")
    link = F.concat(F.lit('<a href="https://e.org/products/p'), _text(part_key()), F.lit('/">'))
    line = lambda rows, name, url: rows.agg(F.concat_ws("", F.lit(f"<h1>{name}</h1>"), F.array_sort(F.collect_list(link))).alias("body")).withColumn("url", F.lit(url))
    lines = line(p.where(part_key() % 5 == 0), "Line 5", "https://e.org/line/a").unionByName(line(p.where((part_key() % 7 == 0) & (part_key() % 3 == 0)), "Line 21", "https://e.org/line/b")).unionByName(line(p.where(part_key() % 7 == 0), "Line 7", "https://e.org/line/c"))
    pages = p.select(F.concat(F.lit("https://e.org/products/p"), _text(part_key()), F.lit("/")).alias("url"), F.concat(F.lit("<h1>Name "), _text(part_key()), F.lit(" | Shop</h1>")).alias("body"))
    out = STRATEGIES["playwright-wp"](pages, "r", lines=lines, systems=spark.createDataFrame([("Line 21", "sys")], "line string, system string"), manufacturer="m")
    return out.select("key", "name", I("hints")["gameSystem"].alias("system"), I("hints")["productLine"].alias("line"))


@query("""SELECT 'name ' || (p_partkey % 900) AS name_key, min('c' || (p_partkey // 1000)) AS collection, arg_min('k' || p_partkey, p_partkey) AS sku FROM part GROUP BY p_partkey % 900""")
def collection_first_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("collection", F.concat(F.lit("c"), _text(F.floor(part_key() / 1000))))
    item = F.struct(F.concat(F.lit(" NAME  "), _text(part_key() % 900)).alias("title"), F.array(F.struct(F.concat(F.lit("k"), _text(part_key())).alias("sku"))).alias("variants"))
    pages = _payloads(p, F.floor(part_key() / 100).cast("int"), item, "products", "collection")
    return P.collection_enrichment(pages).select("name_key", "collection", "sku")


@query("""WITH q AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END WHEN o_orderkey % 4 = 1 THEN 2 WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 < 3 THEN 1 END AS reason, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT key, reason FROM q WHERE reason IS NOT NULL ORDER BY reason, CASE WHEN reason = 2 THEN d END NULLS FIRST, key LIMIT 6000""")
def barcode_detail_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("key"), _text(F.to_date("o_orderdate")).alias("day"))
    k = I("key")
    items = o.select("key", F.when(k % 4 == 1, F.concat("day", F.lit("x"))).otherwise(I("day")).alias("updated_at"))
    state = o.where(k % 4 != 0).select("key", I("day").alias("updated_at"), F.when(k % 3 != 0, "v").alias("value"), (k % 5).cast("int").alias("misses"))
    return ledger.barcode_queue(items, state, o.where(k % 8 == 0).select("key"), 6000)


_E = "('50' || lpad(CAST(p_partkey AS VARCHAR), 10, '0'))"


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN {_E} || {check_sql(_E)} END AS ean FROM part""")
def prefixed_eans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in four is a barcode of the prefix; others are of another prefix, a digit short, or have one too many."""
    from ledgerforge.functions.barcode import ean_from_stem

    stem = lambda prefix: ean_from_stem(F.concat(F.lit(prefix), F.lpad(_text(part_key()), 10, "0")))
    raw = F.when(part_key() % 4 == 0, F.concat_ws(" ", F.substring(stem("50"), 1, 6), F.substring(stem("50"), 7, 7))).when(part_key() % 4 == 1, stem("40")).when(part_key() % 4 == 2, F.substring(stem("50"), 1, 12)).otherwise(F.concat(F.lit("1"), stem("50")))
    # the number by itself first: the barcode's expression says it many times
    return table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")).select("p_partkey", barcode.retail_ean(I("raw"), ["50", "51"]).alias("ean"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Toads' WHEN p_partkey % 3 = 1 AND p_partkey % 2 = 0 THEN 'Frogs' WHEN p_partkey % 5 = 0 THEN 'Newts' END AS faction FROM part""")
def seo_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    seo = F.when(part_key() % 3 == 0, F.array(F.lit("none"), F.lit("the TOADS of"), F.lit("frogs"))).when((part_key() % 3 == 1) & (part_key() % 2 == 0), F.array(F.lit("toad"), F.lit("frogs and toads")))
    return table(spark, sf_dir, "part").select("p_partkey", extract.seo_term(seo, F.when(part_key() % 5 == 0, "Big newts").otherwise("x"), ["Frogs", "Toads", "Newts"]).alias("faction"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '1' || p_partkey WHEN 1 THEN '2' || p_partkey WHEN 2 THEN '3' || p_partkey WHEN 3 THEN '4' || p_partkey END AS gtin FROM part""")
def nested_ld_gtins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph within an array, offers of which a later one has the number, a number of its own, one beside a broken block; none."""
    k, block = _text(part_key()), lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    html = (
        F.when(part_key() % 5 == 0, block(F.concat(F.lit('[{"@type":"WebPage"},{"@graph":[{"@type":"Thing"},{"@type":["Product","X"],"name":"n","gtin13":"1'), k, F.lit('"}]}]'))))
        .when(part_key() % 5 == 1, block(F.concat(F.lit('{"@type":"Product","name":"n","offers":[{"price":1},{"gtin":"2'), k, F.lit('"}]}'))))
        .when(part_key() % 5 == 2, block(F.concat(F.lit('{"@type":"Product","name":"n","gtin":3'), k, F.lit("}"))))
        .when(part_key() % 5 == 3, F.concat(block(F.lit("{broken")), block(F.concat(F.lit('{"@type":"Product","name":"n","offers":{"gtin12":"4'), k, F.lit('"}}')))))
        .otherwise(block(F.lit('{"@type":"Product","name":"n"}')))
    )
    return table(spark, sf_dir, "part").select("p_partkey", extract.ld_product(html)["gtin"].alias("gtin"))


# Sets of rows


@query("SELECT o_orderkey AS key, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS slice FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def slices_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("key"))
    return sets.union_once([o.where("key % 3 = 0").withColumn("slice", F.lit(2)), o.where("key % 2 = 0").withColumn("slice", F.lit(1))], "key", "slice")


@query("SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def pending_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(I("o_custkey").alias("key"), "o_orderkey")
    return sets.pending(o, o.where("o_orderkey % 3 = 0"), "key")


@query("SELECT p_partkey FROM part WHERE list_has_any([p_type, string_split(p_name, ' ')[1]], ['SMALL', 'LARGE', 'red'])")
def allowed_term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.array(I("p_type"), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return sets.allowed_terms(table(spark, sf_dir, "part").withColumn("terms", terms), "terms", ["SMALL", "LARGE", "red"]).select("p_partkey")


@query("SELECT o_custkey, list_has_all(['1-URGENT', '2-HIGH', '5-LOW'], list(DISTINCT o_orderpriority)) AS inside FROM orders GROUP BY o_custkey")
def subset_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("held"))
    return held.select("o_custkey", sets.subset(I("held"), F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("5-LOW"))).alias("inside"))


@query("SELECT o_orderkey AS key FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def pruned_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = table(spark, sf_dir, "orders").select(I("o_custkey").alias("id"), I("o_orderkey").alias("key"))
    return sets.pruned(state, table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(I("c_custkey").alias("id")), "id").select("key")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id FROM part ORDER BY p_partkey DESC LIMIT 50")
def numeric_text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fifty by number, which by text would be others."""
    rows = table(spark, sf_dir, "part").select(_text(-part_key()).alias("n"), _text(part_key()).alias("id"))
    return sets.by_number(rows, "n").limit(50).select("id")


@query("""SELECT n_nationkey AS id, '{"id":' || n_nationkey || ',"kind":"' || n_name || '"' || CASE WHEN n_regionkey % 2 = 0 THEN ',"note":"' || n_regionkey || '"' ELSE '' END || '}' AS line FROM nation""")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.when(I("n_regionkey") % 2 == 0, _text(I("n_regionkey"))).alias("note"), I("n_nationkey").alias("id"), I("n_name").alias("kind"))
    return n.select("id", sets.canonical("note", "kind", "id").alias("line"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.to_date("o_orderdate"), I("o_orderkey")
    raw = F.when(k % 3 == 0, _text(day)).when(k % 3 == 1, F.date_format(day, "dd.MM.yyyy")).otherwise(F.concat(F.date_format(day, "yyyy"), F.lit("-13-41")))
    return table(spark, sf_dir, "orders").select("o_orderkey", sets.iso_date(raw).alias("day"))


@query("""WITH c AS (SELECT o_orderkey AS pair, CASE o_orderkey % 4 WHEN 0 THEN 'same-product' WHEN 1 THEN 'different-product' WHEN 2 THEN 'unknown' END AS verdict, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 10) / 10.0 END AS conf FROM orders)
SELECT count(*) AS candidates, count(verdict) AS decided, count(*) FILTER (WHERE verdict = 'same-product' AND conf >= 0.8) AS accepted, count(*) FILTER (WHERE verdict = 'different-product') AS rejected, count(*) FILTER (WHERE verdict = 'unknown') AS unknown,
  count(*) FILTER (WHERE verdict = 'same-product' AND NOT coalesce(conf >= 0.8, false)) AS low_confidence FROM c""")
def verdict_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("pair")), I("pair")
    verdict = F.when(k % 4 == 0, "same-product").when(k % 4 == 1, "different-product").when(k % 4 == 2, "unknown")
    decided = o.where(k % 4 != 3).select("pair", verdict.alias("verdict"), F.when(k % 5 != 0, (k % 10) / 10.0).alias("confidence"))
    return sets.verdict_counts(o, decided, 0.8)


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.run_counts(table(spark, sf_dir, "orders"), finished=I("o_orderstatus") == "F", large=I("o_totalprice") > 100000)


@query("""WITH o AS (SELECT c_custkey AS entity, 'faction' AS field, 'old' AS value FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'name', c_name FROM customer WHERE c_custkey % 6 = 0),
d AS (SELECT c_custkey AS entity, c_mktsegment AS s, CASE WHEN c_custkey % 4 = 0 THEN 'f' END AS f FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM o WHERE NOT (field = 'faction' AND entity IN (SELECT entity FROM d)) UNION ALL SELECT entity, 'game_system', s FROM d UNION ALL SELECT entity, 'faction', f FROM d""")
def decisions_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(I("c_custkey").alias("entity"), "c_name", "c_mktsegment")
    overrides = c.where("entity % 2 = 0").select("entity", F.lit("faction").alias("field"), F.lit("old").alias("value")).unionByName(c.where("entity % 6 = 0").select("entity", F.lit("name").alias("field"), I("c_name").alias("value")))
    decisions = c.where("entity % 3 = 0").select("entity", I("c_mktsegment").alias("game_system"), F.when(I("entity") % 4 == 0, "f").alias("faction"))
    return sets.applied_decisions(overrides, decisions, c.select(I("c_mktsegment").alias("slug")).distinct(), spark.createDataFrame([("f",)], "slug string"))


@query(f"WITH {PAINTS_SQL} SELECT id, CASE WHEN discontinued THEN 'discontinued' ELSE 'current' END AS status, CASE WHEN discontinued THEN 'out_of_stock' ELSE 'unknown' END AS availability, code AS product_code, 'paint' AS category, set_name || '/' || r AS shown FROM paint")
def archival_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = paints(spark, sf_dir).withColumns({c: F.lit(None).cast("string") for c in ("ean", "image", "hex", "packaging", "type", "finish")}).withColumn("volume_ml", F.lit(None).cast("int")).withColumn("name", _text(I("id")))
    out = sets.archival(items)
    return out.select(I("name").cast("long").alias("id"), "status", "availability", "product_code", "category", F.concat_ws("/", "details.set", _text(I("details.r"))).alias("shown"))
