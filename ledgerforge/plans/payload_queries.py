"""Queries on payloads of single platforms, on files that are written and read back, and on registries and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import text
from ledgerforge.functions.barcode import ean_from_stem
from ledgerforge.operators import attribution, catalog, enrich, ledger, quality
from ledgerforge.plans import publish
from ledgerforge.plans.derive import PAINTS_SQL, check_sql, paints, table
from ledgerforge.plans.registry import query
from ledgerforge.plans.runner import Contract, Source, run
from ledgerforge.sources import evidence, tables, yaml_text
from ledgerforge.sources.shared import shared_path
from ledgerforge.sources.store import SourceStore
from ledgerforge.sources.strategies import STRATEGIES, workbooks

def _k() -> Column:
    return F.col("p_partkey")


def _said(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _pages(rows: DataFrame, item: Column, wrap: str | None, size: int = 100) -> DataFrame:
    """Pages (place, body) of items in the order of parts: a JSON array, or nested objects of which the innermost holds it."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(_k(), item.alias("x")))), lambda r: r["x"])
    pages = rows.groupBy(F.floor(_k() / size).alias("place")).agg(listed.alias("rows"))
    inner = F.col("rows")
    for name in reversed(wrap.split(".") if wrap else []):
        inner = F.struct(inner.alias(name))
    return pages.select("place", F.to_json(inner).alias("body"))


def _ean(prefix: str = "50") -> Column:
    return ean_from_stem(F.concat(F.lit(prefix), F.lpad(_k().cast("string"), 10, "0")))


_STEM = "('50' || lpad(CAST(p_partkey AS VARCHAR), 10, '0'))"
EAN_SQL = f"({_STEM} || {check_sql(_STEM)})"


@query(f"""SELECT 's:h' || p_partkey AS key, 'm' || p_partkey % 3 AS manufacturer, p_name AS name, CASE WHEN p_partkey % 4 = 0 THEN {EAN_SQL} WHEN p_partkey % 4 = 1 THEN '5011921139590' END AS ean, CAST(p_size + 0.5 AS DOUBLE) AS price, CASE WHEN p_partkey % 5 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS availability
  FROM part WHERE p_partkey % 10 < 8 AND p_partkey % 7 <> 6""")
def shopify_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors out of scope and unknown ones are left out; a barcode of the listing comes before one of earlier details."""
    p = table(spark, sf_dir, "part")
    variant = F.struct(_said("k", _k()).alias("sku"), F.when(_k() % 4 == 0, _ean()).alias("barcode"), _said(F.col("p_size"), ".50").alias("price"), (_k() % 5 == 0).alias("available"))
    item = F.struct(_said("h", _k()).alias("handle"), F.col("p_name").alias("title"), F.when(_k() % 10 < 8, _said("V", _k() % 3)).otherwise(F.lit("other")).alias("vendor"), F.array(variant).alias("variants"))
    stranger = item.withField("vendor", F.lit("V9"))
    rows = _pages(p, F.when(_k() % 7 == 6, stranger).otherwise(item), "products")
    makers = spark.createDataFrame([(f"v{k}", f"m{k}") for k in range(3)], "vendor string, slug string")
    details = p.where(_k() % 2 == 1).where(_k() % 4 == 1).select(_said("h", _k()).alias("key"), F.lit("5011921139590").alias("ean"))
    return STRATEGIES["shopify"](rows, "s", vendors=["V0", "V1", "V2", "V9"], manufacturers=makers, details=details).select("key", "manufacturer", "name", "ean", "price", "availability")


@query("""SELECT 'w:' || p_partkey AS key, 'A & ' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'k' || p_partkey END AS sku, p_size / 100.0 AS price, 'a,c' || p_partkey % 3 AS category FROM part""")
def woo_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(_k().alias("id"), _said("A &amp; <b>", _k(), "</b>").alias("name"), F.when(_k() % 2 == 0, _said("k", _k())).otherwise(" ").alias("sku"), F.struct(F.col("p_size").cast("string").alias("price"), F.lit(2).alias("currency_minor_unit")).alias("prices"), F.array(F.struct(_said("c", _k() % 3).alias("slug")), F.struct(F.lit("a").alias("slug"))).alias("categories"))
    return STRATEGIES["woo-store-api"](_pages(table(spark, sf_dir, "part"), item, None), "w").select("key", "name", "sku", "price", F.col("hints")["category"].alias("category"))


@query("""SELECT 'a:p-' || p_partkey % 500 AS key, arg_min(p_name, p_partkey) AS name, CAST(p_partkey % 500 AS VARCHAR) AS sku, arg_min(CASE WHEN p_partkey % 2 = 0 THEN 'Toads' ELSE 'General' END, p_partkey) AS faction FROM part GROUP BY p_partkey % 500""")
def algolia_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that repeat objects: the first arrival counts."""
    item = F.struct(_said("p-", _k() % 500).alias("objectID"), F.col("p_name").alias("name"), F.when(_k() % 2 == 0, "Root > Toads > x").otherwise("Root").alias("gameHierarchy"))
    return STRATEGIES["algolia"](_pages(table(spark, sf_dir, "part"), item, "hits"), "a").select("key", "name", "sku", F.col("hints")["faction"].alias("faction"))


@query("""SELECT 'g:' || p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN 'pre_order' WHEN p_size % 2 = 1 THEN 'in_stock' ELSE 'out_of_stock' END AS availability, CASE WHEN p_partkey % 4 = 0 THEN 'Newts' WHEN contains(p_name, 'red') THEN 'Red' END AS faction FROM part""")
def appsync_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(_k().alias("id"), F.col("p_name").alias("name"), (F.col("p_size") % 2).alias("inventory"), (_k() % 3 == 0).alias("preorder"), F.when(_k() % 4 == 0, F.array(F.lit("the newts"))).otherwise(F.array(F.lit("none"))).alias("seo"))
    rows = _pages(table(spark, sf_dir, "part"), item, "data.products.products")
    return STRATEGIES["appsync"](rows, "g", factions=["Newts", "Red"]).select("key", "availability", F.try_element_at("hints", F.lit("faction")).alias("faction"))


@query("""SELECT 'r:' || p_partkey AS key, p_size / 100.0 AS price, 'm' || p_partkey AS image, CASE WHEN p_partkey % 6 = 0 THEN '1,' || (p_partkey + 2) END AS contents FROM part""")
def reaper_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays in pages' scripts; the main image comes first, and of a set's parts the paints are its contents."""
    image = lambda kind, order, url: F.struct(F.lit(kind).alias("type"), F.lit(order).alias("order"), url.alias("url"))
    part = lambda sku, of: F.struct(sku.cast("string").alias("sku"), F.lit(of).alias("material"))
    item = F.struct(_k().cast("string").alias("sku"), F.col("p_name").alias("name"), F.col("p_size").alias("price"), F.array(image("side", 1, _said("s", _k())), image("main", 5, _said("m", _k()))).alias("images"), F.when(_k() % 6 == 0, F.array(part(_k() + 2, "Paint"), part(F.lit(1), "paint"), part(_k(), "brush"))).alias("associatedProducts"))
    rows = _pages(table(spark, sf_dir, "part"), item, None).withColumn("body", F.concat(F.lit("<script>var products = "), "body", F.lit(";</script>")))
    return STRATEGIES["reaper"](rows, "r").select("key", "price", F.col("hints")["image"].alias("image"), F.try_element_at("hints", F.lit("contents")).alias("contents"))


@query("""SELECT 'c:/p/' || p_partkey AS key, 'Name ' || p_partkey AS name, lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS sku, CAST(p_size + 0.25 AS DOUBLE) AS price, true AS archived FROM part WHERE p_partkey % 3 <> 0""")
def archive_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest good capture of each path, read as an old shop's page; paths of which no snapshot names a product are left for later."""
    p = table(spark, sf_dir, "part")
    each = p.select(_k(), F.col("p_size"), F.explode(F.array(*map(F.lit, ("2019", "2020", "2021")))).alias("timestamp"))
    caps = each.select(_said("http://e.org/p/", _k(), "?x=", F.col("timestamp")).alias("original"), "timestamp", F.when(F.col("timestamp") == "2021", "404").otherwise("200").alias("status"))
    page = _said("<title>Name ", _k(), F.when(F.col("timestamp") == "2020", " | Shop").otherwise(" older"), "</title>code ", F.lpad(_k().cast("string"), 11, "0"), " £ ", F.col("p_size"), "<sup>25</sup>")
    old = each.select(_said("http://e.org/p/", _k(), "?x=", F.col("timestamp")).alias("original"), "timestamp", F.when(_k() % 3 != 0, page).otherwise("").alias("body"))
    return STRATEGIES["cdx-archive"](caps, "c", include="^/p/", snapshots=old).select("key", "name", "sku", "price", "archived")


@query(f"""SELECT 't:c' || p_partkey AS key, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN {EAN_SQL} END AS ean, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 4 <> 0 THEN 'discontinued' ELSE 'current' END AS status FROM part WHERE p_partkey % 9 <> 0""")
def trade_sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with titles above their headers: withdrawn and not current is gone, what is to come doesn't count, other numbers are no barcodes."""
    p = table(spark, sf_dir, "part").where(_k() % 9 != 0)
    heads = spark.createDataFrame([("w", "withdrawn", 1, ["Withdrawn", None, None, None]), ("w", "withdrawn", 2, ["CODE", "Product", "EAN", "Release Date"]), ("v", "current", 1, ["code", "name", "barcode", "release date"])], "sheet string, role string, line int, cells array<string>")
    line = lambda sheet, role, rows, name, day: rows.select(F.lit(sheet).alias("sheet"), F.lit(role).alias("role"), (_k() + 10).cast("int").alias("line"), F.array(_said("c", _k()), name, F.when(_k() % 2 == 0, _ean()).otherwise(_said("40", _k())), F.lit(day)).alias("cells"))
    rows = heads.unionByName(line("w", "withdrawn", p.where(_k() % 5 == 0), F.lit(" "), "2020-01-01")).unionByName(line("v", "current", p.where((_k() % 5 != 0) | (_k() % 4 == 0)), F.col("p_name"), "2020-01-01"))
    rows = rows.unionByName(line("u", "withdrawn", p.where((_k() % 5 == 0) & (_k() % 4 != 0)), F.col("p_name"), "")).unionByName(line("f", "withdrawn", p, F.lit("future"), "2999-01-01"))
    rows = rows.unionByName(heads.where("sheet = 'v'").select(F.lit("u").alias("sheet"), F.lit("withdrawn").alias("role"), "line", "cells")).unionByName(heads.where("sheet = 'v'").select(F.lit("f").alias("sheet"), F.lit("withdrawn").alias("role"), "line", "cells"))
    from ledgerforge.sources.strategies import sheet_rows

    return STRATEGIES["trade-sheets"](sheet_rows(rows), "t", prefixes=["50"], run_date="2024-01-01").select("key", "name", "ean", F.col("hints")["status"].alias("status"))


@query(f"""SELECT 'b:' || {EAN_SQL} AS key, 'acme ' || p_partkey AS name FROM part WHERE p_partkey % 3 = 0""")
def barcode_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that name the manufacturer, in title or brand; of several the first title."""
    p = table(spark, sf_dir, "part")
    one = p.select(_ean().alias("ean"), F.when(_k() % 3 == 0, _said("acme ", _k())).otherwise(_said("other ", _k())).alias("title"), F.lit(None).cast("string").alias("brand"), F.array(F.lit("ACME")).alias("names"))
    two = p.where(_k() % 3 == 0).select(_ean().alias("ean"), _said("zzz ", _k()).alias("title"), F.lit("The Acme Co").alias("brand"), F.array(F.lit("Acme")).alias("names"))
    return STRATEGIES["barcode-db"](one.unionByName(two), "b").select("key", "name")


@query("""SELECT concat_ws('>', 'o', p_partkey % 5) AS source, count(*) AS n, CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_sku, min('n' || p_partkey) AS first_name FROM part GROUP BY p_partkey % 5""")
def evidence_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations written as a ledger of JSON lines, one folder a source, and read back."""
    p = table(spark, sf_dir, "part")
    none = {c: F.lit(None) for c in ("url", "manufacturer", "ean", "priceGbp", "priceUsd", "priceEur", "priceCad", "imageUrl", "availability", "hints")}
    fields = {**none, "key": _said("o", _k() % 5, ":", _k()), "name": _said("n", _k()), "sku": F.when(_k() % 3 == 0, _said("00", _k())), "firstSeen": F.lit("2024-01-01"), "lastSeen": F.lit("2024-01-02"), "missStreak": F.lit(1), "archived": F.lit(False), "extractor": F.lit("x")}
    rows = p.select(*(fields[x.split()[0]].cast(x.split()[1]).alias(x.split()[0]) for x in evidence.SCHEMA.split(", ")))
    path = shared_path(spark, "evidence")
    evidence.write_evidence(rows, path)
    back = spark.read.schema(evidence.SCHEMA).json(path, recursiveFileLookup=True).where("sku IS NULL OR sku LIKE '00%'")
    return back.groupBy(F.concat_ws(">", F.lit("o"), F.substring(F.split_part("key", F.lit(":"), F.lit(1)), 2, 9)).alias("source")).agg(F.count("*").alias("n"), F.count("sku").alias("with_sku"), F.min("name").alias("first_name"))


@query(f"""WITH {PAINTS_SQL} SELECT 'brand ' || id % 3 AS brand, 'N' || id AS name, CASE WHEN id % 3 = 1 THEN 'c' || id END AS code, 'Base' AS set_name, CAST(r AS INTEGER) AS r, CAST(g AS INTEGER) AS g, CAST(b AS INTEGER) AS b FROM paint WHERE id % 7 <> 0""")
def paint_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of three brands in Markdown, one with a code column; rows without a colour are none."""
    p = paints(spark, sf_dir).select("id", *(F.lpad(F.hex(c), 2, "0").alias(c) for c in "rgb"))
    colour = F.when(F.col("id") % 7 != 0, F.concat(F.lit("![x](y) `#"), "r", "g", "b", F.lit("`"))).otherwise("none")
    code = F.when(F.col("id") % 3 == 1, _said("|c", F.col("id"))).otherwise("")
    rows = p.select((F.col("id") % 3).alias("b"), "id", _said("|N", F.col("id"), code, "|Base|1|2|3|", colour, "|").alias("line"))
    head = F.when(F.col("b") == 1, F.lit("|Name|Code|Set|R|G|B|Hex|\n|---|---|---|---|---|---|---|")).otherwise("|Name|Set|R|G|B|Hex|\n|---|---|---|---|---|---|")
    texts = rows.groupBy("b").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), "\n").alias("body")).withColumn("value", F.concat(F.lit("# x\n"), head, F.lit("\n"), "body"))
    path = shared_path(spark, "markdown")
    for k in range(3):  # a file is named by its brand
        texts.where(F.col("b") == k).select("value").coalesce(1).write.text(f"{path}/{k}")
    from ledgerforge.sources import files

    for k in range(3):
        part = next(n for n in files.children(spark, f"{path}/{k}") if n.startswith("part-") and spark.read.text(f"{path}/{k}/{n}").limit(1).count())
        files.rename(spark, f"{path}/{k}/{part}", f"{path}/b{k}.md")
    return tables.read_paint_tables(spark, path, {f"b{k}": f"brand {k}" for k in range(3)}).select("brand", "name", "code", "set_name", "r", "g", "b")


@query("""SELECT p_brand AS partition, p_partkey AS id, '00' || p_partkey AS code, CASE WHEN p_partkey % 2 = 0 THEN p_name || chr(10) || 'two lines' WHEN p_partkey % 5 = 0 THEN '# yes: no' ELSE 'nan' END AS note FROM part""")
def yaml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by brand, with texts that look like numbers, comments and maps, and texts of two lines, written and read back."""
    rows = table(spark, sf_dir, "part").select(F.regexp_replace("p_brand", "#", "_").alias("part"), _k().alias("id"), _said("00", _k()).alias("code"), F.when(_k() % 2 == 0, F.concat("p_name", F.lit("\ntwo lines"))).when(_k() % 5 == 0, "# yes: no").otherwise("nan").alias("note"))
    path = shared_path(spark, "yaml")
    yaml_text.write_yaml(yaml_text.partition_documents(rows, "part", ["id"]), path)
    back = yaml_text.read_yaml(spark, path, "id long, code string, note string")
    return back.select(F.regexp_replace("partition", "_", "#").alias("partition"), "id", "code", "note")


@query("""SELECT lower(c_mktsegment) || c_custkey % 40 AS vendor, count(DISTINCT c_custkey % 3) AS slugs FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey % 3) > 1""")
def vendor_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", (F.col("c_custkey") % 40).cast("string")).alias("vendor"), (F.col("c_custkey") % 3).cast("string").alias("slug"))
    return attribution.ambiguous_vendors(c)


@query(f"""WITH {PAINTS_SQL} SELECT brand, id FROM (SELECT brand, id, row_number() OVER (PARTITION BY brand ORDER BY id) AS n FROM paint) WHERE n <= 3""")
def sample_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.ranked(paints(spark, sf_dir).select("brand", "id"), ["brand"], [F.col("id")], keep=3)


@query("""WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS system FROM customer) SELECT id, row_number() OVER (ORDER BY system NULLS LAST, id) AS place FROM c""")
def consolidated_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated list by system, rows without one last; each with its place in it."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("system"))
    ordered = publish.consolidated(rows, "system", ["id"])
    return ordered.rdd.zipWithIndex().map(lambda x: (x[0]["id"], x[1] + 1)).toDF("id long, place long")


@query("""SELECT DISTINCT lower(replace(p_type, ' ', '-')) AS slug, p_type AS label FROM part""")
def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "part").select(F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))).alias("slug"), F.col("p_type").alias("label")).distinct()
    path = shared_path(spark, "labels")
    tables.write_labels(labels, path)
    return spark.read.schema("slug string, label string").json(path)


@query("""SELECT 's:p-' || o_custkey AS key, CAST(min(CASE WHEN o_orderkey % 3 = 2 THEN DATE '2024-01-03' WHEN o_orderkey % 3 = 1 THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END) AS DATE) AS first_seen,
  CASE WHEN bool_or(o_orderkey % 3 = 2) THEN 0 WHEN bool_or(o_orderkey % 3 = 1) THEN 1 ELSE 2 END AS miss_streak FROM orders GROUP BY o_custkey""")
def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three full sweeps of a source with its store, and between them one whose contract is broken."""
    store = SourceStore(spark, shared_path(spark, "sources"))
    o = table(spark, sf_dir, "orders")
    hits = lambda rows: rows.groupBy((F.col("o_custkey") % 50).alias("place")).agg(F.to_json(F.struct(F.collect_set(F.struct(_said("p-", F.col("o_custkey")).alias("objectID"), F.lit("n").alias("name"))).alias("hits"))).alias("body"))
    source = Source("s", "algolia", contract=Contract(1, 60.0, {"name": 1.0}))
    for k in (0, 1):
        run(store, source, hits(o.where(F.col("o_orderkey") % 3 == k)), f"2024-01-0{k + 1}")
    run(store, source, hits(o.where("o_orderkey = 0")), "2024-02-01")
    run(store, source, hits(o.where("o_orderkey % 3 = 2")), "2024-01-03")
    return store.load("s").evidence.select("key", "first_seen", "miss_streak")


@query("""WITH c AS (SELECT c_custkey % 60 AS slice, c_custkey // 60 + 1 AS page, c_custkey % 8 AS rows, CASE WHEN c_custkey % 60 % 4 = 0 THEN 9 END AS reported FROM customer WHERE c_custkey % 11 <> 3),
  a AS (SELECT slice, page + 1 AS page FROM c UNION SELECT slice, 1 FROM c), g AS (SELECT slice, min(page) AS next FROM a ANTI JOIN c USING (slice, page) GROUP BY slice),
  s AS (SELECT slice, next, coalesce(sum(rows) FILTER (WHERE page < next), 0) AS rows, max(reported) FILTER (WHERE page < next) AS reported, coalesce(bool_or(rows = 0) FILTER (WHERE page < next), false) AS hollow FROM g LEFT JOIN c USING (slice) GROUP BY ALL),
  t AS (SELECT *, CASE WHEN hollow OR coalesce(next > reported, false) THEN 'done' WHEN rows >= 30 OR next > 12 THEN 'capped' ELSE 'open' END AS state FROM s)
  SELECT slice, CAST(rows AS BIGINT) AS rows, CASE WHEN state = 'open' THEN next END AS next_page, state FROM t""")
def page_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with pages that are missing, empty, beyond a cap or the last that the platform reports."""
    k = F.col("c_custkey")
    pages = table(spark, sf_dir, "customer").where(k % 11 != 3).select((k % 60).alias("slice"), (F.floor(k / 60) + 1).alias("page"), (k % 8).alias("rows"), F.when(k % 60 % 4 == 0, 9).alias("reported"))
    return ledger.paging(pages, most_rows=30, most_pages=12)


@query("""SELECT DISTINCT 'https://e.org/f/' || p_partkey % 300 || CASE WHEN p_partkey % 2 = 0 THEN '.xlsx' ELSE '.xls' END AS url, 'Trade ' || p_partkey % 300 || '.XLSX' AS name FROM part WHERE p_partkey % 300 % 4 = 0
  UNION SELECT DISTINCT 'https://e.org/f/' || p_partkey % 300 || '.xlsx', p_partkey % 300 || '.xlsx' FROM part WHERE p_partkey % 300 % 4 = 2 AND p_partkey % 300 < 100 AND p_partkey % 300 >= 10""")
def workbook_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that several countries list, by name or, where they have none, by their URL."""
    n = _k() % 300
    assets = table(spark, sf_dir, "part").select((_k() % 7).alias("country"), _said("https://e.org/f/", n, F.when(_k() % 2 == 0, ".xlsx").otherwise(".xls")).alias("url"), F.when(n % 4 == 0, _said("Trade ", n, ".XLSX")).otherwise("").alias("name"))
    return workbooks(assets, ["^trade", r"^\d\d\."])


@query(f"""WITH p AS (SELECT 'k' || p_partkey % 1900 AS key, 'm' || p_partkey % 4 AS manufacturer, CASE WHEN p_partkey % 5 = 0 THEN 'bad' || p_partkey WHEN p_partkey % 5 < 3 THEN {EAN_SQL} END AS ean, p_partkey % 5 BETWEEN 1 AND 2 AS valid FROM part),
  m AS (SELECT 'm' || p_partkey % 4 AS manufacturer, CASE WHEN p_partkey % 5 IN (1, 2) THEN 1 END AS ean, p_partkey % 2 = 0 AS sure FROM part WHERE p_partkey % 3 = 0)
  SELECT 'observations' AS metric, count(*) AS value FROM p UNION ALL SELECT 'distinct valid barcodes', count(DISTINCT ean) FROM p WHERE valid UNION ALL SELECT 'invalid barcodes', count(*) FROM p WHERE ean LIKE 'bad%' UNION ALL SELECT 'key collisions', count(*) - count(DISTINCT key) FROM p UNION ALL SELECT 'entities', count(*) FROM m
  UNION ALL SELECT manufacturer || ': rows', count(*) FROM p GROUP BY manufacturer UNION ALL SELECT manufacturer || ': entities', count(*) FROM m GROUP BY manufacturer UNION ALL SELECT manufacturer || ': with barcode', count(ean) FROM m GROUP BY manufacturer UNION ALL SELECT manufacturer || ': confirmed', count(ean) FILTER (WHERE sure) FROM m GROUP BY manufacturer""")
def migration_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.select(_said("k", _k() % 1900).alias("key"), _said("m", _k() % 4).alias("manufacturer"), F.when(_k() % 5 == 0, _said("bad", _k())).when(_k() % 5 < 3, _ean()).alias("ean"))
    made = p.where(_k() % 3 == 0).select(_said("m", _k() % 4).alias("manufacturer"), F.when((_k() % 5).isin(1, 2), _ean()).alias("ean"), F.when(_k() % 2 == 0, "confirmed").otherwise("provisional").alias("confidence"))
    return quality.migration_report(rows, made)


@query("""WITH l AS (SELECT lower(p_brand || p_type) AS k, min(ROW(p_brand, p_type, 'from ' || p_partkey)) AS x FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1), a AS (SELECT p_brand AS brand, p_type AS set_name, 'kept ' || min(p_partkey) AS details FROM part WHERE p_size % 9 = 0 GROUP BY ALL)
  SELECT brand, set_name, details FROM a UNION ALL SELECT x[1], x[2], x[3] FROM l WHERE k NOT IN (SELECT lower(brand || set_name) FROM a)""")
def migration_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migration that is run three times: the archive's rows stay word for word, and the second and third run change nothing."""
    p = table(spark, sf_dir, "part")
    archive = p.where("p_size % 9 = 0").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("set_name")).agg(_said("kept ", F.min(_k())).alias("details"))
    made = {"brand": F.col("p_brand"), "set_name": F.col("p_type"), "details": _said("from ", _k())}
    for _ in range(3):
        archive = catalog.migrated(p.where(_k() % 3 != 0), archive, ["brand", "set_name"], made)
    return archive


@query("""SELECT p_partkey, 'Dark Red ' || p_partkey AS name, CAST(p_partkey AS VARCHAR) AS bare, 'c' || p_partkey AS trimmed, 'x' || p_partkey AS rest FROM part""")
def code_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_k(), text.name_from_slug(_said("dark-red_", _k())).alias("name"), text.without_zeros(_said("00", _k())).alias("bare"), text.without_tail(_said("c", _k(), "PSSP"), "PS").alias("trimmed"), text.without_prefix(_said("pre-x", _k()), "pre-").alias("rest"))
