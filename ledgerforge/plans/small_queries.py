"""Queries on single functions and small operators, over rows made of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import barcode, color, extract, rules, text
from ledgerforge.operators import catalog, enrich, equivalence, ledger, quality, raster
from ledgerforge.operators import resolve as R
from ledgerforge.plans import publish
from ledgerforge.plans.derive import PAINTS_SQL, paints, table
from ledgerforge.plans.registry import query
from ledgerforge.sources.tables import with_labels

I = F.col  # noqa: E741


def part_key() -> Column:
    return I("p_partkey")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def _text(x: Column) -> Column:
    return x.cast("string")


@query("SELECT p_partkey, p_name || '|' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_brand END || '|' || p_size AS key FROM part")
def joined_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("p_partkey", text.joined_key(I("p_name"), F.when(part_key() % 2 != 0, I("p_brand")), I("p_size")).alias("key"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN '#' || printf('%06x', p_partkey * 37 % 16777216) END AS shown, CASE WHEN p_partkey % 5 > 1 THEN CAST(p_partkey * 37 % 16777216 // 256 % 256 AS INTEGER) END AS green FROM part")
def hex_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitals with and without a mark; blank; a digit short is shown, but has no channels."""
    bare = F.lpad(F.hex(part_key() * 37 % 16777216), 6, "0")
    raw = F.when(part_key() % 5 == 0, "  ").when(part_key() % 5 == 1, F.concat(F.lit("#"), bare)).otherwise(F.concat(F.lit(" "), bare))
    channel = text.hex_channel(F.when(part_key() % 5 == 1, F.substring(raw, 1, 6)).otherwise(raw), 1)
    return _parts(spark, sf_dir).select("p_partkey", text.hex_display(raw).alias("shown"), channel.alias("green"))


@query(r"SELECT page_id, regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1) AS last FROM pages")
def last_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.last_segment(I("url")).alias("last"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN substr(lpad(CAST(p_partkey AS VARCHAR), 5, '0'), 1, 2) || '.' || substr(lpad(CAST(p_partkey AS VARCHAR), 5, '0'), 3) ELSE 'x' || p_partkey END AS code, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' ' || p_partkey END AS once, '{\"a\": ' || p_partkey || '}' AS body FROM part")
def text_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of five digits get their dot, names said twice are said once, fenced bodies come bare."""
    code = F.when(part_key() % 2 == 0, F.lpad(_text(part_key()), 5, "0")).otherwise(F.concat(F.lit("x"), _text(part_key())))
    said = F.when(part_key() % 3 == 0, F.concat("p_name", F.lit(" "), F.upper("p_name"))).otherwise(F.concat("p_name", F.lit(" "), _text(part_key())))
    body = F.concat(F.lit('```json\n{"a": '), _text(part_key()), F.lit("}\n```"))
    return _parts(spark, sf_dir).select("p_partkey", text.code_dotted(code).alias("code"), text.halves_merged(said).alias("once"), text.without_fence(body).alias("body"))


@query("SELECT o_orderkey, year(o_orderdate) || '.' || month(o_orderdate) || '.' || day(o_orderdate) AS version FROM orders")
def version_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.version_of(F.to_date("o_orderdate")).alias("version"))


@query("SELECT p_partkey, CAST(round_even(p_partkey * 100 / 8.0, 0) AS BIGINT) AS cents, CAST(floor(sqrt((p_size - 3) ** 2 + (p_size % 7) ** 2 + 16.0) * 1000 + 1e-6) AS BIGINT) AS milli FROM part")
def colour_roundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighths to two decimals, halves to even; distances in the colour cube."""
    cents = F.round(color.rounded(part_key() / 8.0) * 100).cast("long")
    far = color.rgb_distance((I("p_size"), I("p_size") % 7, F.lit(4)), (F.lit(3), F.lit(0), F.lit(0)))
    return _parts(spark, sf_dir).select("p_partkey", cents.alias("cents"), F.floor(far * 1000 + 1e-6).alias("milli"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'General' ELSE 'deep' || p_partkey END AS term, CASE p_partkey % 4 WHEN 0 THEN 'one' WHEN 1 THEN 'two' END AS mapped FROM part")
def path_and_tag_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part of a path that isn't to be skipped, however deep (beyond a hundred parts here); the first tag in order that a map has."""
    path = F.concat(F.lit("Root > Shop"), F.repeat(F.lit(" > Shop"), 120), F.when(part_key() % 3 == 0, F.lit(" >  ")).otherwise(F.concat(F.lit(" > deep"), _text(part_key()))))
    tags = F.when(part_key() % 4 == 0, F.array(F.lit("z"), F.lit("a"), F.lit("b"))).when(part_key() % 4 == 1, F.array(F.lit("c"), F.lit("b"))).otherwise(F.array(F.lit("q")))
    mapping = F.create_map(F.lit("a"), F.lit("one"), F.lit("b"), F.lit("two"))
    return _parts(spark, sf_dir).select("p_partkey", extract.hierarchy_term(path, ["Shop"]).alias("term"), extract.first_mapped(tags, mapping).alias("mapped"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AND CAST(o_orderdate AS DATE) > DATE '1997-01-01' AS later FROM orders")
def future_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.to_date("o_orderdate"), I("o_orderkey")
    raw = F.when(k % 3 == 0, _text(day)).when(k % 3 == 1, "soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", extract.future(raw, F.lit("1997-01-01").cast("date")).alias("later"))


@query("SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 11, '1') AS sku, 'Frogs ' || p_partkey AS name, p_size + CASE p_partkey % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 0 END AS price FROM part")
def legacy_shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by their meta element or the title before its separator; pence behind a point, raised, or none."""
    name = F.concat(F.lit("Frogs "), _text(part_key()))
    head = F.when(part_key() % 2 == 0, F.concat(F.lit('<title>x</title><meta property="og:title" content="'), name, F.lit(' | Shop">'))).otherwise(F.concat(F.lit("<title>"), name, F.lit(" - Shop</title>")))
    price = F.concat(F.lit(" £"), _text(I("p_size")), F.when(part_key() % 3 == 0, "<sup>50</sup>").when(part_key() % 3 == 1, ".25").otherwise(""))
    page = extract.legacy_page(F.concat(head, F.lit(" no. "), F.lpad(_text(part_key()), 11, "1"), price))
    return _parts(spark, sf_dir).select("p_partkey", page.alias("x")).select("p_partkey", "x.sku", "x.name", "x.price")


@query("SELECT p_partkey, printf('%06x', p_partkey) AS hex, CASE p_partkey % 4 WHEN 0 THEN 'Gloss' WHEN 1 THEN 'Satin' WHEN 2 THEN 'Metallic' ELSE 'Matte' END AS finish, 'Set ' || p_size AS set_name, CAST(p_size AS INTEGER) AS volume_ml, CASE p_partkey % 3 WHEN 0 THEN 'spray' WHEN 1 THEN 'dropper' ELSE 'pot' END AS packaging FROM part")
def listing_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    finish = F.element_at(F.array(*map(F.lit, ("glossy", "semi-gloss finish", "metal", "flat"))), (part_key() % 4 + 1).cast("int"))
    finish = F.when(part_key() % 4 == 1, F.lit("satin")).otherwise(finish)
    pack = F.element_at(F.array(*map(F.lit, ("aerosol", "bottle", "jar"))), (part_key() % 3 + 1).cast("int"))
    card = F.concat(F.lit('<b>Set:</b> Set '), _text(I("p_size")), F.lit('<i style="color:#'), F.lpad(F.upper(F.hex(part_key())), 6, "0"), F.lit('">'), finish, F.lit("</i> "), _text(I("p_size")), F.lit(" ml "), pack)
    return _parts(spark, sf_dir).select("p_partkey", extract.card_fields(card).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '12345' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS ean, 'n' || p_partkey AS name, CASE WHEN p_partkey % 4 <> 0 THEN '{\"sku\": \"}' || p_partkey || '\"}' END AS object FROM part")
def odd_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plausible barcodes among zeros and letters; what follows the last colon; an object whose text has a brace, or that is broken."""
    k = _text(part_key())
    raw = F.when(part_key() % 3 == 0, F.concat(F.lit("12345"), F.lpad(k, 5, "0"))).when(part_key() % 3 == 1, "00000000").otherwise(F.concat(F.lit("12345x"), k))
    body = F.when(part_key() % 4 != 0, F.concat(F.lit('var BCData = {"sku": "}'), k, F.lit('"}; x = {};'))).otherwise("var BCData = {oops")
    return _parts(spark, sf_dir).select("p_partkey", barcode.plausible_barcode(raw).alias("ean"), extract.after_colon(F.concat(F.lit("a: b:  n"), k)).alias("name"), extract.embedded_object(body).alias("object"))


@query("SELECT o_orderpriority AS partition, '{\"schemaVersion\":1,\"kind\":\"order\",\"version\":\"2024.1.2\",\"partition\":\"' || o_orderpriority || '\",\"counts\":{\"items\":' || count(*) || '},\"items\":[' || string_agg('{\"id\":' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ',\"note\":\"' || o_orderstatus || '\"' ELSE '' END || '}', ',' ORDER BY o_orderkey) || ']}' AS body, count(*) AS records FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 50 = 1 GROUP BY 1")
def partition_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderkey % 50 < 2").select(I("o_orderpriority").alias("part"), I("o_orderkey").alias("id"), F.when(I("o_orderkey") % 2 == 0, I("o_orderstatus")).alias("note"))
    return publish.documents(o, "part", ["id"], "order", "2024.1.2").select("partition", "body", "records")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 2 END AS times FROM orders WHERE o_orderkey % 3 <> 1")
def uncovered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("key"))
    members = o.where("key % 3 <> 0").unionByName(o.where("key % 3 = 2"))
    return quality.uncovered(o, members).select(I("key").alias("o_orderkey"), I("times").cast("int").alias("times"))


@query("SELECT DISTINCT o_custkey AS ean FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0")
def lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(I("c_custkey").alias("ean"))
    return quality.lost_values(table(spark, sf_dir, "orders").select(I("o_custkey").alias("ean")), c.where("ean % 3 = 0"), c.where("ean % 5 = 0"))


@query("SELECT c_custkey AS item FROM customer WHERE c_custkey % 4 <> 3 AND c_custkey % 5 >= 4")
def accepted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known choices and nulls, sure enough; one in four names an unknown one."""
    c = table(spark, sf_dir, "customer").select(I("c_custkey").alias("item"), F.when(I("c_custkey") % 4 == 3, "?").when(I("c_custkey") % 4 != 2, I("c_mktsegment")).alias("choice"), ((I("c_custkey") % 5) / 5.0).alias("confidence"))
    known = table(spark, sf_dir, "customer").select(I("c_custkey").alias("item"), I("c_mktsegment").alias("choice"))
    return quality.accepted(c, known, 0.8).select("item")


@query("""WITH i AS (SELECT o_orderkey AS key, o_orderkey % 4 = 0 AS moved, o_orderkey % 5 <> 0 AS known, o_orderkey % 3 AS f, o_orderkey % 2 = 0 AS got, CAST(o_orderkey % 7 AS INTEGER) AS had FROM orders)
SELECT key, CASE WHEN f = 0 OR NOT known THEN CASE WHEN moved THEN '2' ELSE '1' END ELSE '1' END AS updated_at, CASE WHEN f = 0 AND got THEN 'new' WHEN known THEN 'old' END AS value,
  CAST(CASE WHEN f = 0 AND got THEN 0 WHEN f = 0 THEN CASE WHEN known AND NOT moved THEN had ELSE 0 END + 1 WHEN known THEN had ELSE 0 END AS INTEGER) AS misses FROM i""")
def carried_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the items was fetched well, half of these with a value; a third failed; one in four changed, one in five is new."""
    o, k = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("key")), I("key")
    items = o.select("key", F.when(k % 4 == 0, "2").otherwise("1").alias("updated_at"))
    state = o.where(k % 5 != 0).select("key", F.lit("1").alias("updated_at"), F.lit("old").alias("value"), (k % 7).cast("int").alias("misses"))
    fetched = o.where(k % 3 < 2).select("key", (k % 3 == 0).alias("ok"), F.when(k % 2 == 0, "new").alias("value"))
    return ledger.carried(state, fetched, items)


@query("SELECT n_nationkey, r_name AS label FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND n_nationkey % 3 <> 0")
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.when(I("n_nationkey") % 3 != 0, _text(I("n_regionkey"))).alias("slug"))
    labels = table(spark, sf_dir, "region").select(_text(I("r_regionkey")).alias("slug"), I("r_name").alias("label"))
    return with_labels(n, labels, "slug", "label").select("n_nationkey", "label")


@query("""WITH r AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey = 1 THEN 'k0-3' ELSE 'k' || n_regionkey END AS key FROM nation), n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY id) AS n FROM r)
SELECT id, CASE WHEN n = 1 THEN key WHEN key = 'k0' AND n >= 3 THEN key || '-' || (n + 1) ELSE key || '-' || n END AS key FROM n""")
def free_key_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row has a key of its own that is another's with a suffix: that number is passed over."""
    n = table(spark, sf_dir, "nation").select(I("n_nationkey").alias("id"), F.when(I("n_nationkey") == 1, "k0-3").otherwise(F.concat(F.lit("k"), _text(I("n_regionkey")))).alias("key"))
    return catalog.free_suffixes(n, "id")


@query(f"WITH {PAINTS_SQL}, d AS (SELECT brand, abs(r - g) AS d FROM paint) SELECT list_sort(list(d))[count(*) // 2 + 1] AS middle, CAST(round(avg(CASE WHEN d <= 40 THEN 1.0 ELSE 0 END) * 1e6) AS BIGINT) AS within FROM d")
def colour_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.calibration(paints(spark, sf_dir).select(F.abs(I("r") - I("g")).alias("d")), "d")
    return out.select("middle", F.round(I("within") * 1e6).cast("long").alias("within"))


@query("SELECT 'a' || s_suppkey AS key, 'm' || s_suppkey || '/new' AS entity FROM supplier UNION ALL SELECT 'b' || s_suppkey, 'm' || s_suppkey || '/x' FROM supplier")
def aliased_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three entities of each supplier an alias renames one, and one is retracted."""
    s = table(spark, sf_dir, "supplier").select(_text(I("s_suppkey")).alias("s"), F.explode(F.array(*map(F.lit, "abx"))).alias("n"))
    rows = s.select(F.concat(F.translate("n", "xb", "bc"), "s").alias("key"), F.lit("a").alias("source"), F.lit("retailer").alias("kind"), F.lit(1).alias("priority"), F.concat(F.lit("m"), "s").alias("manufacturer"), F.when(I("n") != "x", F.upper("n")).alias("code"), F.lit(None).cast("string").alias("ean"), I("n").alias("name"))
    of = lambda code: F.concat(F.lit("m"), "s", F.lit(f"/{code}"))
    each = s.select("s").distinct()
    out = R.resolve(rows, F.lower("name"), aliases=each.select(of("A").alias("old"), of("new").alias("new")), retracted=each.select(of("B").alias("entity")))
    return out.select("key", "entity")


def _type_rules() -> list[tuple[int, str | None, str, str, str]]:
    """Three hundred invented rules, of brands and of none, on sets and names, some of whose parts are parts of others'."""
    parts = ("ECONOMY", "small", "Standard", "medium", "PROMO", "large", "ec", "mall", "dar", "um", "lar", "red", "blue", "hot", "ring", "widget", "bolt", "gear", "e b", "d w", "t g", "in", "zz")
    return [(k, f"Brand#{1 + k * 3 % 25}" if k % 4 or k > 250 else None, "name" if k % 2 else "set_name", parts[k * 5 % len(parts)], f"T{k % 17}") for k in range(300, 0, -1)]


@query(f"""WITH {PAINTS_SQL}, r(no, brand, field, part, result) AS (VALUES {", ".join(f"({n}, {f"'{b}'" if b else "NULL"}, '{f}', '{p.lower()}', '{r}')" for n, b, f, p, r in _type_rules())}),
  m AS (SELECT id, no, result, row_number() OVER (PARTITION BY id ORDER BY r.brand IS NULL, no) AS k FROM paint JOIN r ON contains(lower(CASE WHEN field = 'name' THEN name ELSE set_name END), part) AND (r.brand IS NULL OR r.brand = paint.brand))
  SELECT paint.id, no AS rule, coalesce(result, 'Standard') AS result FROM paint LEFT JOIN m ON m.id = paint.id AND k = 1""")
def type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of three hundred substring rules, those of a brand before those of any."""
    return rules.substring_rules(paints(spark, sf_dir).select("id", "brand", "set_name", "name"), _type_rules(), default="Standard").select("id", "rule", "result")


@query(f"""WITH {PAINTS_SQL}, o AS (SELECT id, CASE WHEN id % 4 = 0 THEN '#' || printf('%02X', r) || '80' || printf('%02X', b) WHEN id % 4 = 1 THEN '#' || printf('%02X%02X%02X', r, g, b) END AS hex, CASE WHEN id % 2 = 0 THEN 'n' || id END AS name FROM paint WHERE id % 3 <> 0)
  SELECT p.id, coalesce(o.name, p.name) AS name, coalesce(o.hex, '#' || printf('%02X%02X%02X', p.r, p.g, p.b)) AS hex, p.r AS r, CASE WHEN o.hex IS NOT NULL AND p.id % 4 = 0 THEN 128 ELSE p.g END AS g, p.b AS b FROM paint p LEFT JOIN o ON o.id = p.id""")
def recoloured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides of names and colours: channels follow a new hex, written in lower case without its mark; what is no colour changes nothing."""
    two = lambda c: F.lpad(F.hex(c), 2, "0")
    p = paints(spark, sf_dir).select("id", "name", "r", "g", "b").withColumn("hex", F.concat(F.lit("#"), two("r"), two("g"), two("b")))
    over = F.when(I("id") % 4 == 0, F.concat(F.lower(two("r")), F.lit("80"), F.lower(two("b")))).when(I("id") % 4 == 1, F.concat(F.lit(" #"), two("r"), two("g"), two("b"))).when(I("id") % 4 == 2, "#12")
    more = p.where("id % 3 <> 0").select("id", over.alias("hex"), F.when(I("id") % 2 == 0, F.concat(F.lit("n"), I("id").cast("string"))).alias("name"))
    return enrich.override_colours(p, more, ["id"], ["name"]).select("id", "name", "hex", "r", "g", "b")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS name, event_id % 5 AS k, CASE WHEN event_id % 4 <> 0 THEN event_type || event_id % 7 END AS v FROM events),
  n AS (SELECT user_id, arg_min(name, event_id) FILTER (WHERE name IS NOT NULL) AS name FROM e GROUP BY 1), h AS (SELECT user_id, k, arg_min(v, event_id) AS v FROM e WHERE v IS NOT NULL GROUP BY ALL)
  SELECT n.user_id, n.name, string_agg('h' || k || '=' || v, ',' ORDER BY k) AS hints FROM n LEFT JOIN h USING (user_id) GROUP BY ALL""")
def merged_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first name of a user's events and, of their hints, the first value of each key."""
    k = I("event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(k % 3 != 0, I("event_type")).alias("name"), F.create_map(F.concat(F.lit("h"), _text(k % 5)), F.when(k % 4 != 0, F.concat("event_type", _text(k % 7)))).alias("hints"))
    out = enrich.merged_first(rows, ["user_id"], "event_id", ["name"], "hints")
    said = F.array_join(F.transform(F.array_sort(F.map_entries("hints")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return out.select("user_id", "name", F.nullif(said, F.lit("")).alias("hints"))


@query(f"""WITH {PAINTS_SQL}, first AS (SELECT brand, set_name, name, min(id) AS id FROM paint GROUP BY ALL), l AS (SELECT p.id, q.brand, q.set_name, q.name, p.id % 7 AS d FROM paint p JOIN paint q ON q.id = p.id - p.id % 5 AND p.id % 11 <> 0)
  SELECT a.id AS a, b.id AS b, min(d) AS distance FROM l JOIN paint p USING (id) JOIN first a ON a.brand = p.brand AND a.set_name = p.set_name AND a.name = p.name JOIN first b ON b.brand = l.brand AND b.set_name = l.set_name AND b.name = l.name WHERE a.id <> b.id GROUP BY ALL""")
def links_by_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose ends are named by brand, set and name; some lead nowhere or to themselves."""
    p = paints(spark, sf_dir).select("id", "brand", "set_name", "name")
    to = F.when(I("id") % 11 == 0, -1).otherwise(I("id") - I("id") % 5)
    other = p.select(I("id").alias("to"), *(I(c).alias(f"{c}_b") for c in ("brand", "set_name", "name")))
    links = p.withColumn("to", to).join(other, "to", "left").select(*(I(c).alias(f"{c}_a") for c in ("brand", "set_name", "name")), *(F.coalesce(f"{c}_b", F.lit("nowhere")).alias(f"{c}_b") for c in ("brand", "set_name", "name")), (I("id") % 7).alias("distance"))
    return equivalence.linked_by_key(links, p, ["brand", "set_name", "name"])
