"""Queries on what runs do: fields of pages by origin, archived evidence, lookups that are due, posts with terms, replayed logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.barcode import ean_from_stem
from ledgerforge.operators import resolve
from ledgerforge.plans.derive import check_sql, table
from ledgerforge.plans.registry import query
from ledgerforge.sources import strategies
from ledgerforge.sources.decisions import DecisionLog
from ledgerforge.sources.shared import shared_path
from ledgerforge.streaming.buckets import BucketedLedger


def _key() -> Column:
    return F.col("p_partkey")


def _said(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _ean(prefix: str) -> Column:
    return ean_from_stem(F.concat(F.lit(prefix), F.lpad(_key().cast("string"), 10, "0")))


def _ean_sql(prefix: str) -> str:
    stem = f"('{prefix}' || lpad(CAST(p_partkey AS VARCHAR), 10, '0'))"
    return f"({stem} || {check_sql(stem)})"


@query(f"""WITH p AS (SELECT p_partkey AS k, p_partkey % 4 = 0 AS ld, p_partkey % 3 <> 1 AS micro, p_partkey % 5 <> 2 AS own, {_ean_sql("50")} AS e, {_ean_sql("51")} AS f FROM part),
  v AS (SELECT *, CASE WHEN micro THEN 'MS' || k WHEN own THEN 'E' || k END AS sku, CASE WHEN ld AND k % 3 = 0 THEN e WHEN own AND k % 7 = 0 THEN f END AS ean, CASE WHEN ld AND k % 5 = 0 THEN 'LB' || k WHEN micro THEN 'MB' || k END AS brand FROM p),
  n AS (SELECT *, CASE WHEN ld THEN 'L' || k WHEN micro AND k % 6 = 0 THEN 'M' || k WHEN coalesce(sku, ean, brand) IS NOT NULL THEN 'Head ' || k END AS name FROM v)
  SELECT k, name, sku, ean, brand, CASE WHEN name LIKE 'L%' THEN 'jsonld' WHEN name LIKE 'M%' THEN 'microdata' WHEN name IS NOT NULL THEN 'heading' END AS name_from, CASE WHEN sku LIKE 'M%' THEN 'microdata' WHEN sku IS NOT NULL THEN 'embedded' END AS sku_from,
  CASE WHEN ean = e THEN 'jsonld' WHEN ean IS NOT NULL THEN 'embedded' END AS ean_from, CASE WHEN brand LIKE 'L%' THEN 'jsonld' WHEN brand IS NOT NULL THEN 'microdata' END AS brand_from FROM n""")
def page_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of pages that have JSON-LD, microdata with a brand of its own scope, an embedded object, or some of them, and a heading."""
    k, none = _key(), F.lit("")
    ld = _said('<script type="application/ld+json">{"@type":"Product","name":"L', k, '"', F.when(k % 3 == 0, _said(',"gtin13":"', _ean("50"), '"')).otherwise(none), F.when(k % 5 == 0, _said(',"brand":{"name":"LB', k, '"}')).otherwise(none), "}</script>")
    micro = _said('<div itemscope itemtype="https://schema.org/Product"><p itemprop="brand" itemscope itemtype="https://schema.org/Brand"><i itemprop="name">MB', k, "</i></p>", F.when(k % 6 == 0, _said('<b itemprop="name">M', k, "</b>")).otherwise(none), '<meta itemprop="sku" content="MS', k, '"></div>')
    own = _said('<script>var BCData = {"product_attributes":{"sku":"E', k, '","upc":', F.when(k % 7 == 0, _said('"', _ean("51"), '"')).otherwise(F.lit("null")), "}};</script>")
    body = F.concat(F.when(k % 4 == 0, ld).otherwise(none), F.when(k % 3 != 1, micro).otherwise(none), F.when(k % 5 != 2, own).otherwise(none), _said("<h1>Head ", k, " | Shop</h1>"))
    found = strategies.page_fields(table(spark, sf_dir, "part").select(k.alias("k"), body.alias("body")))
    return found.select("k", "name", "sku", "ean", "brand", *(F.try_element_at("origins", F.lit(f)).alias(f"{f}_from") for f in ("name", "sku", "ean", "brand")))


@query(f"""WITH p AS (SELECT p_partkey AS k, p_partkey % 2 = 0 AS old, p_partkey % 3 = 0 AS shop, p_partkey % 3 = 0 AND p_partkey % 5 < 3 AS live, {_ean_sql("50")} AS e, {_ean_sql("51")} AS f FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0),
  v AS (SELECT *, CASE WHEN k % 4 = 0 THEN e ELSE f END AS shop_ean FROM p)
  SELECT k, CASE WHEN NOT shop THEN 'discontinued' WHEN live THEN 'current' ELSE 'suspected-discontinued' END AS status, CASE WHEN shop THEN shop_ean ELSE e END AS ean,
  CASE WHEN NOT (old AND shop) OR shop_ean = e THEN 'single' WHEN live THEN 'authority' ELSE 'conflicted' END AS decision, old AS archived FROM v""")
def archived_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of an archive beside a shop's listing: what only the archive has is discontinued, and its barcodes decide nothing."""
    k = _key()
    p = table(spark, sf_dir, "part")
    caught = p.where(k % 2 == 0).select(_said("https://e.org/item/", k).alias("original"), F.lit("2020").alias("timestamp"), F.lit("200").alias("status"))
    old = strategies.STRATEGIES["cdx-archive"](caught, "arc").select(F.substring_index("url", "/", -1).cast("long").alias("p_partkey"), "key", "archived")
    old = old.select("p_partkey", "key", "archived", F.lit("archive").alias("kind"), F.lit(3).alias("priority"), F.lit(0).alias("miss_streak"), _ean("50").alias("ean"))
    shop = p.where(k % 3 == 0).select(k, _said("shop:", k).alias("key"), F.lit(False).alias("archived"), F.lit("manufacturer").alias("kind"), F.lit(1).alias("priority"), (k % 5).cast("int").alias("miss_streak"), F.when(k % 4 == 0, _ean("50")).otherwise(_ean("51")).alias("ean"))
    rows = old.unionByName(shop).withColumns({"source": F.split_part("key", F.lit(":"), F.lit(1)), "claimed": F.lit(None).cast("string"), "code": F.col("p_partkey").cast("string"), "surviving": F.lit(None).cast("string"), "superseded": F.lit(False)})
    rows = rows.withColumn("live", ~F.col("archived") & (F.col("miss_streak") < 3))
    status = resolve.lifecycle(rows, "p_partkey").select("p_partkey", "status")
    eans = resolve.corroborated_eans(rows, "p_partkey").select("p_partkey", "ean", "decision")
    return status.join(eans, "p_partkey").join(rows.groupBy("p_partkey").agg(F.bool_or("archived").alias("archived")), "p_partkey").withColumnRenamed("p_partkey", "k")


@query(f"""WITH e AS (SELECT p_partkey AS k, {_ean_sql("50")} AS ean FROM part WHERE p_partkey % 3 = 0), a AS (SELECT k, ean, CASE WHEN k % 6 = 0 THEN DATE '2024-01-01' + CAST(k % 200 AS INTEGER) END AS day FROM e)
  SELECT ean FROM a WHERE day IS NULL OR day <= DATE '2024-06-01' - 90 ORDER BY day NULLS FIRST, ean LIMIT 400""")
def due_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes of provisional entities that were never looked up, or long ago, within a budget."""
    p = table(spark, sf_dir, "part")
    entities = p.select(_key().alias("entity"), _ean("50").alias("ean"), F.when(_key() % 3 == 0, "provisional").otherwise("confirmed").alias("confidence"))
    asked = p.where(_key() % 6 == 0).select(_ean("50").alias("ean"), F.date_add(F.lit("2024-01-01").cast("date"), (_key() % 200).cast("int")).alias("date"))
    return strategies.lookup_queue(entities, asked, "2024-06-01", budget=400)


@query("""SELECT 'w:' || p_partkey AS key, CASE WHEN p_partkey % 3 < 2 THEN 'Set ' || (p_partkey % 7) || ',Line ' || (p_partkey % 3) ELSE 'Set ' || (p_partkey % 7) END AS terms, CASE WHEN p_partkey % 2 = 0 THEN 'https://e.org/m' || p_partkey || '.png' END AS image FROM part WHERE p_partkey % 7 IN (1, 2)
  UNION ALL SELECT 'missing:' || p_partkey, NULL, NULL FROM part WHERE p_partkey % 2 = 1""")
def posts_with_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of two paint sets with the names of their terms, as far as they are listed, and their media; and the media to ask for."""
    k, p = _key(), table(spark, sf_dir, "part")
    post = F.struct(k.alias("id"), _said("s", k).alias("slug"), F.struct(_said("P ", k).alias("rendered")).alias("title"), F.array(k % 7, k % 3 + 100).alias("categories"), k.alias("featured_media"))
    pages = p.groupBy(F.floor(k / 50).alias("place")).agg(F.to_json(F.collect_list(post)).alias("body"))
    sets = p.select((k % 7).alias("id")).distinct().select("id", _said("Set ", F.col("id")).alias("name"))
    lines = p.select((k % 3).alias("n")).where("n < 2").distinct().select((F.col("n") + 100).alias("id"), _said("Line ", F.col("n")).alias("name"))
    media = p.where(k % 2 == 0).select(k.alias("id"), _said("https://e.org/m", k, ".png").alias("url"))
    found = strategies.STRATEGIES["wp-rest-paints"](pages, "w", terms=sets.unionByName(lines), media=media, paint_terms=["Set 1", "Set 2"])
    asked = strategies.missing_media(pages, media).select(_said("missing:", F.col("id")).alias("key"), F.lit(None).cast("string").alias("terms"), F.lit(None).cast("string").alias("image"))
    return found.select("key", F.try_element_at("hints", F.lit("terms")).alias("terms"), "image").unionByName(asked)


@query("""WITH l AS (SELECT 'h' || o_custkey AS input, o_orderkey % 4 AS run, o_orderkey AS place, o_orderpriority AS choice, (o_orderkey % 100) / 100.0 AS confidence FROM orders),
  k AS (SELECT * FROM l WHERE run < 3 OR place < (SELECT max(place) FROM l WHERE run = 3)), d AS (SELECT input, arg_max(choice, ROW(run, place)) AS choice, max(ROW(run, place)) AS at FROM k GROUP BY input)
  SELECT c_custkey AS customer, CASE WHEN d.input IS NULL THEN 'pending' WHEN (d.at[2] % 100) / 100.0 >= 0.5 THEN d.choice ELSE 'refused' END AS outcome FROM customer LEFT JOIN d ON d.input = 'h' || c_custkey""")
def decision_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs of decisions, one of them appended twice, one compacted, the last cut off in its last line; what candidates get of them."""
    log = DecisionLog(spark, shared_path(spark, "decisions"))
    k = F.col("o_orderkey")
    said = table(spark, sf_dir, "orders").select(_said("h", F.col("o_custkey")).alias("input"), (k % 4).alias("run"), k.alias("place"), F.lit("item").alias("item"), F.col("o_orderpriority").alias("choice"), ((k % 100) / 100.0).alias("confidence"))
    for run in (1, 0):
        log.append(said.where(F.col("run") == run))
    log.compact()
    for run in (1, 2):
        log.append(said.where(F.col("run") == run))
    last = said.where("run = 3")
    cut = last.agg(F.max("place").alias("cut"))
    line = F.to_json(F.struct(*said.columns))
    last.join(F.broadcast(cut)).select(F.when(F.col("place") == F.col("cut"), F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(f"{log.path}/log/torn")
    candidates = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), _said("h", F.col("c_custkey")).alias("input"))
    accepted = log.accepted(candidates, 0.5).select("customer", F.col("choice").alias("outcome"))
    waiting = log.pending(candidates).select("customer", F.lit("pending").alias("outcome"))
    done = accepted.unionByName(waiting)
    return done.unionByName(candidates.join(done.select("customer"), "customer", "left_anti").select("customer", F.lit("refused").alias("outcome")))


@query("""WITH e AS (SELECT user_id AS key, CAST(ts AS DATE) AS d, event_type FROM events)
  SELECT key, min(d) AS first_seen, max(d) AS last_seen, max(ROW(d, event_type))[2] AS event_type FROM e GROUP BY key""")
def bucketed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events as batches out of order, one of them twice, with a compaction between."""
    ledger = BucketedLedger(spark, shared_path(spark, "ledger"), "key long, first_seen date, last_seen date, event_type string", buckets=8)
    day = F.to_date("ts")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), day.alias("first_seen"), day.alias("last_seen"), "event_type", (F.dayofyear(day) % 5).alias("n"))
    for k in (3, 1, 4):
        ledger.apply(rows.where(F.col("n") == k), k)
    ledger.compact()
    for k in (0, 3, 2, 0):
        ledger.apply(rows.where(F.col("n") == k), k)
    return ledger.read()
