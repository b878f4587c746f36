"""Queries on enrichment joins, state between runs, rankings, reports and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import extract
from ledgerforge.functions.text import canonical_hash
from ledgerforge.operators import catalog as C
from ledgerforge.operators import enrich as E
from ledgerforge.operators import ledger as L
from ledgerforge.operators import quality as Q
from ledgerforge.operators import raster
from ledgerforge.plans import publish as P
from ledgerforge.plans.derive import OBS_SQL, PAINTS_SQL, observations, paints, table
from ledgerforge.plans.registry import query

I = F.col  # noqa: E741


@query("""WITH b AS (SELECT p_partkey AS id, p_name AS name, p_type AS set_name FROM part WHERE p_partkey % 3 <> 0), n AS (SELECT p_partkey + 1000000 AS id, upper(p_name) AS name, p_type AS set_name FROM part WHERE p_partkey % 2 = 0)
SELECT * FROM b UNION ALL SELECT min(id), arg_min(name, id), arg_min(set_name, id) FROM n ANTI JOIN b ON lower(n.name) = lower(b.name) AND lower(n.set_name) = lower(b.set_name) GROUP BY lower(name), lower(set_name)""")
def additions_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(I("p_partkey").alias("id"), I("p_name").alias("name"), I("p_type").alias("set_name"))
    new = p.where("id % 2 = 0").select((I("id") + 1000000).alias("id"), F.upper("name").alias("name"), "set_name")
    return E.additions(p.where("id % 3 <> 0"), new, ["name", "set_name"], "id")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 'more' WHEN s_suppkey % 3 = 0 THEN ' ' ELSE s_name END AS name FROM supplier""")
def blank_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(I("s_suppkey") % 3 == 0, " ").otherwise(I("s_name")).alias("name"))
    more = s.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("more").alias("name"))
    filled = E.fill_blanks(s, more, ["s_suppkey"], ["name"])
    return filled.select("s_suppkey", F.coalesce("name", F.lit(" ")).alias("name"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'over' ELSE s_name END AS name FROM supplier")
def override_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", I("s_name").alias("name"))
    more = s.where("s_suppkey % 2 = 0").select("s_suppkey", F.when(I("s_suppkey") % 4 == 0, "over").otherwise("").alias("name"))
    return E.fill_blanks(s, more, ["s_suppkey"], ["name"], wins=True)


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE 'old' END AS origin FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0")
def ratchet_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return E.ratchet(p.where("p_partkey % 2 = 0").select("p_partkey", F.lit("new").alias("origin")), p.where("p_partkey % 3 = 0").select("p_partkey", F.lit("old").alias("origin")), ["p_partkey"])


@query("""WITH p AS (SELECT p_partkey, lower(p_name) || p_partkey % 1500 AS name FROM part), d AS (SELECT name, min(p_partkey) AS id FROM p GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1) SELECT p_partkey, d.id AS match FROM p JOIN d USING (name)""")
def unique_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lower("p_name"), (I("p_partkey") % 1500).cast("string")).alias("name"))
    return p.join(E.unique_only(p.select(I("p_partkey").alias("match"), "name"), "name", "match"), "name").select("p_partkey", "match")


@query("""WITH d AS (SELECT p_partkey AS id, CAST(p_partkey * 37 AS VARCHAR) AS name FROM part WHERE length(CAST(p_partkey * 37 AS VARCHAR)) >= 4), c AS (SELECT p_partkey AS claim, 'x' || CAST(p_partkey * 74 AS VARCHAR) || CAST(p_partkey * 37 AS VARCHAR) AS text FROM part),
m AS (SELECT claim, id, length(name) AS n FROM c JOIN d ON ends_with(text, name)), b AS (SELECT claim, max(n) AS n FROM m GROUP BY 1)
SELECT claim, min(id) AS match FROM m JOIN b USING (claim, n) GROUP BY claim HAVING count(DISTINCT id) = 1""")
def longest_suffix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, name = table(spark, sf_dir, "part"), (I("p_partkey") * 37).cast("string")
    claims = p.select(I("p_partkey").alias("claim"), F.concat(F.lit("x"), (I("p_partkey") * 74).cast("string"), name).alias("text"))
    return E.longest_suffix(claims, p.select(I("p_partkey").alias("id"), name.alias("name")), 4)


@query("""WITH d AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') ELSE CAST(p_partkey AS VARCHAR) END AS code, 'n' || p_partkey % 700 AS name FROM part WHERE p_partkey % 3 <> 0),
c AS (SELECT code, min(id) AS id FROM d GROUP BY 1 HAVING count(DISTINCT id) = 1), n AS (SELECT name, min(id) AS id FROM d GROUP BY 1 HAVING count(DISTINCT id) = 1)
SELECT p_partkey, coalesce(c1.id, c2.id, n.id) AS match FROM part LEFT JOIN c c1 ON CAST(p_partkey AS VARCHAR) = c1.code LEFT JOIN c c2 ON lpad(CAST(p_partkey AS VARCHAR), 5, '0') = c2.code LEFT JOIN n ON 'n' || p_partkey % 700 = n.name""")
def code_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = I("p_partkey").cast("string")
    p = table(spark, sf_dir, "part").select("p_partkey", key.alias("code"), F.concat(F.lit("N"), (I("p_partkey") % 700).cast("string")).alias("name"))
    dim = p.where("p_partkey % 3 <> 0").select(I("p_partkey").alias("id"), F.when(I("p_partkey") % 2 == 0, F.lpad("code", 5, "0")).otherwise(I("code")).alias("code"), "name")
    return E.code_cascade(p, dim).select("p_partkey", "match")


# A claim is a name with ' ml' behind it. All of a name's characters are then in the claim, in order and together, so the ratio is twice
# the name's length over both lengths; a name of other characters in that brand can't come near it.
@query("""WITH n AS (SELECT p_brand, p_name, min(p_partkey) AS match FROM part GROUP BY ALL) SELECT p_partkey AS claim, match, CAST(floor(2000.0 * length(p_name) / (2 * length(p_name) + 3) + 1e-6) AS BIGINT) AS milli
  FROM part JOIN n USING (p_brand, p_name) WHERE 2.0 * length(p_name) / (2 * length(p_name) + 3) >= 0.86""")
def fuzzy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(I("p_partkey").alias("id"), I("p_name").alias("name"), I("p_brand").alias("brand"))
    claims = p.select(I("id").alias("claim"), F.concat(I("name"), F.lit(" ml")).alias("name"), "brand")
    return E.fuzzy(claims, p, "brand").select("claim", "match", F.floor(I("ratio") * 1000 + 1e-6).alias("milli"))


@query("""WITH r AS (SELECT c_custkey AS id, c_nationkey AS m, CAST(c_custkey // 3 AS VARCHAR) AS ean, c_mktsegment || c_custkey % 50 AS slug, CAST(c_custkey % 400 AS VARCHAR) AS legacy, CAST(c_custkey % 300 AS VARCHAR) AS sku FROM customer),
p AS (SELECT least(x.id, y.id) AS a, greatest(x.id, y.id) AS b, 'ean' AS rule FROM r x JOIN r y ON x.m = y.m AND x.ean = y.ean WHERE x.id <> y.id UNION SELECT least(x.id, y.id), greatest(x.id, y.id), 'name' FROM r x JOIN r y ON x.m = y.m AND x.slug = y.slug WHERE x.id <> y.id UNION SELECT least(x.id, y.id), greatest(x.id, y.id), 'sku' FROM r x JOIN r y ON x.m = y.m AND x.legacy = y.sku WHERE x.id <> y.id)
SELECT a, b, list_sort(list(DISTINCT rule)) AS rules FROM p GROUP BY a, b""")
def pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer"), lambda x: x.cast("string")
    rows = c.select(I("c_custkey").alias("id"), I("c_nationkey").alias("m"), s(F.floor(I("c_custkey") / 3)).alias("ean"), F.concat("c_mktsegment", s(I("c_custkey") % 50)).alias("slug"), s(I("c_custkey") % 400).alias("legacy"), s(I("c_custkey") % 300).alias("sku"))
    m = I("m")
    return E.pair_candidates(rows, {"ean": ([m, I("ean")], [m, I("ean")]), "name": ([m, I("slug")], [m, I("slug")]), "sku": ([m, I("legacy")], [m, I("sku")])})


# A key is a user, a sweep a day; the state is what was seen up to the 15th, the run what the 16th saw.
STATE = "st AS (SELECT user_id AS key, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, CAST(user_id % 3 AS INTEGER) AS miss_streak FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15' AND user_id % 5 <> 0 GROUP BY user_id), sn AS (SELECT DISTINCT user_id AS key, DATE '2024-01-16' AS d FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16' AND user_id % 2 = 0)"


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    state = e.where("d <= DATE'2024-01-15' AND user_id % 5 <> 0").groupBy(I("user_id").alias("key")).agg(F.min("d").alias("first_seen"), F.max("d").alias("last_seen")).withColumn("miss_streak", (I("key") % 3).cast("int"))
    seen = e.where("d = DATE'2024-01-16' AND user_id % 2 = 0").select(I("user_id").alias("key"), I("d").alias("first_seen"), I("d").alias("last_seen"), F.lit(0).alias("miss_streak")).distinct()
    return state, seen


@query(f"WITH {STATE} SELECT coalesce(st.key, sn.key) AS key, least(first_seen, d) AS first_seen, greatest(last_seen, d) AS last_seen, CAST(CASE WHEN sn.key IS NULL THEN miss_streak ELSE 0 END AS INTEGER) AS miss_streak FROM st FULL JOIN sn ON st.key = sn.key")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.upsert(*_state(spark, sf_dir))


@query(f"WITH {STATE} SELECT key, CAST(miss_streak + CASE WHEN key IN (SELECT key FROM sn) THEN 0 ELSE 1 END AS INTEGER) AS miss_streak FROM st")
def mark_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.mark_missed(*_state(spark, sf_dir), full_sweep=True).select("key", "miss_streak")


@query("""WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), n AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM s), l AS (SELECT user_id AS key, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1)
SELECT key, CAST((SELECT max(n) FROM n) - n AS BIGINT) AS streak FROM l JOIN n USING (d)""")
def miss_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(I("user_id").alias("key"), F.to_date("ts").alias("sweep"))
    return L.miss_streaks(e.select("sweep"), e).select("key", I("streak").cast("long").alias("streak"))


LIVE = """rc AS (SELECT o_orderkey AS path, 's' || o_orderkey % 3 AS source, DATE '2024-01-01' AS last_seen, CAST(o_orderkey % 5 AS INTEGER) AS miss_streak, o_orderkey % 5 >= 3 AS flagged FROM orders),
lv AS (SELECT *, source <> 's2' AS ran, path % 4 = 0 AS hit FROM rc), le AS (SELECT *, CASE WHEN NOT ran THEN miss_streak WHEN hit THEN 0 ELSE miss_streak + 1 END AS sk, CASE WHEN ran AND hit AND flagged THEN 'reactivate' WHEN ran AND NOT hit AND miss_streak + 1 = 3 THEN 'flag' END AS event FROM lv)"""


def _liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rec = o.select(I("o_orderkey").alias("path"), F.concat(F.lit("s"), (I("o_orderkey") % 3).cast("string")).alias("source"), F.lit("2024-01-01").cast("date").alias("last_seen"), (I("o_orderkey") % 5).cast("int").alias("miss_streak"), (I("o_orderkey") % 5 >= 3).alias("flagged"))
    src = spark.createDataFrame([("s0", True), ("s1", True), ("s2", False)], "source string, succeeded boolean").withColumn("run_date", F.lit("2024-01-02").cast("date"))
    return L.liveness(rec, rec.where("path % 4 = 0").select("path"), src)


@query(f"WITH {LIVE} SELECT path, CASE WHEN ran AND hit THEN DATE '2024-01-02' ELSE last_seen END AS last_seen, CAST(sk AS INTEGER) AS miss_streak, CASE event WHEN 'flag' THEN true WHEN 'reactivate' THEN false ELSE flagged END AS flagged, event FROM le")
def liveness_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _liveness(spark, sf_dir).select("path", "last_seen", I("miss_streak").cast("int").alias("miss_streak"), "flagged", "event")


@query(f"WITH {LIVE} SELECT path, CASE WHEN event = 'flag' AND path % 2 = 0 THEN 'suspected-discontinued' WHEN event = 'reactivate' AND path % 2 = 1 THEN 'current' WHEN path % 2 = 0 THEN 'current' ELSE 'suspected-discontinued' END AS status, CASE WHEN event = 'flag' AND path % 2 = 0 THEN 'unknown' ELSE 'in_stock' END AS availability FROM le")
def status_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    was = F.when(I("path") % 2 == 0, "current").otherwise("suspected-discontinued")
    status, availability = L.status_after(was, F.lit("in_stock"), I("event"))
    return _liveness(spark, sf_dir).select("path", status.alias("status"), availability.alias("availability"))


@query("""WITH c AS (SELECT event_type AS source, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL), l AS (SELECT *, lag(n) OVER (PARTITION BY source ORDER BY d) AS before FROM c)
SELECT source, d, n, before, coalesce(before > 0 AND 100.0 * (before - n) > 10 * before, false) AS broken FROM l""")
def drop_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy(I("event_type").alias("source"), F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    return Q.drops(counts, "source", "d", "n", 10.0)


@query("SELECT o_orderkey AS path FROM orders WHERE NOT (o_orderkey % 3 = 1 AND o_orderkey % 7 <> 0)")
def orphan_gc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = table(spark, sf_dir, "orders").select(I("o_orderkey").alias("path"), (I("o_orderkey") % 3).alias("source"))
    return L.without_orphans(rec, rec.where("path % 7 = 0"), spark.createDataFrame([(1,)], "source long"), full_run=True).select("path")


RECON = """ar AS (SELECT 'k' || o_orderkey AS key, 'u' || o_orderkey AS url, 'n' || o_orderkey AS name, 'current' AS status, CAST(o_orderdate AS DATE) AS first_seen FROM orders WHERE o_orderkey % 2 = 0),
nw AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'r' || o_orderkey ELSE 'k' || o_orderkey END AS key, 'u' || o_orderkey AS url, '' AS name, CASE WHEN o_orderkey % 6 = 0 THEN 'discontinued' ELSE 'current' END AS status, DATE '2030-01-01' AS first_seen FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0)"""


@query(f"""WITH {RECON}, hit AS (SELECT nw.*, coalesce(a.key, b.key) AS target, coalesce(a.name, b.name) AS old_name, coalesce(a.first_seen, b.first_seen) AS old_first FROM nw LEFT JOIN ar a ON a.key = nw.key LEFT JOIN ar b ON b.url = nw.url AND a.key IS NULL)
SELECT key, url, old_name AS name, status, coalesce(old_first, first_seen) AS first_seen FROM hit UNION ALL SELECT * FROM ar WHERE key NOT IN (SELECT target FROM hit WHERE target IS NOT NULL) AND NOT (CAST(substr(key, 2) AS BIGINT) % 11 = 0)""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), I("o_orderkey").cast("string")
    named = lambda p, c: F.concat(F.lit(p), c)
    archive = o.where("o_orderkey % 2 = 0").select(named("k", k).alias("key"), named("u", k).alias("url"), named("n", k).alias("name"), F.lit("current").alias("status"), F.to_date("o_orderdate").alias("first_seen"))
    incoming = o.where("o_orderkey % 3 = 0").select(F.when(I("o_orderkey") % 5 == 0, named("r", k)).otherwise(named("k", k)).alias("key"), named("u", k).alias("url"), F.lit("").alias("name"), F.when(I("o_orderkey") % 6 == 0, "discontinued").otherwise("current").alias("status"), F.lit("2030-01-01").cast("date").alias("first_seen"))
    gone = o.where("o_orderkey % 11 = 0").select(F.explode(F.array(named("k", k), named("r", k))).alias("key"))
    return L.reconcile(archive, incoming, spark.createDataFrame([], "new string, old string"), gone)


@query("SELECT 'h' || p_partkey AS new, CASE WHEN p_partkey % 10 = 0 THEN 'x' || p_partkey ELSE 'b' || p_partkey END AS old FROM part WHERE p_partkey % 2 = 0")
def auto_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), I("p_partkey").cast("string")
    archive = p.select(F.concat(F.lit("b"), k).alias("key"), k.alias("stem"), F.lit(None).cast("string").alias("hex"))
    incoming = p.where("p_partkey % 2 = 0").select(F.concat(F.lit("h"), k).alias("key"), k.alias("stem"), F.lit("#000000").alias("hex"))
    explicit = p.where("p_partkey % 10 = 0").select(F.concat(F.lit("h"), k).alias("new"), F.concat(F.lit("x"), k).alias("old"))
    return L.auto_aliases(archive, incoming, explicit)


@query("""WITH q AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN 0 WHEN o_orderkey % 4 = 1 OR (o_orderkey % 3 = 0 AND o_orderkey % 5 < 3) THEN 1 WHEN o_orderkey % 3 <> 0 THEN 2 END AS reason, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS fetched FROM orders)
SELECT key, reason FROM q WHERE reason IS NOT NULL ORDER BY reason, fetched NULLS FIRST, key LIMIT 5000""")
def detail_queue_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("k", I("o_orderkey"))
    items = o.select(I("k").alias("key"), F.when(I("k") % 4 == 1, "b").otherwise("a").alias("updated_at"))
    state = o.where("k % 4 <> 0").select(I("k").alias("key"), F.lit("a").alias("updated_at"), F.when(I("k") % 3 != 0, "v").alias("value"), (I("k") % 5).cast("int").alias("misses"), F.to_date("o_orderdate").alias("fetched"))
    return L.detail_queue(items, state, 5000)


@query("SELECT user_id, min(ts) AS first FROM events GROUP BY user_id ORDER BY first, user_id LIMIT 40")
def stale_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first")).orderBy("first", "user_id").limit(40)


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 20 AS BIGINT) AS batch FROM orders QUALIFY batch < 10")
def batch_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.batches(table(spark, sf_dir, "orders"), [I("o_orderdate"), I("o_orderkey")], 20, 10).select("o_orderkey", "batch")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN true ELSE date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') >= 30 END AS due FROM orders")
def ttl_reenumerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(I("o_orderkey") % 9 != 0, F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", L.due(last, F.lit("1998-01-01").cast("date"), 30).alias("due"))


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, ROW(ts, -event_id)) AS event_id FROM events GROUP BY user_id")
def latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ranked(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), I("event_id")]).select("user_id", "ts", "event_id")


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY ALL")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ranked(table(spark, sf_dir, "events"), ["event_type", "user_id"], [I("event_id")]).select("event_type", "user_id", "event_id")


@query("SELECT event_type, user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))


@query(f"WITH {PAINTS_SQL}, s AS (SELECT id, brand || '/' || id % 500 AS slug, code, row_number() OVER (PARTITION BY brand || '/' || id % 500 ORDER BY set_name, code) AS n FROM paint) SELECT id, CASE WHEN n > 1 THEN slug || '-' || n ELSE slug END AS slug FROM s")
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = paints(spark, sf_dir).withColumn("slug", F.concat_ws("/", "brand", (I("id") % 500).cast("string")))
    return E.suffixed(p, "slug", [I("set_name"), I("code")]).select("id", "slug")


@query(f"WITH {PAINTS_SQL} SELECT brand, set_name, min(id) AS id FROM paint GROUP BY ALL")
def natural_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ranked(paints(spark, sf_dir), ["brand", "set_name"], [I("id")]).select("brand", "set_name", "id")


@query(f"WITH {OBS_SQL} SELECT source, count(*) AS n, avg(CASE WHEN code <> '' THEN 1.0 ELSE 0 END) AS rate_code, avg(CASE WHEN ean <> '' THEN 1.0 ELSE 0 END) AS rate_ean, avg(CASE WHEN price <> 0 THEN 1.0 ELSE 0 END) AS rate_price FROM obs GROUP BY source")
def contract_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.contract_metrics(observations(spark, sf_dir), ["source"], ["code", "ean", "price"])


@query(f"WITH {OBS_SQL} SELECT manufacturer, count(*) AS total, count(ean) AS with_ean, count(*) FILTER (WHERE ean IS NOT NULL AND kind = 'manufacturer') AS confirmed, CAST(round_even(100.0 * count(ean) / count(*), 1) AS DECIMAL(9, 1))::VARCHAR AS pct FROM obs GROUP BY manufacturer")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.coverage(observations(spark, sf_dir), "manufacturer", I("ean"), I("kind") == "manufacturer")


@query("SELECT 's' || event_type AS source, count(*) AS n, CASE WHEN event_type < 'd' THEN 'ok' ELSE 'failed' END AS outcome FROM events GROUP BY event_type")
def health_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).withColumn("source", F.concat(F.lit("s"), "event_type"))
    return Q.health({"ok": n.where("event_type < 'd'"), "failed": n.where("event_type >= 'd'")})


@query("""WITH o AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ean, o_orderpriority AS entity FROM orders WHERE o_orderkey % 2 = 0), w AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ean, o_orderpriority AS entity FROM orders WHERE o_orderkey % 3 = 1)
SELECT o.*, CASE WHEN o.ean NOT IN (SELECT ean FROM w) THEN 'lost' ELSE 'moved' END AS fate FROM o ANTI JOIN w USING (ean, entity)""")
def snapshot_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    at = lambda c: o.where(c).select(I("o_custkey").cast("string").alias("ean"), I("o_orderpriority").alias("entity")).distinct()
    return Q.snapshot_guard(at("o_orderkey % 2 = 0"), at("o_orderkey % 3 = 1"))


@query(f"WITH {PAINTS_SQL} SELECT id, name, brand, CASE WHEN id % 4 = 0 THEN NULL ELSE 'c' || id END AS product_code, 'miniatures' AS category, 'unknown' AS availability, CAST(1 AS INTEGER) AS quantity FROM paint")
def publish_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = paints(spark, sf_dir), I("id").cast("string")
    raw = p.select("id", "name", "brand", F.when(I("id") % 2 == 0, F.lit(" ")).otherwise(F.concat(F.lit("c"), k)).alias("product_code"), F.when((I("id") % 2 == 0) & (I("id") % 4 != 0), F.concat(F.lit("c"), k)).alias("sku"), F.lit(None).cast("string").alias("category"), F.lit(" ").alias("availability"), F.lit(None).cast("int").alias("quantity"))
    return P.products(raw).select("id", "name", "brand", "product_code", "category", "availability", "quantity")


@query(f"WITH {PAINTS_SQL} SELECT brand AS partition, count(*) AS records, min(id) AS first_id FROM paint GROUP BY brand")
def publish_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.index(paints(spark, sf_dir), "brand", "id")


@query(f"WITH {PAINTS_SQL} SELECT count(DISTINCT brand) AS partitions, count(*) AS total FROM paint")
def partition_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.index(paints(spark, sf_dir), "brand", "id").agg(F.count("*").alias("partitions"), F.sum("records").alias("total"))


@query("""SELECT conv_id, turn, sha256('{"conv":' || conv_id || ',"role":"' || role || '","turn":' || turn || '}') AS hash, conv_id % 2 = 0 AND turn = 0 AS cached FROM conversations""")
def input_hash_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", canonical_hash(I("conv_id").alias("conv"), I("role"), I("turn")).alias("hash"))
    cache = rows.where("conv_id % 2 = 0 AND turn = 0").select("hash", F.lit(True).alias("hit")).distinct()
    return rows.join(cache, "hash", "left").select("conv_id", "turn", "hash", F.coalesce("hit", F.lit(False)).alias("cached"))


@query("""WITH r(pattern, allow, pre) AS (VALUES ('/', true, '/'), ('/en/', false, '/en/'), ('/en/1*', true, '/en/1'), ('/fr/*.html$', false, NULL)), p AS (SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]*', '') AS path FROM pages),
m AS (SELECT page_id, allow, length(pattern) AS n FROM p JOIN r ON CASE WHEN pre IS NULL THEN regexp_matches(path, '^/fr/.*[.]html$') ELSE starts_with(path, pre) END)
SELECT p.page_id, coalesce(arg_max(allow, ROW(n, allow)), true) AS allowed FROM p LEFT JOIN m USING (page_id) GROUP BY p.page_id""")
def robots_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerforge.sources.robots import allowed

    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://[^/]*", "").alias("path"))
    rules = spark.createDataFrame([("/", True), ("/en/", False), ("/en/1*", True), ("/fr/*.html$", False)], "pattern string, allow boolean")
    return allowed(pages, rules, "page_id")


@query(f"WITH {OBS_SQL} SELECT part, bool_or(source = 3) AND NOT bool_or(source = 0) AS discontinued FROM obs GROUP BY part")
def role_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("part").agg((F.bool_or(I("source") == 3) & ~F.bool_or(I("source") == 0)).alias("discontinued"))


@query(f"WITH {OBS_SQL} SELECT part, arg_min(code, key) FILTER (WHERE code IS NOT NULL) AS code, arg_min(price, key) AS price FROM obs GROUP BY part")
def merge_first_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.merged_first(observations(spark, sf_dir), ["part"], "key", ["code", "price"])


@query("""WITH px AS (SELECT l_orderkey % 50 AS img, l_partkey % 256 AS r, (l_orderkey * 13 + l_linenumber) % 256 AS g, (l_suppkey * 29) % 256 AS b FROM lineitem)
  SELECT img, median(r) AS r, median(g) AS g, median(b) AS b, CAST(floor((stddev_pop(r) + stddev_pop(g) + stddev_pop(b)) / 3 * 1000 + 1e-6) AS BIGINT) AS spread_milli FROM px GROUP BY 1""")
def pixel_median_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = table(spark, sf_dir, "lineitem").select((I("l_orderkey") % 50).alias("img"), (I("l_partkey") % 256).alias("r"), ((I("l_orderkey") * 13 + I("l_linenumber")) % 256).alias("g"), (I("l_suppkey") * 29 % 256).alias("b"))
    return raster.swatches(px).select("img", "r", "g", "b", F.floor(I("spread") * 1000 + 1e-6).alias("spread_milli"))


@query("""WITH s AS (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS r FROM supplier), c AS (SELECT r, c FROM s, range(12) t(c)), k AS (SELECT r, c, 100 + row_number() OVER (ORDER BY r, c) AS code FROM c WHERE NOT ((r = 0 AND c = 3) OR (r = 4 AND c = 0)))
  SELECT CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS "column", CAST(code AS INTEGER) AS code FROM k WHERE code <= 80 + 12 * (SELECT count(*) FROM supplier)""")
def grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid with a row for each supplier."""
    rows = table(spark, sf_dir, "supplier").count()
    return raster.grid_codes(spark, rows, 12, 101, [(0, 3), (4, 0)], 80 + 12 * rows)


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, CAST(floor(sum(value) * 1000 + 0.5) AS BIGINT) AS milli FROM events GROUP BY ALL")
def windows_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerforge.streaming.windows import tumbling

    out = tumbling(table(spark, sf_dir, "events"))
    return out.select("start", "event_type", "n", F.floor(I("total") * 1000 + 0.5).alias("milli"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def windows_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerforge.streaming.windows import sessions

    return sessions(table(spark, sf_dir, "events"), "6 hours")


@query("""WITH r AS (SELECT c_nationkey AS g, CAST(5000000000000 + c_custkey % 40 AS VARCHAR) AS ean, CAST(substr(c_mktsegment, 1, 1) = 'B' AS INTEGER) AS rank, c_custkey AS seq FROM customer),
p AS (SELECT g, arg_min(ean, ROW(-rank, seq)) AS ean FROM r GROUP BY g) SELECT g, p.ean, list_sort(coalesce(list(DISTINCT r.ean) FILTER (WHERE r.ean <> p.ean), [])) AS others FROM r JOIN p USING (g) GROUP BY g, p.ean""")
def barcode_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    rows = c.select(I("c_nationkey").alias("g"), (F.lit(5000000000000) + I("c_custkey") % 40).cast("string").alias("ean"), F.startswith("c_mktsegment", F.lit("B")).cast("int").alias("rank"), I("c_custkey").alias("seq"))
    return C.barcode_rollup(rows, "g")


@query("""SELECT o_orderkey AS id, substr(o_orderpriority, 1, 4) AS description, ['a=' || o_orderstatus, 'b=' || o_orderkey % 7] AS hints FROM orders WHERE o_orderkey % 3 = 0""")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    hints = F.create_map(F.lit("b"), (I("o_orderkey") % 7).cast("string"), F.lit("a"), I("o_orderstatus"))
    return C.work_queue(o.select(I("o_orderkey").alias("id"), I("o_orderpriority").alias("description"), hints.alias("hints"), F.when(I("o_orderkey") % 3 != 0, "s").alias("game_system")), 4)


@query("SELECT o_orderstatus AS game_system, list_sort(list(DISTINCT o_orderpriority)) AS factions FROM orders GROUP BY 1")
def observed_factions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.observed_factions(table(spark, sf_dir, "orders").select(I("o_orderstatus").alias("game_system"), I("o_orderpriority").alias("faction")))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Red ' || p_partkey WHEN 1 THEN 'Deep Blue' ELSE 'Moss' END AS name, p_partkey % 3 = 1 AND p_size <= 25 AS single FROM part")
def bare_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = I("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("Acme: RED "), I("p_partkey").cast("string"), F.lit(" (new) 17ml"))).when(k == 1, F.lit("ACME - Deep Blue single")).otherwise(F.lit("Moss  pack of 6"))
    sku = F.when(k < 2, F.concat(F.lit("AC"), I("p_partkey").cast("string"))).otherwise("x")
    title = F.when(k == 0, "Set of Reds").otherwise("Deep Blue")
    return table(spark, sf_dir, "part").select("p_partkey", extract.bare_name(raw, "acme").alias("name"), extract.single_item(sku, title, I("p_size"), r"^AC\d+$", 25).alias("single"))
