"""Queries that walk: sitemaps below sitemaps, listings page by page, slices by facets, all made of the tables' rows."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ledgerforge.plans.derive import table
from ledgerforge.plans.registry import query
from ledgerforge.sources import frontier


@F.pandas_udf(BinaryType())
def _packed(x: pd.Series) -> pd.Series:
    return x.map(lambda s: gzip.compress(s.encode()))


def _document(page: Column) -> Column:
    return F.concat(F.lit("https://e.org/sitemap/"), page)


@query("""WITH RECURSIVE walk AS (SELECT CAST(0 AS BIGINT) AS m UNION SELECT c.m FROM walk JOIN pages ON page_id = walk.m, LATERAL (VALUES (3 * walk.m + 1), (3 * walk.m + 2), (3 * walk.m + 3), (walk.m // 2)) c(m) WHERE walk.m % 2 = 0 AND walk.m % 11 <> 10),
  seen AS (SELECT m, CASE WHEN page_id IS NULL THEN 'missing' WHEN m % 11 = 10 THEN 'broken' WHEN m % 2 = 0 THEN 'sitemapindex' ELSE 'urlset' END AS kind FROM walk LEFT JOIN pages ON page_id = m)
  SELECT 'https://e.org/sitemap/' || m AS url, kind FROM seen
  UNION ALL (SELECT url, 'page' FROM seen JOIN pages ON page_id = m WHERE kind = 'urlset' UNION SELECT url, 'page' FROM seen JOIN pages ON page_id = (m * 7) % 1000 WHERE kind = 'urlset')""")
def sitemap_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes of indexes with links back up, packed and plain documents, broken and missing ones; each page's URL once, and every
    document that was visited."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("m"), "url")
    loc = lambda x: F.concat(F.lit("<entry><loc> "), F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(" </loc></entry>"))
    other = p.select(F.col("m").alias("o"), F.col("url").alias("other"))
    rows = p.join(other, (F.col("m") * 7) % 1000 == F.col("o"), "left")
    listed = F.concat(F.lit('<urlset xmlns="http://e.org/sitemap">'), loc(F.col("url")), F.coalesce(loc(F.col("other")), F.lit("")), F.lit("</urlset>"))
    below = [_document(x.cast("string")) for x in (3 * F.col("m") + 1, 3 * F.col("m") + 2, 3 * F.col("m") + 3, F.floor(F.col("m") / 2).cast("long"))]
    index = F.concat(F.lit("<sitemapindex>"), *map(loc, below), F.lit("</sitemapindex>"))
    rows = rows.withColumn("xml", F.when(F.col("m") % 11 == 10, F.lit("<urlset><loc")).when(F.col("m") % 2 == 0, index).otherwise(listed))
    rows = rows.withColumn("packed", _packed("xml")).select(_document(F.col("m").cast("string")).alias("url"), F.when(F.col("m") % 5 == 1, F.col("packed")).otherwise(F.col("xml").cast("binary")).alias("content"))
    urls, seen = frontier.sitemap_frontier(rows, rows.limit(1).select(_document(F.lit("0")).alias("url")))
    return seen.unionByName(urls.withColumn("kind", F.lit("page")))


@query("""WITH RECURSIVE link AS (SELECT page_id AS url, CASE WHEN page_id % 29 = 28 THEN page_id - 14 ELSE page_id + 7 END AS next FROM pages),
  walk AS (SELECT page_id AS walk, page_id AS url, CAST(0 AS BIGINT) AS place, [page_id] AS way FROM pages WHERE page_id < 7
    UNION ALL SELECT walk, next, place + 1, list_append(way, next) FROM walk JOIN link USING (url) WHERE next IN (SELECT url FROM link) AND NOT list_contains(way, next)),
  item AS (SELECT w.walk, w.url, w.place, t.spot, CASE WHEN w.url % 2 = 0 THEN 'Name ' ELSE 'NAME ' END || (w.url * 3 + t.spot) % 40 AS name FROM walk w, (VALUES (0), (1), (2)) t(spot))
  SELECT walk, name, url, place FROM (SELECT *, row_number() OVER (PARTITION BY walk, lower(name) ORDER BY place, spot) AS k FROM item) WHERE k = 1""")
def listing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven listings by their next-page links, some of which lead back; of names that are equal but for case the first on the way."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("url"))
    links = p.withColumn("next", F.when(F.col("url") % 29 == 28, F.col("url") - 14).otherwise(F.col("url") + 7))
    walked = frontier.listing_walk(links, p.where("url < 7").select(F.col("url").alias("walk"), "url"))
    items = p.select("url", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("at"))
    items = items.withColumn("name", F.concat(F.when(F.col("url") % 2 == 0, "Name ").otherwise("NAME "), ((F.col("url") * 3 + F.col("at")) % 40).cast("string")))
    return frontier.names_in_order(walked, items).select("walk", "name", "url", F.col("seq.place").alias("place"))


@query("""WITH p AS (SELECT p_brand AS a, CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS b, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size % 5 AS VARCHAR) END AS c FROM part),
  l1 AS (SELECT a, count(*) AS n FROM p GROUP BY a), l2 AS (SELECT a, b, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL), l3 AS (SELECT a, b, c, count(*) AS n FROM p WHERE b IS NOT NULL AND c IS NOT NULL GROUP BY ALL),
  s1 AS (SELECT * FROM l1 WHERE n > 20), s2 AS (SELECT l2.* FROM l2 JOIN s1 USING (a) WHERE l2.n > 20),
  r1 AS (SELECT s1.a, s1.n, CAST(sum(l2.n) AS BIGINT) AS m FROM s1 LEFT JOIN l2 USING (a) GROUP BY ALL), r2 AS (SELECT s2.a, s2.b, s2.n, CAST(sum(l3.n) AS BIGINT) AS m FROM s2 LEFT JOIN l3 USING (a, b) GROUP BY ALL)
  SELECT a AS path, n AS hits, 'fetch' AS state FROM l1 WHERE n <= 20
  UNION ALL SELECT a, CASE WHEN m IS NULL THEN n ELSE n - m END, CASE WHEN m IS NULL THEN 'capped' ELSE 'rest' END FROM r1 WHERE m IS NULL OR n > m
  UNION ALL SELECT concat_ws('>', a, b), l2.n, 'fetch' FROM l2 JOIN s1 USING (a) WHERE l2.n <= 20
  UNION ALL SELECT concat_ws('>', a, b), CASE WHEN m IS NULL THEN n ELSE n - m END, CASE WHEN m IS NULL THEN 'capped' ELSE 'rest' END FROM r2 WHERE m IS NULL OR n > m
  UNION ALL SELECT concat_ws('>', a, b, c), l3.n, CASE WHEN l3.n <= 20 THEN 'fetch' ELSE 'capped' END FROM l3 JOIN s2 USING (a, b)""")
def facet_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of parts by brand, type and size so that none has over 20, from the facet answers that a platform would give."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_type")).alias("type"), F.when(F.col("p_partkey") % 7 != 0, (F.col("p_size") % 5).cast("string")).alias("size"))

    def answers(known: list[str], facet: str) -> DataFrame:
        rows = p.where(" AND ".join(f"{c} IS NOT NULL" for c in known) or "true")
        parts = rows.groupBy(*known, facet).count().groupBy(*known).agg(F.sum("count").alias("nbHits"), F.map_from_entries(F.collect_list(F.when(F.col(facet).isNotNull(), F.struct(facet, "count")))).alias("values"))
        body = F.to_json(F.struct("nbHits", F.create_map(F.lit(facet), F.col("values")).alias("facets")))
        return parts.select(F.array(*known).cast("array<string>").alias("path"), body.alias("body"))

    facets = ["brand", "type", "size"]
    found = frontier.plan_slices(answers([], "brand").unionByName(answers(["brand"], "type")).unionByName(answers(["brand", "type"], "size")), facets, 20)
    return found.select(F.array_join("path", ">").alias("path"), "hits", "state")
