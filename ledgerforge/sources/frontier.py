"""What has to be walked: sitemaps that list sitemaps, listings that link to their next page, slices that are over a platform's cap.

Each walk is a loop of joins over captured documents. A round's frontier is a written table, and what was visited is kept from coming
back by an anti-join, so cycles end; the number of rounds is the depth, not the number of documents.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.sources.shared import at_most, written


# Fixed value: of so many rounds the visited documents are kept apart before they are written as one table.
MOST_TABLES = 8


def read_sitemap(content: bytes | None) -> tuple[str, list[str]]:
    """The kind of a sitemap document (its root's name) and its locations, in order; 'broken' if it can't be read.

    Documents are unpacked by their first bytes, whatever their URL or headers say.
    """
    try:
        data = gzip.decompress(content) if content and content[:2] == b"\x1f\x8b" else content or b""
        root = ElementTree.fromstring(data.decode("utf-8", "replace"))
    except (OSError, EOFError, zlib.error, ElementTree.ParseError):
        return "broken", []
    local = lambda e: e.tag.rpartition("}")[2]
    return local(root), [loc.text.strip() for entry in root for loc in entry if local(loc) == "loc" and loc.text and loc.text.strip()]


def sitemap_documents(captures: DataFrame) -> DataFrame:
    """url, kind, locations of captures (url, content: text or bytes)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_sitemap(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.string()))], ["url", "kind", "locations"])

    return captures.select("url", F.col("content").cast("binary").alias("content")).mapInArrow(parse, "url string, kind string, locations array<string>")


def sitemap_frontier(captures: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of captures (url, content) what the sitemaps roots (url) lead to: the locations (url) of their page lists, each once, and the
    documents visited (url, kind: urlset, sitemapindex, another root's name, broken or missing).

    An index may list indexes; a document that several list, or that a cycle leads back to, is read once. Of several captures of one
    URL the largest counts. Documents of other kinds, broken ones and missing ones contribute nothing.
    """
    # documents are read once, whatever the number of rounds, whose joins see addresses alone
    found = written(sitemap_documents(captures.groupBy("url").agg(F.max("content").alias("content"))), "sitemaps")
    links = written(found.where("kind = 'sitemapindex'").select("url", F.explode("locations").alias("below")).distinct(), "links")
    frontier = written(roots.select("url").where("url IS NOT NULL").distinct(), "frontier")
    visited = [frontier]
    while not at_most(frontier, 0):
        below = links.join(frontier, "url", "left_semi").select(F.col("below").alias("url")).distinct()
        frontier = written(below.join(reduce(DataFrame.unionByName, visited), "url", "left_anti"), "frontier")
        visited.append(frontier)
        if len(visited) > MOST_TABLES:  # or a deep walk would read all earlier rounds' tables in each
            visited = [written(reduce(DataFrame.unionByName, visited).coalesce(8), "visited")]
    reached = reduce(DataFrame.unionByName, visited).join(found, "url", "left")
    return reached.where("kind = 'urlset'").select(F.explode("locations").alias("url")).distinct(), reached.select("url", F.coalesce("kind", F.lit("missing")).alias("kind"))


def listing_walk(links: DataFrame, starts: DataFrame) -> DataFrame:
    """walk, url, place: the pages that following next-page links (url, next) from each start (walk, url) reaches, counted from 0.

    By pointer doubling: a round joins what was reached with links of twice the length, so a listing of n pages takes log n rounds. A
    walk ends at a page that it has seen or that isn't there; of links that a page repeats the smallest counts.
    """
    jumps = links.where("next IS NOT NULL").groupBy("url").agg(F.min("next").alias("next"))
    pages = links.select("url").distinct()
    jumps = written(jumps.join(pages.withColumnRenamed("url", "next"), "next", "left_semi").select("url", "next"), "jumps")
    reached = written(starts.join(pages, "url", "left_semi").select("walk", "url", F.lit(0).cast("long").alias("place")).distinct(), "reached")
    step, count = 1, reached.count()
    while True:
        further = reached.join(jumps, "url").select("walk", F.col("next").alias("url"), (F.col("place") + step).alias("place"))
        reached = written(reached.unionByName(further).groupBy("walk", "url").agg(F.min("place").alias("place")), "reached")
        if (now := reached.count()) == count:
            return reached
        jumps = written(jumps.alias("x").join(jumps.alias("y"), F.col("x.next") == F.col("y.url")).select("x.url", "y.next"), "jumps")
        step, count = 2 * step, now


def names_in_order(walked: DataFrame, items: DataFrame) -> DataFrame:
    """The items (url, at, name, others) of walked pages (walk, url, place) with walk and seq (place, at): of names that are equal but for
    case the first on the way; items without a name are none."""
    each = walked.join(items.where(F.trim("name") != ""), "url").withColumn("seq", F.struct("place", "at"))
    fields = [c for c in each.columns if c not in ("walk", "seq", "place", "at")]
    return each.groupBy("walk", F.lower("name").alias("__n")).agg(F.min_by(F.struct(*fields, "seq"), "seq").alias("x")).select("walk", "x.*")


def facet_counts(answers: DataFrame, facet: str) -> DataFrame:
    """path, value, hits of answers (path, body) to questions for a slice's facet values: path is the slice's, an array of values."""
    v = F.try_variant_get(F.try_parse_json("body"), "$.facets", "map<string,map<string,bigint>>")
    return answers.select("path", F.explode(F.try_element_at(v, F.lit(facet))).alias("value", "hits"))


def plan_slices(answers: DataFrame, facets: list[str], cap: int) -> DataFrame:
    """path, hits, state of the slices to fetch: 'fetch' where the platform gives all of the slice, 'capped' where the finest facet is
    reached and it doesn't; and 'rest' where a split slice has more hits than its parts, for what carries no value of the finer facet.

    answers (path, body): the platform's facet answers for the whole (an empty path) and for slices (the values of the facets so far);
    its own count is `nbHits`. A slice over the cap is split by the next facet, one that has no answer or no values is 'capped'.
    """
    rows = answers.withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
    said = rows.groupBy("path").agg(F.max(F.try_variant_get(F.try_parse_json("body"), "$.nbHits", "bigint")).alias("hits"))
    open_ = written(said.where(F.size("path") == 0).select("path", F.coalesce("hits", F.lit(0).cast("long")).alias("hits")), "slices")
    plan: list[DataFrame] = [open_.where(F.col("hits") <= cap).withColumn("state", F.lit("fetch"))]
    open_ = open_.where(F.col("hits") > cap)
    for facet in facets:
        counts = facet_counts(rows.join(open_.select("path"), "path", "left_semi"), facet).groupBy("path", "value").agg(F.max("hits").alias("part"))
        parts = written(open_.join(counts, "path").select("path", "hits", "value", "part"), "parts")
        plan.append(open_.join(parts.select("path").distinct(), "path", "left_anti").withColumn("state", F.lit("capped")))
        rest = parts.groupBy("path", "hits").agg(F.sum("part").alias("parts")).where("hits > parts")
        plan.append(rest.select("path", (F.col("hits") - F.col("parts")).alias("hits"), F.lit("rest").alias("state")))
        below = parts.select(F.concat("path", F.array("value")).alias("path"), F.col("part").alias("hits"))
        plan.append(below.where(F.col("hits") <= cap).withColumn("state", F.lit("fetch")))
        open_ = below.where(F.col("hits") > cap)
    plan.append(open_.withColumn("state", F.lit("capped")))
    return reduce(DataFrame.unionByName, plan)

