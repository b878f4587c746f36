"""Catalog rows from curated and older trees, barcode rollups, and the queue of what is left to classify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions.text import slug_ascii


def seeds(rows: DataFrame, systems: DataFrame) -> DataFrame:
    """Curated rows (key, name, system label, faction label, contents) with slugs: systems by label, factions made from theirs.

    quantity is the sum of the contents' quantities, 1 without contents. A key given twice, or an unknown system, fails the query.
    """
    n = F.count("*").over(Window.partitionBy("key"))
    dim = systems.select(F.lower("label").alias("__l"), F.col("slug").alias("game_system"))
    out = rows.withColumn("__n", n).join(dim, F.lower("system") == dim["__l"], "left")
    key = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("key given twice: "), "key"))).when(F.col("system").isNotNull() & F.col("__l").isNull(), F.raise_error(F.concat(F.lit("unknown system: "), "system"))).otherwise(F.col("key"))
    total = F.aggregate("contents", F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x["quantity"], F.lit(1)))
    return out.select(key.alias("key"), "name", "game_system", slug_ascii(F.col("faction")).alias("faction"), F.when(F.coalesce(F.size("contents"), F.lit(0)) > 0, total).otherwise(1).alias("quantity"))


def free_suffixes(rows: DataFrame, order: str) -> DataFrame:
    """Equal keys told apart by -2, -3, ..., past the suffixes that other rows have as their own keys.

    A suffix that is somebody's key is left out by ranking the free ones of a key against its rows.
    """
    ranked = rows.withColumn("__n", F.row_number().over(Window.partitionBy("key").orderBy(order)))
    taken = rows.select(F.regexp_extract("key", r"^(.*)-(\d+)$", 1).alias("stem"), F.regexp_extract("key", r"^(.*)-(\d+)$", 2).alias("n")).where("stem <> ''")
    taken = taken.groupBy("stem").agg(F.array_sort(F.collect_set(F.col("n").cast("int"))).alias("__taken"))
    out = ranked.join(taken, ranked["key"] == taken["stem"], "left")
    free = F.filter(F.sequence(F.lit(2), F.col("__n") + F.coalesce(F.size("__taken"), F.lit(0)) + 1), lambda i: ~F.array_contains(F.coalesce("__taken", F.array().cast("array<int>")), i))
    key = F.when(F.col("__n") > 1, F.concat_ws("-", "key", F.element_at(free, F.col("__n") - 1).cast("string"))).otherwise(F.col("key"))
    return out.withColumn("key", key).select(*rows.columns)


def barcode_rollup(rows: DataFrame, by: str) -> DataFrame:
    """Per group (rows: ean, rank, seq) its primary barcode, that of the highest rank in order of arrival, and the others, sorted.

    A row of a higher rank takes the place of the primary one, which joins the others; equal ranks don't, and no barcode is in both.
    Only distinct barcodes are kept of a group, however many rows it has.
    """
    first = F.expr("min_by(struct(ean), struct(-CAST(rank AS LONG), seq, ean)) FILTER (WHERE rank >= 0)").alias("x")
    done = rows.groupBy(by).agg(first, F.collect_set("ean").alias("all"))
    return done.select(by, F.col("x.ean").alias("ean"), F.array_sort(F.array_remove("all", F.col("x.ean"))).alias("others"))


def work_queue(rows: DataFrame, length: int = 300) -> DataFrame:
    """Products without a system: id, description cut to `length`, hints as sorted distinct key=value texts, observed factions apart."""
    hints = F.array_sort(F.array_distinct(F.transform(F.map_entries("hints"), lambda e: F.concat_ws("=", e["key"], e["value"]))))
    return rows.where("game_system IS NULL").select("id", F.substring("description", 1, length).alias("description"), F.coalesce(hints, F.array().cast("array<string>")).alias("hints"))


def observed_factions(rows: DataFrame) -> DataFrame:
    return rows.where("game_system IS NOT NULL AND faction IS NOT NULL").groupBy("game_system").agg(F.array_sort(F.collect_set("faction")).alias("factions"))


def migrated(legacy: DataFrame, archive: DataFrame, key: list[str], made: dict[str, Column]) -> DataFrame:
    """The archive after a migration: its own rows as they are, word for word, and of legacy rows whose key it hasn't one each, in the
    archive's form (made: its columns from legacy ones), the first by all of them. Run again it changes nothing."""
    rows = legacy.select(*(x.alias(c) for c, x in made.items()))
    fold = lambda df: F.concat_ws("\x01", *(F.lower(F.trim(F.coalesce(df[k].cast("string"), F.lit("")))) for k in key))
    first = rows.withColumn("__k", fold(rows)).groupBy("__k").agg(F.min(F.struct(*archive.columns)).alias("x"))
    held = archive.select(fold(archive).alias("__k")).distinct()
    return archive.unionByName(first.join(held, "__k", "left_anti").select("x.*"))
