"""Nearest colours of other brands.

Distances are evaluated once for each unordered pair of distinct colours, and only for pairs within the lightness bound: a range
join by lightness buckets, ordered so that a colour meets its own bucket and the next. There are at most 2^24 colours, however
many items. The pairs are the work, not the rows: up to a bound one side is broadcast and the other dealt over all tasks; beyond it
both are shuffled by bucket, which are few, so one side is salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions.color import LIGHTNESS_BOUND, rounded, tier, with_delta_e, with_lab
from ledgerforge.sources.shared import at_most, written

SALTS = 64
#: Colours that are broadcast (some 50 bytes each), and tasks for each core that pairs are dealt to.
BROADCAST_COLOURS, TASKS_PER_CORE = 200_000, 3


def near_colours(colours: DataFrame, threshold: float) -> DataFrame:
    """one, two, delta_e for ordered pairs of distinct colours (colour, r, g, b) within the threshold, a colour with itself included."""
    width = LIGHTNESS_BOUND * threshold
    lab = with_lab(colours).withColumn("bucket", F.floor(F.col("lab_l") / width))
    left = lab.select(F.col("colour").alias("one"), F.col("lab_l").alias("l1"), F.col("lab_a").alias("a1"), F.col("lab_b").alias("b1"), F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)).alias("bucket"), F.pmod(F.xxhash64("colour"), F.lit(SALTS)).alias("salt"))
    right = lab.select(F.col("colour").alias("two"), F.col("lab_l").alias("l2"), F.col("lab_a").alias("a2"), F.col("lab_b").alias("b2"), "bucket")
    if at_most(colours, BROADCAST_COLOURS):
        both = left.repartition(TASKS_PER_CORE * colours.sparkSession.sparkContext.defaultParallelism).join(F.broadcast(right), "bucket")
    else:
        both = left.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["bucket", "salt"])
    later = (F.col("l2") > F.col("l1")) | ((F.col("l2") == F.col("l1")) & (F.col("two") > F.col("one")))
    pairs = both.where(later & (F.col("l2") - F.col("l1") <= width))
    near = with_delta_e(pairs.drop("bucket", "salt"), ("l1", "a1", "b1"), ("l2", "a2", "b2")).where(F.col("delta_e") <= threshold)
    both = near.select(F.inline(F.array(F.struct(F.col("one").alias("one"), F.col("two").alias("two"), "delta_e"), F.struct(F.col("two").alias("one"), F.col("one").alias("two"), "delta_e"))))
    return both.unionByName(colours.select(F.col("colour").alias("one"), F.col("colour").alias("two"), F.lit(0.0).alias("delta_e")))


def equivalents(items: DataFrame, *, threshold: float = 10.0, close: float = 5.0, top: int = 5) -> DataFrame:
    """id, rank, match, delta_e, tier: for each item (id, index, brand, r, g, b) the best item of each other brand within the
    threshold, nearest first, at most `top`; ties go to the smaller index. Items without a colour take no part.
    """
    items = items.where(F.col("r").isNotNull() & F.col("g").isNotNull() & F.col("b").isNotNull()).withColumn("colour", F.col("r") * 65536 + F.col("g") * 256 + F.col("b"))
    colours = written(items.select("colour", "r", "g", "b").distinct(), "colours")
    offers = items.groupBy("colour", F.col("brand").alias("other")).agg(F.min(F.struct("index", "id")).alias("first"))
    best = near_colours(colours, threshold).join(offers, F.col("two") == offers["colour"]).groupBy("one", "other").agg(F.min(F.struct("delta_e", "first.index", "first.id")).alias("best"))
    asked = items.select(F.col("colour").alias("one"), "brand").distinct()
    ranked = asked.join(best, "one").where(F.col("brand") != F.col("other"))
    order = Window.partitionBy("one", "brand").orderBy("best.delta_e", "best.index")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    out = items.select("id", F.col("colour").alias("one"), "brand").join(ranked, ["one", "brand"])
    return out.select("id", "rank", F.col("best.id").alias("match"), F.col("best.delta_e").alias("delta_e"), tier(F.col("best.delta_e"), close).alias("tier"))


def bidirectional(edges: DataFrame) -> DataFrame:
    """id, n, nearest (unrounded), and the sorted array of (delta_e, match, tier): each edge counts for both ends, the least distance for a pair."""
    swapped = edges.select(F.col("match").alias("id"), F.col("id").alias("match"), "delta_e", "tier")
    both = edges.select("id", "match", "delta_e", "tier").unionByName(swapped).where("id <> match")
    least = both.groupBy("id", "match").agg(F.min(F.struct("delta_e", "tier")).alias("x"))
    return least.groupBy("id").agg(F.count("*").alias("n"), F.min("x.delta_e").alias("nearest"), F.array_sort(F.collect_list(F.struct(rounded(F.col("x.delta_e")).alias("delta_e"), F.col("match"), F.col("x.tier").alias("tier")))).alias("equivalents"))


def linked_by_key(links: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """a, b, distance: links whose ends are named by keys (<key>_a, <key>_b, distance) as links of items' ids, the least distance of each.

    A key that several items have stands for the smallest of their ids. Links of which an end is no item, and links to itself, go.
    """
    first = items.groupBy(*keys).agg(F.min("id").alias("id"))
    side = lambda s: first.select(*(F.col(k).alias(f"{k}_{s}") for k in keys), F.col("id").alias(s))
    out = links.join(side("a"), [f"{k}_a" for k in keys]).join(side("b"), [f"{k}_b" for k in keys]).where("a <> b")
    return out.groupBy("a", "b").agg(F.min("distance").alias("distance"))
