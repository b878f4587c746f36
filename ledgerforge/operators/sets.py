"""Sets of rows and of values: unions by key, what is left to do, overlaps, orders; counts of decisions and runs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.operators.quality import require_none


def union_once(slices: Iterable[DataFrame], key: str, order: str) -> DataFrame:
    """The rows of all slices, of each key the one that comes first by `order`, then as JSON. All slices have the same columns."""
    rows = reduce(DataFrame.unionByName, slices)
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.min_by(whole, F.struct(order, F.to_json(whole))).alias("__x")).select("__x.*")


def pending(queue: DataFrame, refreshed: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the queue that weren't refreshed."""
    return queue.select(key).distinct().join(refreshed.select(key), key, "left_anti")


def allowed_terms(rows: DataFrame, terms: str, allowed: list[str]) -> DataFrame:
    """Rows of which a term is allowed."""
    return rows.where(F.arrays_overlap(F.col(terms), F.array(*map(F.lit, allowed)))) if allowed else rows.limit(0)


def subset(some: Column, of: Column) -> Column:
    """Whether all elements of one array are in another; an empty one is in any."""
    return F.size(F.array_except(some, of)) == 0


def pruned(state: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The state's rows whose key is still known."""
    return state.join(known.select(key), key, "left_semi")


def by_number(rows: DataFrame, column: str) -> DataFrame:
    """Rows with their place by a text that is a number; texts that aren't come last, in order."""
    number = F.col(column).try_cast("bigint")
    return rows.orderBy(number.asc_nulls_last(), column)


def canonical(*fields: str) -> Column:
    """A text of the fields, by name, nulls left out: equal for equal values, and an order for mixed rows."""
    return F.to_json(F.struct(*sorted(fields)))


def iso_date(x: Column) -> Column:
    """The date that a text is, if it is written YYYY-MM-DD."""
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(x, "yyyy-MM-dd"))


def verdict_counts(candidates: DataFrame, decided: DataFrame, least: float = 0.9) -> DataFrame:
    """candidates, decided, accepted, rejected, unknown, low_confidence of pairs (pair) with decisions (pair, verdict, confidence)."""
    both = candidates.select("pair").join(decided, "pair", "left")
    sure = (F.col("verdict") == "same-product") & F.coalesce(F.col("confidence") >= least, F.lit(False))
    rejected, unknown = F.col("verdict") == "different-product", F.col("verdict") == "unknown"
    return both.agg(F.count("*").alias("candidates"), F.count("verdict").alias("decided"), F.count_if(sure).alias("accepted"), F.count_if(rejected).alias("rejected"), F.count_if(unknown).alias("unknown"), F.count_if(F.col("verdict").isNotNull() & ~sure & ~rejected & ~unknown).alias("low_confidence"))


def run_counts(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how many rows there are (`rows`), and of how many each condition holds."""
    return rows.agg(F.count("*").alias("rows"), *(F.count_if(c).alias(name) for name, c in conditions.items()))


def applied_decisions(overrides: DataFrame, decisions: DataFrame, systems: DataFrame, factions: DataFrame) -> DataFrame:
    """overrides (entity, field, value) with decisions (entity, game_system, faction) merged in: both fields, a null faction too.

    All decisions are checked first: an unknown slug anywhere raises, and nothing is applied. A null system is unknown.
    """
    known = lambda column, dim: decisions.join(dim.select(F.col("slug").alias(column)), column, "left_anti")
    require_none(known("game_system", systems).select("entity", "game_system"), "unknown game systems")
    require_none(known("faction", factions).where("faction IS NOT NULL").select("entity", "faction"), "unknown factions")
    new = decisions.select("entity", F.explode(F.array(F.struct(F.lit("game_system").alias("field"), F.col("game_system").alias("value")), F.struct(F.lit("faction").alias("field"), F.col("faction").alias("value")))).alias("x")).select("entity", "x.*")
    return overrides.join(new.select("entity", "field"), ["entity", "field"], "left_anti").select("entity", "field", "value").unionByName(new)


def archival(items: DataFrame) -> DataFrame:
    """Items (name, discontinued, code, ean, image, set_name, r, g, b, hex, volume_ml, packaging, type, finish) as records to archive:
    first_seen is left to the reconciliation."""
    gone = F.coalesce("discontinued", F.lit(False))
    return items.select(
        "name", F.lit("paint").alias("category"), F.when(gone, "discontinued").otherwise("current").alias("status"), F.when(gone, "out_of_stock").otherwise("unknown").alias("availability"),
        F.lit(None).cast("date").alias("first_seen"), F.col("code").alias("product_code"), "ean", F.col("image").alias("image_url"),
        F.struct(F.col("set_name").alias("set"), "r", "g", "b", "hex", "volume_ml", F.col("packaging").alias("container"), "type", "finish").alias("details"),
    )
