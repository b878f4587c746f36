"""Expectations, reports and guards before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions.barcode import normalize_ean


def truthy(c: str, kind: str) -> Column:
    """Present and not empty: as fill rates count, where an empty text or a zero is none."""
    if kind == "string":
        return F.coalesce(F.col(c) != "", F.lit(False))
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return F.coalesce(F.col(c).cast("boolean"), F.lit(False)) if kind in ("int", "bigint", "double", "boolean") else F.col(c).isNotNull()


def contract_metrics(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Rows and fill rates per source, in one pass."""
    kinds = dict(rows.dtypes)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.avg(truthy(f, kinds[f]).cast("double")).alias(f"rate_{f}") for f in fields))


def drops(counts: DataFrame, by: str, order: str, count: str, max_pct: float) -> DataFrame:
    """counts with the one before and whether it fell too far; a first run, or one after none, has nothing to fall from."""
    before = F.lag(count).over(Window.partitionBy(by).orderBy(order))
    out = counts.withColumn("before", before)
    return out.withColumn("broken", F.coalesce((F.col("before") > 0) & (100.0 * (F.col("before") - F.col(count)) > max_pct * F.col("before")), F.lit(False)))


def violations(metrics: DataFrame, min_count: int, rates: dict[str, float]) -> DataFrame:
    failed = [F.when(F.col("n") < min_count, F.lit("min_count")), *(F.when(F.col(f"rate_{f}") < r, F.lit(f)) for f, r in rates.items())]
    return metrics.withColumn("failed", F.array_compact(F.array(*failed))).where(F.size("failed") > 0)


def coverage(rows: DataFrame, by: str, ean: Column, confirmed: Column) -> DataFrame:
    out = rows.groupBy(by).agg(F.count("*").alias("total"), F.count_if(ean.isNotNull()).alias("with_ean"), F.count_if(ean.isNotNull() & confirmed).alias("confirmed"))
    return out.withColumn("pct", F.format_number(100.0 * F.col("with_ean") / F.col("total"), 1))


def health(parts: dict[str, DataFrame]) -> DataFrame:
    """Outcomes of all sources (source, n) with what became of each."""
    out = None
    for outcome, df in parts.items():
        one = df.select("source", "n", F.lit(outcome).alias("outcome"))
        out = one if out is None else out.unionByName(one)
    return out


def snapshot_guard(old: DataFrame, now: DataFrame) -> DataFrame:
    """ean, entity, fate: barcodes of the old snapshot that are nowhere now (lost) or with another entity only (moved)."""
    held = now.groupBy("ean").agg(F.collect_set("entity").alias("holders"))
    out = old.join(held, "ean", "left")
    fate = F.when(F.col("holders").isNull(), "lost").when(~F.array_contains("holders", F.col("entity")), "moved")
    return out.withColumn("fate", fate).where("fate IS NOT NULL").select("ean", "entity", "fate")


def uncovered(observations: DataFrame, members: DataFrame) -> DataFrame:
    """key, times: observations that aren't in exactly one entity."""
    n = members.groupBy("key").count()
    return observations.select("key").join(n, "key", "left").select("key", F.coalesce("count", F.lit(0)).alias("times")).where("times <> 1")


def lost_values(asserted: DataFrame, *held: DataFrame) -> DataFrame:
    out = asserted.distinct()
    for h in held:
        out = out.subtract(h)
    return out


def refuse_to_wipe(evidence: DataFrame, outputs_exist: bool) -> None:
    if outputs_exist and not evidence.limit(1).count():
        raise ValueError("there is no evidence, but there are outputs: refusing to wipe them")


def require_none(bad: DataFrame, what: str) -> None:
    """Raises with up to ten examples if there are any rows."""
    if found := bad.limit(10).collect():
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


def accepted(decisions: DataFrame, candidates: DataFrame, least: float = 0.8) -> DataFrame:
    """Decisions (item, choice, confidence) that name a known candidate, with enough confidence; a null choice clears."""
    known = decisions.join(candidates.select("item", "choice").distinct(), ["item", "choice"], "left_semi")
    return known.unionByName(decisions.where("choice IS NULL")).where(F.col("confidence") >= least)


def migration_report(rows: DataFrame, migrated: DataFrame) -> DataFrame:
    """metric, value of a migration from rows (key, manufacturer, raw barcode `ean`) to migrated ones (manufacturer, ean, confidence):
    counts of both, distinct valid barcodes, barcodes that are none, keys given twice; and of each manufacturer its rows, entities, those
    with a barcode and those confirmed."""
    valid = normalize_ean(F.col("ean").cast("string"))
    one = rows.agg(F.count("*").alias("observations"), F.countDistinct(valid).alias("distinct valid barcodes"), F.count_if(F.col("ean").isNotNull() & (F.trim("ean") != "") & valid.isNull()).alias("invalid barcodes"))
    twice = rows.groupBy("key").count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("key collisions"))
    two = migrated.agg(F.count("*").alias("entities"))
    names = [*one.columns, *twice.columns, *two.columns]
    wide = one.crossJoin(twice).crossJoin(two)  # one row each
    out = wide.select(F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("long").alias("value")) for n in names))))
    of = lambda df, *pairs: df.where("manufacturer IS NOT NULL").groupBy("manufacturer").agg(*(x.alias(n) for n, x in pairs))
    before = of(rows, ("rows", F.count("*")))
    after = of(migrated, ("entities", F.count("*")), ("with barcode", F.count("ean")), ("confirmed", F.count_if(F.col("ean").isNotNull() & (F.col("confidence") == "confirmed"))))
    both = before.join(after, "manufacturer", "full")
    kinds = ("rows", "entities", "with barcode", "confirmed")
    each = both.select(F.inline(F.array(*(F.struct(F.concat(F.col("manufacturer").cast("string"), F.lit(f": {n}")).alias("metric"), F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("long").alias("value")) for n in kinds))))
    return out.unionByName(each)
