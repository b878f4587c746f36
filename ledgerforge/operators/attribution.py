"""Which manufacturer a claim belongs to, and its codes in the manufacturer's form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_code(code: Column, strip: Column, pattern: Column | str) -> Column:
    """Upper case without spaces, each prefix of `strip` removed in turn, no -EN at the end; null if it doesn't match in full."""
    bare = F.regexp_replace(F.upper(code), r"\s", "")
    bare = F.aggregate(strip, bare, lambda acc, p: F.when(F.startswith(acc, p), F.substring(acc, F.length(p) + 1, F.length(acc))).otherwise(acc))
    bare = F.regexp_replace(bare, "-EN$", "")
    return F.when(F.regexp(bare, F.concat(F.lit("(?i)^(?:"), F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(")$"))), bare)


def by_vendor(claims: DataFrame, vendors: DataFrame, column: str = "vendor") -> DataFrame:
    """claims with `by_vendor`: the slug of the vendor name, case folded. vendors: slug, vendor, one slug a name."""
    names = vendors.select(F.lower("vendor").alias("__v"), F.col("slug").alias("by_vendor")).distinct()
    return claims.join(names, F.lower(column) == names["__v"], "left").drop("__v")


def by_prefix(claims: DataFrame, prefixes: DataFrame, key: str, column: str = "ean") -> DataFrame:
    """claims with `by_prefix`: the first prefix, by slug and its place, that the barcode begins with.

    An equi-join on the prefix of each length in use, rather than a comparison with every prefix.
    """
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect())  # lengths of barcode prefixes: a dozen at most
    cut = claims.select(key, F.explode(F.array(*(F.substring(column, 1, n) for n in lengths))).alias("prefix")).distinct() if lengths else claims.select(key, F.lit(None).cast("string").alias("prefix"))
    found = cut.join(prefixes, "prefix").groupBy(key).agg(F.min_by("slug", F.struct("slug", "place")).alias("by_prefix"))
    return claims.join(found, key, "left")


def cascade(claims: DataFrame) -> DataFrame:
    """The vendor's manufacturer, else the barcode's."""
    return claims.withColumn("manufacturer", F.coalesce("by_vendor", "by_prefix"))


def ambiguous_vendors(vendors: DataFrame) -> DataFrame:
    """Folded vendor names of more than one slug: an error in the registry."""
    return vendors.groupBy(F.lower("vendor").alias("vendor")).agg(F.countDistinct("slug").alias("slugs")).where("slugs > 1")
