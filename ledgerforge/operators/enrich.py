"""Joins that add to catalog rows: what is missing, what is new, what overrides."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerforge.functions.text import hex_channel


def additions(base: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """base, and the rows of new whose keys (case folded, null as '') base hasn't; of several with equal keys the first by `order`."""
    fold = lambda df: df.withColumn("__k", F.concat_ws("\x01", *(F.lower(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys)))
    first = fold(new).groupBy("__k").agg(F.min_by(F.struct(*new.columns), order).alias("x"))
    fresh = first.join(fold(base).select("__k").distinct(), "__k", "left_anti").select("x.*")
    return base.unionByName(fresh.select(*base.columns))


def fill_blanks(base: DataFrame, more: DataFrame, key: list[str], fields: list[str], *, wins: bool = False) -> DataFrame:
    """base with blank fields from more (one row a key); wins: more's values that aren't blank come first."""
    dim = more.select(*key, *(F.col(f).alias(f"__{f}") for f in fields))
    out = base.join(dim, key, "left")
    blank = lambda c: F.when(F.trim(c.cast("string")) != "", c)
    pick = lambda f: F.coalesce(*((blank(F.col(f"__{f}")), F.col(f)) if wins else (blank(F.col(f)), F.col(f"__{f}"))))
    return out.withColumns({f: pick(f) for f in fields}).drop(*(f"__{f}" for f in fields))


def override_colours(base: DataFrame, overrides: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """base (with hex, r, g, b) with the overrides' values that aren't blank; where one names another colour, its channels follow from it.

    An override's hex is taken with or without '#', in either case; one that is no colour changes nothing.
    """
    given = F.upper(F.regexp_replace(F.trim("hex"), "^#", ""))
    known = overrides.withColumn("hex", F.when(given.rlike("^[0-9A-F]{6}$"), F.concat(F.lit("#"), given)))
    out = fill_blanks(base.withColumn("__was", F.col("hex")), known, key, [*dict.fromkeys([*fields, "hex"])], wins=True)
    new = ~F.lower("hex").eqNullSafe(F.lower("__was"))
    return out.withColumns({c: F.when(new, hex_channel(F.col("hex"), k)).otherwise(F.col(c)) for k, c in enumerate("rgb")}).drop("__was")


def ratchet(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """new, and what old has under keys that new hasn't."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def unique_only(dim: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of keys that name one value only."""
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.countDistinct(value).alias("n")).where("n = 1").drop("n")


def code_cascade(claims: DataFrame, dim: DataFrame, width: int = 5) -> DataFrame:
    """claims (code, name) with `match` from dim (id, code, name): by the code as it is, then padded with zeros, then by a unique name."""
    codes = unique_only(dim, "code", "id")
    names = unique_only(dim.withColumn("name", F.lower("name")), "name", "id")
    out = claims.join(codes.toDF("__c1", "__m1"), F.col("code") == F.col("__c1"), "left")
    out = out.join(codes.toDF("__c2", "__m2"), F.lpad("code", width, "0") == F.col("__c2"), "left")
    out = out.join(names.toDF("__c3", "__m3"), F.lower("name") == F.col("__c3"), "left")
    return out.withColumn("match", F.coalesce("__m1", "__m2", "__m3")).drop("__c1", "__m1", "__c2", "__m2", "__c3", "__m3")


def longest_suffix(claims: DataFrame, dim: DataFrame, least: int = 5) -> DataFrame:
    """(claim, match): the item (id, name) whose name is the longest end of the claim's text, if only one is that long.

    An equi-join: a claim is looked up by each of its own ends, so the work grows with text lengths, not with items.
    """
    ends = claims.select("claim", F.explode(F.expr(f"CASE WHEN length(text) >= {least} THEN transform(sequence({least}, length(text)), n -> right(text, n)) ELSE array() END")).alias("name"))
    found = ends.join(dim.where(F.length("name") >= least), "name").groupBy("claim", F.length("name").alias("n")).agg(F.min("id").alias("match"), F.countDistinct("id").alias("k"))
    best = found.groupBy("claim").agg(F.max_by(F.struct("match", "k"), "n").alias("x"))
    return best.where("x.k = 1").select("claim", "x.match")


def ratio_from(least: float) -> Callable[[Column, Column], Column]:
    """A function of two columns of texts: how alike they are, null if their numbers of equal characters alone rule `least` out."""

    @F.pandas_udf(DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> float | None:
            pair = SequenceMatcher(None, x, y)
            return pair.ratio() if pair.quick_ratio() >= least - 1e-9 else None

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio


def _numbered(pieces: Column) -> Column:
    """Of a text's pieces in order (part, at, single): the second of equal ones told from the first, and so on, so that a set stands for a
    multiset; where it lies; and whether it is the only one of its kind."""
    told = lambda o: F.transform(o, lambda x, k: F.struct(F.concat(x["c"], F.lit("\x01"), (k + 1 - F.array_position(o["c"], x["c"])).cast("string")).alias("part"), x["at"].alias("at"), (F.size(F.filter(o["c"], lambda c: c == x["c"])) == 1).alias("single")))
    # as a function's argument the pieces are put in order once, not once for each of them
    return F.flatten(F.transform(F.array(F.array_sort(F.transform(pieces, lambda c, k: F.struct(c.alias("c"), k.alias("at"))))), told))


def _letters(x: Column) -> Column:
    return _numbered(F.filter(F.split(x, ""), lambda c: c != ""))


def _bigrams(x: Column) -> Column:
    return _numbered(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda k: F.substring(x, k, F.lit(2))))


def similar_names(ours: DataFrame, theirs: DataFrame, block: str, least: float) -> DataFrame:
    """block, name, other: the pairs of distinct names of a block that may be alike by `least`, and few others.

    The ratio is twice the characters in common blocks over both lengths. Between two such blocks a character is left over, so names
    that are alike have so many pairs of neighbouring characters in common: (la + lb) * (1.5 * least - 1) - 1 at least. Of a name's pairs,
    rarest in the block first, all but that many and one more are its prefix; two names that are alike meet in a prefix, by a pair that
    lies in a common block, and so in places no farther apart than there are characters left over. Names so short that the bound says
    nothing go by single characters, with all names of a length near theirs.
    """
    gain, stretch = 1.5 * least - 1, (2 - least) / least
    # (la + la / stretch) * gain - 1 must reach one
    short = 2 / (gain * (1 + 1 / stretch)) if gain > 0 else float("inf")
    names = ours.withColumn("side", F.lit(0)).unionByName(theirs.withColumnRenamed("other", "name").withColumn("side", F.lit(1))).withColumn("n", F.length("name"))
    by_pairs = names.where(F.col("n") >= short).select("side", block, "name", _bigrams(F.col("name")).alias("parts"), F.ceil(F.col("n") * (1 + 1 / stretch) * gain - 1 - 1e-9).alias("common"))
    by_letters = names.where((F.col("n") > 0) & (F.col("n") <= short * stretch)).select("side", block, "name", _letters(F.col("name")).alias("parts"), F.ceil(least * F.col("n") * (1 + 1 / stretch) / 2 - 1e-9).alias("common"))
    rows = by_pairs.withColumn("kind", F.lit(2)).unionByName(by_letters.withColumn("kind", F.lit(1)))
    each = rows.select("side", block, "name", "kind", "common", F.inline("parts"))
    often = each.groupBy(block, "kind", "part").agg(F.count("*").alias("n"))
    prefix = F.slice(F.array_sort(F.collect_list(F.struct("n", "part", "at", "single"))), F.lit(1), F.greatest(F.count("*") - F.first("common") + 1, F.lit(1)).cast("int"))
    first = each.join(often, [block, "kind", "part"]).groupBy("side", block, "name", "kind").agg(prefix.alias("first")).select("side", block, "name", "kind", F.inline("first")).drop("n")
    left, right = first.where("side = 0").drop("side"), first.where("side = 1").select(block, "kind", "part", F.col("name").alias("other"), F.col("at").alias("at_b"), F.col("single").alias("single_b"))
    la, lb = F.length("name"), F.length("other")
    near = ~(F.col("single") & F.col("single_b")) | (F.abs(F.col("at") - F.col("at_b")) <= (1 - least) * (la + lb) + 1e-9)
    return left.join(right, [block, "kind", "part"]).where(near & (2.0 * F.least(la, lb) >= least * (la + lb) - 1e-9)).select(block, "name", "other").distinct()


def fuzzy(claims: DataFrame, dim: DataFrame, block: str, least: float = 0.86) -> DataFrame:
    """(claim, match, ratio): within a block the item whose name is most alike, at `least` or more; ties to the smaller id.

    Names are compared once for each pair of distinct ones that similar_names gives; pairs whose numbers of equal characters alone rule
    the ratio out aren't compared further. Two empty names are alike.
    """
    ours, theirs = claims.select(block, "name").distinct(), dim.select(block, F.col("name").alias("other")).distinct()
    empty = ours.where("name = ''").join(theirs.where("other = ''"), block).select(block, "name", "other")
    pairs = similar_names(ours, theirs, block, least).unionByName(empty)
    pairs = pairs.withColumn("ratio", ratio_from(least)("name", "other")).where(F.col("ratio") >= least)
    # a name's best match is sought before claims and items are rows again: those of one name would meet in all pairs
    order = lambda x="": F.struct(f"{x}ratio", -F.col(f"{x}id"))
    items = dim.groupBy(block, F.col("name").alias("other")).agg(F.min("id").alias("id"))
    best = pairs.join(items, [block, "other"]).groupBy(block, "name").agg(F.max_by(F.struct("id", "ratio"), order()).alias("x"))
    found = claims.select("claim", block, "name").join(best, [block, "name"])
    return found.groupBy("claim").agg(F.max_by("x", order("x.")).alias("x")).select("claim", F.col("x.id").alias("match"), "x.ratio")


def pair_candidates(rows: DataFrame, rules: dict[str, tuple[list[Column], list[Column]]]) -> DataFrame:
    """(a, b, rules) for a < b: pairs of rows (id, which is one row's) that a rule's two keys join; null keys join nothing.

    A pair is made by the first rule that joins it, which sees from both rows' keys what the others say. So rows are shuffled with their
    keys, and pairs, which may be far more, aren't.
    """
    names = sorted(rules)
    keys = [[(f"left{i}_{k}", f"right{i}_{k}") for k in range(len(rules[n][0]))] for i, n in enumerate(names)]
    both = [c.alias(f"{way}{i}_{k}") for i, n in enumerate(names) for way, side in zip(("left", "right"), rules[n], strict=True) for k, c in enumerate(side)]
    sides = rows.select("id", *both)
    x, y = (sides.toDF(*(f"{at}_{c}" for c in sides.columns)) for at in "xy")
    joins = lambda i, a, b: reduce(and_, (F.col(f"{a}_{left}") == F.col(f"{b}_{right}") for left, right in keys[i]))
    says = lambda i, a, b: F.coalesce(joins(i, a, b), F.lit(False))
    out = None
    for i, name in enumerate(names):
        # of a rule that joins a pair both ways one way counts
        once = (F.col("x_id") < F.col("y_id")) | ((F.col("x_id") > F.col("y_id")) & ~says(i, "y", "x"))
        fresh = reduce(and_, (~says(j, "x", "y") & ~says(j, "y", "x") for j in range(i)), once)
        others = [F.when(says(j, "x", "y") | says(j, "y", "x"), F.array(F.lit(names[j]))).otherwise(F.array().cast("array<string>")) for j in range(i + 1, len(names))]
        pairs = x.where(reduce(and_, (F.col(f"x_{left}").isNotNull() for left, _ in keys[i]))).join(y, joins(i, "x", "y") & fresh)
        pairs = pairs.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"), F.concat(F.array(F.lit(name)), *others).alias("rules"))
        out = pairs if out is None else out.unionByName(pairs)
    return out


def ranked(rows: DataFrame, by: list[str], order: list[Column], keep: int = 1) -> DataFrame:
    """The first rows of each group. The order must be total."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= keep).drop("__n")


def suffixed(rows: DataFrame, id_column: str, order: list[Column]) -> DataFrame:
    """Equal ids told apart: the second gets -2, the third -3, by `order`."""
    n = F.row_number().over(Window.partitionBy(id_column).orderBy(*order))
    return rows.withColumn("__n", n).withColumn(id_column, F.when(F.col("__n") > 1, F.concat_ws("-", id_column, F.col("__n").cast("string"))).otherwise(F.col(id_column))).drop("__n")


def merged_first(rows: DataFrame, by: list[str], order: str, scalars: list[str], hints: str | None = None) -> DataFrame:
    """Per group the first value of each field that isn't null, in scan order; of hints (a map column) the first value of each key."""
    out = rows.groupBy(*by).agg(*(F.expr(f"min_by({c}, {order}) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in scalars))
    if hints is None:
        return out
    first = rows.select(*by, F.col(order).alias("__o"), F.explode(hints).alias("__k", "__v")).where("__v IS NOT NULL").groupBy(*by, "__k").agg(F.min_by("__v", "__o").alias("__v"))
    merged = first.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "__v")))).alias(hints))
    return out.join(merged, by, "left").withColumn(hints, F.coalesce(hints, F.create_map().cast(merged.schema[hints].dataType)))
