"""Ordered rules: the first rule that holds decides."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def first_rule(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    out = F.lit(default)
    for holds, result in reversed(rules):
        out = F.when(holds, F.lit(result)).otherwise(out)
    return out


def without_discontinued(set_name: Column) -> Column:
    return F.trim(F.regexp_replace(set_name, r"(?i)\(discontinued\).*", ""))


def finish_of(set_name: Column, name: Column) -> Column:
    """By set, then by whole words of the name; 'Matte' at last."""
    return first_rule([(F.lower(set_name).contains("metal") | F.upper(set_name).contains("BRASS"), "Metallic"), (name.rlike(r"(?i)\b(gold|silver|bronze|steel|copper)\b"), "Metallic"), (F.lower(name).contains("gloss"), "Gloss"), (F.lower(name).contains("satin"), "Satin")], "Matte")


def ordered_rule_join(items: DataFrame, rules: DataFrame, result: list[str]) -> DataFrame:
    """items (id, brand, set_name), each with the columns of the first rule (rule_no, brand, sets or null for any set) that fits.

    An item without a rule keeps nulls.
    """
    r = rules.withColumnRenamed("brand", "__brand")
    fits = (items["brand"] == r["__brand"]) & (r["sets"].isNull() | F.array_contains(r["sets"], items["set_name"]))
    found = items.join(r, fits, "left").groupBy("id").agg(F.min_by(F.struct(*result), "rule_no").alias("x"))
    return found.select("id", *(F.col(f"x.{c}").alias(c) for c in result))


def rule_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def substring_rules(items: DataFrame, rules: list[tuple[int, str | None, str, str, str]], *, brand: str = "brand", default: str | None = None) -> DataFrame:
    """items with `rule` and `result`: the first rule (number, brand or None, field, part, result) whose part the item's field contains.

    Rules of the item's brand come before rules of any brand, and then go by their numbers; parts and fields are compared in lower case.
    Items without a rule have a null rule and the default. The list is hand-kept: each task holds it as one automaton a field, so a text is
    read once, however many rules there are. A null field contains nothing.
    """
    fields = sorted({f for _, _, f, _, _ in rules})
    order = sorted(range(len(rules)), key=lambda k: (rules[k][1] is None, rules[k][0]))
    rank = {k: n for n, k in enumerate(order)}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, ahocorasick.Automaton] = {}
        for f in fields:
            parts: dict[str, list[int]] = {}
            for k, (_, _, field, part, _) in enumerate(rules):
                if field == f and part:
                    parts.setdefault(part.lower(), []).append(k)
            found[f] = ahocorasick.Automaton()
            for part, ks in parts.items():
                found[f].add_word(part, ks)
            found[f].make_automaton()
        for batch in batches:
            brands = batch.column(batch.schema.names.index("__brand")).to_pylist()
            best: list[int | None] = [None] * batch.num_rows
            for f in fields:
                if not len(found[f]):
                    continue
                for i, text in enumerate(batch.column(batch.schema.names.index(f"__{f}")).to_pylist()):
                    for _, ks in found[f].iter(text.lower()) if text else ():
                        for k in ks:
                            if rules[k][1] in (None, brands[i]) and (best[i] is None or rank[k] < rank[best[i]]):
                                best[i] = k
            own = batch.select([n for n in batch.schema.names if not n.startswith("__")])
            columns = [pa.array([None if k is None else rules[k][0] for k in best], pa.int32()), pa.array([default if k is None else rules[k][4] for k in best], pa.string())]
            yield pa.RecordBatch.from_arrays([*own.columns, *columns], [*own.schema.names, "rule", "result"])

    rows = items.select("*", F.col(brand).cast("string").alias("__brand"), *(F.col(f).cast("string").alias(f"__{f}") for f in fields))
    return rows.mapInArrow(apply, StructType([*items.schema.fields, StructField("rule", IntegerType()), StructField("result", StringType())]))
