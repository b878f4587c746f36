"""Pipe tables in Markdown, and label dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.text import hex_channel


def read_paint_tables(spark: SparkSession, path: str, brands: dict[str, str]) -> DataFrame:
    """brand, place, name, code, set_name, r, g, b, hex, discontinued of the tables in <stem>.md of each known stem.

    A table begins at a header with Name and Hex, Code is optional. Rows without a colour in their last cell are dropped.
    """
    lines = spark.read.text(f"{path}/*.md").withColumns({"stem": F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.md$", 1), "place": F.monotonically_increasing_id()})
    known = F.broadcast(spark.createDataFrame(list(brands.items()), "stem string, brand string"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.where(F.startswith(F.trim("value"), F.lit("|"))).join(known, "stem").withColumn("c", cells)
    coded = rows.where(F.array_contains("c", "Name") & F.array_contains("c", "Hex")).groupBy("stem").agg(F.bool_or(F.array_contains("c", "Code")).alias("coded"))
    rows = rows.join(coded, "stem").where(F.size("c") == F.when(F.col("coded"), 7).otherwise(6))
    at = lambda k: F.get("c", k + F.when(F.col("coded") & F.lit(k > 0), 1).otherwise(0))
    hexa = F.regexp_extract(at(5), r"#([0-9A-Fa-f]{6})", 1)
    rows = rows.where(F.length(hexa) == 6).select("brand", "place", F.get("c", F.lit(0)).alias("name"), F.when(F.col("coded"), F.nullif(F.get("c", F.lit(1)), F.lit(""))).alias("code"), at(1).alias("set_name"), F.concat(F.lit("#"), hexa).alias("hex"))
    channels = {c: hex_channel(F.col("hex"), k) for k, c in enumerate("rgb")}
    return rows.withColumns({**channels, "discontinued": F.lower("set_name").contains("(discontinued)")})


def labels_checked(labels: DataFrame) -> DataFrame:
    """slug, label; a slug given twice fails the query."""
    n = labels.groupBy("slug").agg(F.first("label").alias("label"), F.count("*").alias("n"))
    return n.select(F.when(F.col("n") == 1, F.col("slug")).otherwise(F.raise_error(F.concat(F.lit("label given twice: "), F.col("slug")))).alias("slug"), "label")


def with_labels(rows: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """rows with the label of a slug; a slug without one fails the query, no slug has none."""
    dim = labels_checked(labels).select(F.col("slug").alias("__s"), F.col("label").alias("__l"))
    found = rows.join(dim, rows[column] == dim["__s"], "left")
    missing = F.raise_error(F.concat(F.lit(f"no label for {column} "), F.col(column)))
    return found.withColumn(out, F.when(F.col(column).isNull(), None).when(F.col("__s").isNull(), missing).otherwise(F.col("__l"))).drop("__s", "__l")


def write_labels(labels: DataFrame, path: str) -> None:
    """Writes slugs and their labels, checked, as one list in the order of slugs: path/part-*, a line of JSON each."""
    rows = labels_checked(labels).repartition(1).sortWithinPartitions("slug")  # a label list is small, and one file by its nature
    rows.select(F.to_json(F.struct("label", "slug")).alias("value")).write.mode("overwrite").text(path)
