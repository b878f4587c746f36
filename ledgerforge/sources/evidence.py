"""The evidence ledger: one folder of JSON lines per source, the last line of a key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources import files

SCHEMA = (
    "key string, url string, manufacturer string, name string, sku string, ean string, priceGbp double, priceUsd double, priceEur double, priceCad double, "
    "imageUrl string, availability string, hints map<string,string>, firstSeen date, lastSeen date, missStreak int, archived boolean, extractor string"
)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Observations of all sources under path/<source>/observations.jsonl, with source_id; identifiers stay texts.

    Of lines with equal keys the last counts, by file and then by place; lines that don't parse fail the read. Without files there is
    no evidence.
    """
    if not any(files.exists(spark, f"{path}/{s}/observations.jsonl") for s in files.children(spark, path)):
        return spark.createDataFrame([], f"{SCHEMA}, source_id string")
    rows = spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(f"{path}/*/observations.jsonl")
    rows = rows.withColumns({"__file": F.col("_metadata.file_path"), "__place": F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())})
    fields = [f for f in rows.columns if not f.startswith("__")]
    last = rows.groupBy("__file", "key").agg(F.max_by(F.struct(*fields), "__place").alias("x")).select("x.*")
    return last.withColumns({"missStreak": F.coalesce("missStreak", F.lit(0)), "archived": F.coalesce("archived", F.lit(False)), "source_id": F.split_part("key", F.lit(":"), F.lit(1))})


def write_evidence(rows: DataFrame, path: str) -> None:
    """Lines sorted by key, fields sorted by name, nulls left out; one folder per source."""
    body = F.to_json(F.struct(*sorted(c for c in rows.columns if c != "source_id")))
    out = rows.select(F.split_part("key", F.lit(":"), F.lit(1)).alias("source"), "key", body.alias("value"))
    out.repartition("source").sortWithinPartitions("source", "key").select("source", "value").write.mode("overwrite").partitionBy("source").text(path)


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small JSON documents, one a file, each with its file's stem as `stem`."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.withColumn("stem", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1))


def require_ids_match(descriptors: DataFrame) -> DataFrame:
    """Descriptors whose id isn't their file's name fail the query."""
    said = F.concat(F.lit("descriptor in the wrong file: "), F.col("stem"))
    return descriptors.withColumn("id", F.when(F.col("id") == F.col("stem"), F.col("id")).otherwise(F.raise_error(said)))


def read_snapshot(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The state as one run left it: path/snap=<version>."""
    return spark.read.parquet(f"{path}/snap={version}")


def write_snapshot(rows: DataFrame, path: str, version: str) -> None:
    """Writes a run's state beside the earlier ones; a version is written once."""
    rows.write.mode("errorifexists").parquet(f"{path}/snap={version}")
