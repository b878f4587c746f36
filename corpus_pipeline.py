"""The corpus pipeline: from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. Stages are written as Parquet in between; all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.llm.common import col, semi, written
from ledgerforge.llm.mixing import mix
from ledgerforge.llm.near_dups import near_duplicates
from ledgerforge.llm.packing import pack_documents
from ledgerforge.llm.quality_rules import filter_quality
from ledgerforge.llm.queries import TOKENIZER
from ledgerforge.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them. Rows are judged where they are read; no key is needed."""
    return filter_quality(docs)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays: that with the smallest id.

    Rows that repeat an id are one document: one of them stays, the smallest by text and then by its other columns as JSON.
    Documents without an id or without words have no links and stay. Columns of any name and kind are kept.
    """
    found = written(near_duplicates(docs, shingle=5).select("doc_id", "kept"), "decisions")
    gone = written(found.where("NOT kept").select("doc_id").distinct(), "gone")
    left = semi(docs, gone, "doc_id", how="left_anti")
    twice = written(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not twice.limit(1).count():
        return left
    once = semi(left, twice, "doc_id", how="left_anti")
    rest = F.to_json(F.struct(*(col(c) for c in docs.columns if c not in ("doc_id", "text"))))
    whole = F.struct(*(col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)))
    again = semi(left, twice, "doc_id").groupBy("doc_id").agg(F.min_by(whole, F.struct("text", rest.alias("rest"))).alias("x")).select("x.*").toDF(*docs.columns)
    return once.unionByName(again)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that few owners hold are replaced in the texts; examples that many copy stay. No document goes; null texts stay null."""
    return redact(docs).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated until the sources' shares reach the target entropy; every document stays at least once.

    Null sources are one source, and null texts count one token.
    """
    return mix(docs).select(*map(col, docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents' tokens in sequences of 2048; a null text is an empty one, a null id stays null."""
    return pack_documents(docs, TOKENIZER)


STAGES = [("quality", quality), ("near_dups", near_dups), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]
#: SQL has neither the tokenizer nor the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
