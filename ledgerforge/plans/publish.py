"""The published form of a catalog: products, partitions, index, documents with checksums, validated before they are written."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.json_schema import schema_problems
from ledgerforge.functions.text import blank_to_null
from ledgerforge.sources import files


def products(canonical: DataFrame) -> DataFrame:
    """Blank texts become null, the SKU stands in for a missing code, and category, availability and quantity get their defaults."""
    fill = lambda c, d: F.coalesce(blank_to_null(F.col(c)), F.lit(d)).alias(c)
    made = {"product_code": F.coalesce(blank_to_null(F.col("product_code")), blank_to_null(F.col("sku"))).alias("product_code"), "category": fill("category", "miniatures"), "availability": fill("availability", "unknown"), "quantity": F.coalesce("quantity", F.lit(1)).alias("quantity")}
    if "ean" in canonical.columns:
        made["ean"] = blank_to_null(F.col("ean")).alias("ean")
    if "additional_eans" in canonical.columns:
        clean = F.filter(F.transform("additional_eans", lambda x: F.trim(x)), lambda x: x != "")
        made["additional_eans"] = F.when(F.size(clean) > 0, clean).alias("additional_eans")
    return canonical.select(*(made.get(c, F.col(c)) for c in canonical.columns))


def index(rows: DataFrame, partition: str, id_column: str) -> DataFrame:
    return rows.groupBy(F.col(partition).alias("partition")).agg(F.count("*").alias("records"), F.min(id_column).alias("first_id"))


def consolidated(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """All partitions by key, the rows without one last."""
    return rows.orderBy(F.col(partition).asc_nulls_last(), *order)


def documents(rows: DataFrame, partition: str, order: list[str], kind: str, version: str) -> DataFrame:
    """partition, body, records, bytes, sha256: a JSON document for each partition, its rows in order, nulls left out.

    A document is a value: a partition must fit one task, as it must fit the file that a reader takes whole.
    """
    fields = [c for c in rows.columns if c != partition]
    ranked = F.struct(*order, F.struct(*fields).alias("__row"))
    whole = rows.groupBy(partition).agg(F.transform(F.array_sort(F.collect_list(ranked)), lambda x: x["__row"]).alias("items"), F.count("*").alias("records"))
    body = F.to_json(F.struct(F.lit(1).alias("schemaVersion"), F.lit(kind).alias("kind"), F.lit(version).alias("version"), F.col(partition).alias("partition"), F.struct(F.col("records").alias("items")).alias("counts"), F.col("items")))
    return whole.select(F.col(partition).alias("partition"), body.alias("body"), "records").withColumns({"bytes": F.octet_length("body").cast("long"), "sha256": F.sha2("body", 256)})


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the rules' names."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items())))
    return rows.withColumn("broken", broken).where(F.size("broken") > 0)


def against_schema(docs: DataFrame, schema: dict, most: int = 10) -> DataFrame:
    """partition, errors of documents (partition, body) that aren't as a JSON schema says (schema_problems): up to so many distinct ones each."""
    found = docs.select(F.col("partition").cast("string").alias("partition"), F.try_parse_json("body").alias("v"))
    return found.select("partition", schema_problems(F.col("v"), schema, most).alias("errors")).where(F.size("errors") > 0)


def checksums(files: DataFrame) -> DataFrame:
    """name, bytes, sha256 of files (path, content), as binaryFile reads them: what a copy of the schemas is checked by."""
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """partition, bytes, sha256 of the documents in a tree, as they are read back."""
    return spark.read.text(path).select(F.col("partition").cast("string").alias("partition"), F.octet_length("value").cast("long").alias("bytes"), F.sha2("value", 256).alias("sha256"))


def write_documents(docs: DataFrame, path: str, rules: dict[str, Column] | None = None, *, schema: dict | None = None) -> DataFrame:
    """Publishes valid documents, one a line and file partition, as the tree at path, and returns its manifest, read back.

    They are written to a staging folder beside the tree and compared there, by checksum, with what they should be; then the staging
    folder takes the tree's place by renames. A run that fails before leaves the old tree as it is; one that fails between the two
    renames leaves it beside, where the next run's `recover` puts it back. What this run didn't write is gone after it.
    """
    spark = docs.sparkSession
    path = path.rstrip("/")
    recover(spark, path)
    bad = violations(docs, rules or {"json": F.try_parse_json("body").isNotNull()}).select("partition", "broken")
    if schema is not None:
        bad = bad.select(F.col("partition").cast("string").alias("partition"), "broken").unionByName(against_schema(docs, schema).withColumnRenamed("errors", "broken"))
    if found := bad.limit(10).collect():
        raise ValueError(f"documents break rules: {[(r['partition'], r['broken']) for r in found]}")
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    docs.select("partition", F.col("body").alias("value")).write.partitionBy("partition").text(staging)
    if not files.exists(spark, staging):
        raise ValueError("nothing was written")
    wanted = docs.select(F.col("partition").cast("string").alias("partition"), F.octet_length("body").cast("long").alias("bytes"), F.sha2("body", 256).alias("sha256"))
    written_ = manifest(spark, staging) if docs.limit(1).count() else wanted.limit(0)
    if wanted.exceptAll(written_).limit(1).count() or written_.exceptAll(wanted).limit(1).count():
        files.delete(spark, staging)
        raise ValueError("what was written isn't what was to be written")
    replace(spark, staging, path)
    return manifest(spark, path) if docs.limit(1).count() else wanted.limit(0)


def replace(spark: SparkSession, staging: str, path: str) -> None:
    """Puts a folder in place of another, which stands beside it until it is."""
    old = f"{path}.old-{uuid.uuid4().hex}"
    if files.exists(spark, path):
        files.rename(spark, path, old)
    files.rename(spark, staging, path)
    files.delete(spark, old)


def recover(spark: SparkSession, path: str) -> None:
    """Undoes what a run left that died: a tree that was moved aside returns, staging folders go."""
    parent, _, name = path.rpartition("/")
    left = [x for x in files.children(spark, parent) if x.startswith((f"{name}.old-", f"{name}.staging-"))]
    for x in left:
        if x.startswith(f"{name}.old-") and not files.exists(spark, path):
            files.rename(spark, f"{parent}/{x}", path)
        else:
            files.delete(spark, f"{parent}/{x}")


def copy_checked(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copies a folder's files (schemas, say) beside the tree they belong to and returns their checksums, read back at the target.

    The copy is compared with the source before it takes its place; files that the source no longer has are gone after it.
    """
    target = target.rstrip("/")
    recover(spark, target)
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    for name in files.children(spark, source):
        files.copy(spark, f"{source.rstrip('/')}/{name}", f"{staging}/{name}")
    read = lambda path: checksums(spark.read.format("binaryFile").load(path))
    if read(source).exceptAll(read(staging)).limit(1).count():
        files.delete(spark, staging)
        raise ValueError("the copy isn't what was to be copied")
    replace(spark, staging, target)
    return read(target)
