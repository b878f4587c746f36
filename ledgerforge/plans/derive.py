"""Stand-ins for the catalog's inputs, derived from the star schema by integer arithmetic alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.barcode import ean_from_number

KINDS = ("curated", "manufacturer", "manufacturer", "retailer", "archive", "barcode-db")
#: So many lines of a task, whose rows are sorted several times wider than they were shuffled, fit into its memory.
TASK_LINES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    channel = lambda k, s: ((F.col("p_partkey") * k + F.col("p_size") * s) % 256).cast("int")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").alias("index"), F.col("p_brand").alias("brand"), F.col("p_type").alias("set_name"), F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("code"),
        channel(37, 11).alias("r"), channel(59, 7).alias("g"), channel(101, 13).alias("b"), (F.col("p_size") % 10 == 0).alias("discontinued"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
    )


PAINTS_SQL = """paint AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS set_name, p_name AS name, CAST(p_partkey AS VARCHAR) AS code,
  (p_partkey * 37 + p_size * 11) % 256 AS r, (p_partkey * 59 + p_size * 7) % 256 AS g, (p_partkey * 101 + p_size * 13) % 256 AS b,
  p_size % 10 = 0 AS discontinued, p_size AS size, p_retailprice AS price FROM part)"""


def observations(spark: SparkSession, sf_dir: str, *, repeats: bool = False, by_part: bool = False) -> DataFrame:
    """One row per key: source, kind, priority, manufacturer, key, code, ean, name, seen, price, part, archived, miss_streak.

    repeats: a key's rows stay as they are, without a shuffle. That is for queries to which a row and its repeats are the same, as they
    ask which values there are and not how many rows; all columns but seen and price follow from the key. by_part: a key's rows are brought
    together by its part, so that what is grouped by part and more needs no further shuffle; partitions are as many as lines, counted first, need.
    """
    key, lines = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], table(spark, sf_dir, "lineitem")
    if repeats:
        row = lines.select(*key, F.col("l_shipdate").alias("shipped"), F.col("l_extendedprice").alias("price"))
    else:
        if by_part:
            tasks = lines.count() // TASK_LINES
            # by number, as partitions would else be joined until they have what Spark holds for enough bytes
            more = [max(tasks, spark.sparkContext.defaultParallelism)] if tasks else []
            lines = lines.select(*key, "l_shipdate", "l_extendedprice").repartition(*more, "l_partkey")
        row = lines.groupBy(*key).agg(F.min("l_shipdate").alias("shipped"), F.min("l_extendedprice").alias("price"))
    source = F.col("l_suppkey") % 6
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (source + 1).cast("int"))
    priority = F.element_at(F.array(*map(F.lit, (0, 1, 1, 2, 3, 4))), (source + 1).cast("int"))
    # by number: what follows repeats the expression, in filters and keys
    number = F.lit(500000000000) + F.col("l_partkey") % 1000003
    return row.select(
        source.cast("int").alias("source"), kind.alias("kind"), priority.alias("priority"), (F.col("l_suppkey") % 7).cast("int").alias("manufacturer"),
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey").cast("string")).alias("code"), F.when(F.col("l_partkey") % 4 != 0, ean_from_number(number)).alias("ean"),
        F.concat(F.lit("item "), (F.col("l_partkey") % 500).cast("string")).alias("name"), F.to_date("shipped").alias("seen"), "price", F.col("l_partkey").alias("part"),
        (F.col("l_orderkey") % 11 == 0).alias("archived"), (F.col("l_orderkey") % 5).cast("int").alias("miss_streak"),
    )


CHECK_SQL = "CAST((10 - ({sum}) % 10) % 10 AS VARCHAR)"


def check_sql(stem: str) -> str:
    """DuckDB's check digit of a twelve-digit expression."""
    total = " + ".join(f"CAST(substr({stem}, {i}, 1) AS INTEGER) * {3 if i % 2 == 0 else 1}" for i in range(1, 13))
    return f"CAST((10 - ({total}) % 10) % 10 AS VARCHAR)"


_STEM = "('50' || lpad(CAST(l_partkey % 1000003 AS VARCHAR), 10, '0'))"
OBS_SQL = f"""row_ AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_shipdate) AS shipped, min(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
obs AS (SELECT CAST(l_suppkey % 6 AS INTEGER) AS source, ['curated', 'manufacturer', 'manufacturer', 'retailer', 'archive', 'barcode-db'][l_suppkey % 6 + 1] AS kind,
  [0, 1, 1, 2, 3, 4][l_suppkey % 6 + 1] AS priority, CAST(l_suppkey % 7 AS INTEGER) AS manufacturer,
  concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key, CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS code,
  CASE WHEN l_partkey % 4 <> 0 THEN {_STEM} || {check_sql(_STEM)} END AS ean, 'item ' || CAST(l_partkey % 500 AS VARCHAR) AS name,
  CAST(shipped AS DATE) AS seen, price, l_partkey AS part, l_orderkey % 11 = 0 AS archived, CAST(l_orderkey % 5 AS INTEGER) AS miss_streak FROM row_)"""
