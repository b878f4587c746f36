"""What the operators of this subpackage share: written intermediate tables, size-checked joins, table access."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources.shared import at_most, delete, shared_dir, shared_path, written

__all__ = ["BROADCAST_ROWS", "at_most", "col", "delete", "free", "semi", "shared_dir", "shared_path", "table", "written"]

#: Most rows of a one- or two-column table of longs that a plan may broadcast (16 MB a column).
BROADCAST_ROWS = 1_000_000


def semi(df: DataFrame, ids: DataFrame, column: str, *, how: str = "left_semi", rows: int = BROADCAST_ROWS) -> DataFrame:
    """df's rows whose column is (how='left_anti': isn't) among ids' only column.

    A table of ids within the bound is broadcast, so that df's texts stay where they are; a larger one is joined by a shuffle.
    """
    ids = ids.toDF("__id")
    if at_most(ids, rows):
        ids = F.broadcast(ids)
    return df.join(ids, df[column] == ids["__id"], how)


def col(name: str) -> Column:
    """The column of that name, whatever is in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def free(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores before them as far as columns (case folded) have them already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: Tasks over which an input of fewer files is dealt, at most.
DEALT = 64


def table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A table, dealt over the cores where its files make fewer tasks: one small file would be one task's work."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*columns) if columns else df
    tasks = min(DEALT, spark.sparkContext.defaultParallelism)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
