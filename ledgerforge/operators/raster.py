"""Colours from pixels: medians, spread, calibration; codes of a swatch grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def swatches(pixels: DataFrame, by: str = "img") -> DataFrame:
    """Per image the median of each channel, and the mean of the channels' population deviations."""
    return pixels.groupBy(by).agg(*(F.median(c).alias(c) for c in "rgb"), ((F.stddev_pop("r") + F.stddev_pop("g") + F.stddev_pop("b")) / 3).alias("spread"))


def calibration(distances: DataFrame, column: str, near: float = 40.0) -> DataFrame:
    """The upper middle distance, and the share of those within `near`."""
    middle = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}` DESC)")  # from counts by value, no list
    return distances.agg(middle.cast(distances.schema[column].dataType).alias("middle"), F.avg((F.col(column) <= near).cast("double")).alias("within"))


def grid_codes(spark: SparkSession, rows: int, columns: int, first: int, skips: list[tuple[int, int]], last: int) -> DataFrame:
    """row, column, code: codes in reading order, cells that are skipped left out, none beyond the last."""
    cells = spark.range(rows * columns).select(F.floor(F.col("id") / columns).cast("int").alias("row"), (F.col("id") % columns).cast("int").alias("column"), "id")
    gaps = [r * columns + c for r, c in skips if r < rows and c < columns]
    before = sum((F.when(F.col("id") > g, 1).otherwise(0) for g in gaps), F.lit(0))
    out = cells.where(~F.col("id").isin(gaps)) if gaps else cells
    return out.withColumn("code", (F.lit(first) + F.col("id") - before).cast("int")).where(F.col("code") <= last).select("row", "column", "code")
