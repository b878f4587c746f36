"""Vectors of whole numbers, and blocks of them: what the operators on embeddings share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import col

#: Most numbers in a block (32 MB); of short vectors at most so many rows.
BLOCK_VALUES, BLOCK_ROWS = 1 << 22, 8192


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int, *more: str) -> DataFrame:
    """id, more columns as longs, q: floor(scale * x) of each component x, as double.

    Null vectors and vectors with a null or non-finite component are left out. A number that no long can hold becomes the nearest.
    """
    x = col(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    q = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    return vectors.where(x.isNotNull() & ~odd).select(col(vec_id).cast("long").alias("id"), *(col(c).cast("long").alias(c) for c in more), q.alias("q"))


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of a matrix, shorter ones filled with zeros."""
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == len(lists) * width:
        return flat.reshape(-1, width)
    out = np.zeros((len(lists), width), np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def block_rows(width: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, width)))


def packed(rows: DataFrame, longs: list[str], width: int, most: float, size: int | None = None) -> DataFrame:
    """n, data: blocks of at most `size` rows of one task: their long columns one after the other, and the matrix of q.

    A number beyond `most` fails the query: sums or products of such would pass a long.
    """
    size = size or block_rows(width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        count = 0

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            values = matrix(table["q"].chunk(0), width)
            if float(np.abs(values.astype(np.float64)).max(initial=0)) > most:
                raise ValueError(f"components beyond {most:.3g} make sums that no long can hold")
            data = b"".join(np.ascontiguousarray(table[c].to_numpy(), "<i8").tobytes() for c in longs) + np.ascontiguousarray(values, "<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int64()), pa.array([data], pa.binary())], ["n", "data"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - count)
                parts.append(part)
                at, count = at + part.num_rows, count + part.num_rows
                if count == size:
                    yield out()
                    parts, count = [], 0
        if count:
            yield out()

    return rows.select(*longs, "q").mapInArrow(pack, "n long, data binary")


def unpacked(data: bytes, n: int, longs: int) -> tuple[np.ndarray, np.ndarray]:
    """The long columns (one a row), and the matrix."""
    all_ = np.frombuffer(data, "<i8")
    return all_[: n * longs].reshape(longs, n), all_[n * longs :].reshape(n, -1)


def width_of(vectors: DataFrame, vector: str) -> int | None:
    """The longest vector's length; None without vectors."""
    return vectors.agg(F.max(F.when(col(vector).isNotNull(), F.size(col(vector))))).first()[0]


def blocks_of(rows: int, width: int) -> int:
    return max(1, math.ceil(rows / block_rows(width)))


def beside(file: DataFrame, packs: DataFrame, blocks: int) -> DataFrame:
    """block, kind, part, n, data: the blocks of a file (kind 0), and behind each, in one partition, all packs (kind 1).

    A union, dealt and sorted by block: a join would broadcast a side that is small on disk, with every pack once for each block.
    """
    columns = [F.col("block").cast("int").alias("block"), "kind", F.col("part").cast("long").alias("part"), F.col("n").cast("long").alias("n"), "data"]
    each = packs.withColumn("kind", F.lit(1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return file.withColumn("kind", F.lit(0)).select(*columns).unionByName(each.select(*columns)).repartition(blocks, "block").sortWithinPartitions("block", "kind", "part")


def meetings(batches: Iterator[pa.RecordBatch], made: Callable) -> Iterator[tuple[list, int, int, bytes]]:
    """Of rows as `beside` gives them: for each pack the blocks before it, as made(data, n) makes them, its part, n and data."""
    at, kept = None, []
    for batch in batches:
        for block, kind, part, n, data in zip(*batch.columns, strict=True):
            if at != block.as_py():
                at, kept = block.as_py(), []
            if kind.as_py() == 0:
                kept.append(made(data.as_py(), n.as_py()))
            else:
                yield kept, part.as_py(), n.as_py(), data.as_py()
