"""Hard negatives over a vector-approximation file.

The file holds blocks of vectors. In a block each dimension is cut into 16 cells at the block's own quantiles, and a row is known by
its cells, two dimensions a byte. An anchor turns a block's cells into tables of the least and the most that each cell can add to
the inner product; looking a row's bytes up gives bounds of its score. Rows are scored exactly only if by their bounds they may be
among the best, or may enter a window and be among its best.

Two passes: an anchor's positives are found first, for the windows follow from their scores. In either, packs of anchors meet every
block, behind which they lie in one sorted partition, so hot labels and copies don't gather anywhere: a label is a stretch of each block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm.common import col, written
from ledgerforge.llm.vectors import beside, blocks_of, meetings, packed, quantised, unpacked, width_of

CELLS, PACK_ANCHORS = 16, 1024


class CellBlock:
    """Rows of the file by label and id, their cells, and bounds of their scores."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        rows, dims = self.values.shape
        pairs = -(-dims // 2)
        self.low, self.high = np.zeros((2, 2 * pairs, CELLS), np.int64)
        self.bytes = np.zeros((pairs, rows), np.intp)
        for d in range(dims):
            x = np.sort(self.values[:, d])
            marks = x[np.arange(1, CELLS) * rows // CELLS]
            starts = np.concatenate([[0], np.searchsorted(x, marks)])
            ends = np.concatenate([starts[1:], [rows]])
            held = ends > starts
            self.low[d, held], self.high[d, held] = x[starts[held]], x[ends[held] - 1]
            self.bytes[d // 2] += np.searchsorted(marks, self.values[:, d], "right") << 4 * (d % 2)

    def stretch(self, label: int) -> tuple[int, int]:
        """Where the rows of that label lie."""
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def tables(self, query: np.ndarray) -> np.ndarray:
        """(pair, byte, 2): the least and the most that the two cells of a byte add to the score."""
        q = np.zeros(len(self.low), np.int64)
        q[: len(query)] = query
        a, b = self.low * q[:, None], self.high * q[:, None]
        part = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=2)
        return (part[1::2, :, None] + part[::2, None, :]).reshape(len(part) // 2, CELLS * CELLS, 2)

    def bounds(self, tables: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros((end - start, 2), np.int64)
        for table, cells in zip(tables, self.bytes, strict=True):
            total += table.take(cells[start:end], axis=0)
        return total[:, 0], total[:, 1]

    def _first(self, query: np.ndarray, rows: np.ndarray, k: int, low: int | None = None, high: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best of the rows, scored exactly, within the window if there is one."""
        scores, ids = self.values[rows] @ query, self.ids[rows]
        if low is not None:
            inside = (scores >= low) & (scores <= high)
            scores, ids = scores[inside], ids[inside]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def positives(self, query: np.ndarray, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of the same label and another id."""
        start, end = self.stretch(label)
        low, high = self.bounds(self.tables(query), start, end)
        others = self.ids[start:end] != own
        if others.sum() > k:
            others &= high >= np.partition(low[others], -k)[-k]
        return self._first(query, start + np.flatnonzero(others), k)

    def negatives(self, query: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each window the k best rows of other labels that are inside."""
        start, end = self.stretch(label)
        tables = self.tables(query)
        rows = np.concatenate([np.arange(start), np.arange(end, len(self.ids))])
        low, high = (np.concatenate(x) for x in zip(self.bounds(tables, 0, start), self.bounds(tables, end, len(self.ids)), strict=True))
        for least, most in windows:
            open_ = (high >= least) & (low <= most)
            sure = low[open_ & (low >= least) & (high <= most)]
            if len(sure) >= k:
                open_ &= high >= np.partition(sure, -k)[-k]
            yield self._first(query, rows[open_], k, least, most)


def _meet(file: DataFrame, packs: DataFrame, blocks: int, longs: int, search: Callable, schema: str) -> DataFrame:
    """search(block, longs, matrix) -> columns, for each pack of anchors and each block of the file."""
    both = beside(file, packs.select("n", "data", F.lit(0).cast("long").alias("part")), blocks)
    names = [x.split()[0] for x in schema.split(", ")]

    def made(data: bytes, n: int) -> CellBlock:
        (ids, labels), values = unpacked(data, n, 2)
        return CellBlock(ids, labels, values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, _, asked, anchors in meetings(batches, made):
            for block in kept:
                found = search(block, *unpacked(anchors, asked, longs))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names)

    return both.mapInArrow(run, schema)


def _columns(rows: list[tuple]) -> list[np.ndarray]:
    """Of rows (number, ..., ids, scores): the numbers repeated for each id, then all ids, all scores."""
    sizes = [len(r[-1]) for r in rows]
    return [*(np.repeat([r[k] for r in rows], sizes) for k in range(len(rows[0]) - 2)), np.concatenate([r[-2] for r in rows]), np.concatenate([r[-1] for r in rows])]


def hard_negatives(
    vectors: DataFrame, *, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), every: int = 50, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score, for each row whose id is divisible by `every`.

    Scores are inner products of the vectors floor(scale * x). An anchor's positives are the best rows of its label and another id. The
    negatives of a positive are the best rows of other labels with window[0] % to window[1] % of its score, both included. Ties go to the
    smaller id. Rows with a null id, label or vector, or a null or non-finite component, take no part; components so large that a
    hundred times a score could pass a long fail the query. Vectors of different lengths compare as if filled with zeros. Each row of a
    repeated id is an anchor, a positive and a negative by itself, but not its own id's positive. Positives whose window holds no
    row, those with a score below zero among them, give no rows; no vectors give none. Other columns don't matter.
    """
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = width_of(vectors, vector)
    if width is None:
        return spark.createDataFrame([], result)
    width, least, most = max(1, width), *window
    plain = quantised(vectors.select(col(vec_id).alias("id"), col(label).alias("label"), col(vector).alias("v")), "id", "v", scale, "label").where("id IS NOT NULL AND label IS NOT NULL")
    limit = math.sqrt(2.0**62 / (100 * width))
    blocks = blocks_of(vectors.count(), width)
    # as many tasks as full blocks: small files would otherwise make small blocks, whose work is mostly calls
    file = packed(plain.repartition(blocks), ["id", "label"], width, limit)
    file = written(file.select("n", "data", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("part")), "cells")
    anchors = written(plain.where(F.col("id") % every == 0).select(F.monotonically_increasing_id().alias("no"), "id", "label", "q"), "anchors")
    packs = max(1, math.ceil(anchors.count() / PACK_ANCHORS))

    def alike(block: CellBlock, longs: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
        return _columns([(no, *block.positives(q, own, lab, positives)) for (no, own, lab), q in zip(longs.T, queries, strict=True)])

    near = _meet(file, packed(anchors.repartition(packs), ["no", "id", "label"], width, limit, PACK_ANCHORS), blocks, 3, alike, "no long, id long, score long")
    place = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "id"))
    first = near.withColumn("place", place).where(F.col("place") <= positives).where(f"score * {least} <= score * {most}")
    # at most `positives` a row: lists of a few
    lists = first.groupBy("no").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("p")).join(anchors.hint("merge"), "no")
    known = [f"{what}{k}" for what in ("id", "score") for k in range(positives)]
    lists = lists.select("no", "label", F.size("p").cast("long").alias("count"), *(F.coalesce(F.get("p", F.lit(k))[what], F.lit(0).cast("long")).alias(f"{what}{k}") for what in ("id", "score") for k in range(positives)), "q")

    def unlike(block: CellBlock, longs: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
        rows = []
        for (no, lab, count, *known), q in zip(longs.T, queries, strict=True):
            scores = [int(s) for s in known[positives : positives + count]]
            windows = [(-(-least * s // 100), most * s // 100) for s in scores]
            rows += [(no, k, known[k], scores[k], *found) for k, found in enumerate(block.negatives(q, lab, windows, negatives))]
        return _columns(rows)

    far = _meet(file, packed(lists.repartition(packs), ["no", "label", "count", *known], width, limit, PACK_ANCHORS), blocks, 3 + len(known), unlike, "no long, place long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("no", "place").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.join(anchors.select("no", F.col("id").alias("anchor_id")), "no").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
