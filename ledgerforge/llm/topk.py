"""Exact top-k by inner product over a bit-sliced index.

The index holds blocks of vectors. In a block, slice (d, b) is the bitmap of the rows whose quantised attribute d has bit b. A
query adds the slices of the attributes its own bits name, with carries, for all rows of the block at once; sums of four
attributes each are prepared, one for each subset, so that a query looks up sixteen of them a bit instead of sixty-four. The best
rows are then found from the sum's most significant slice downward; where a tie goes over the edge, the smaller ids are taken.

Queries meet the index in blocks: packs of queries are sent to every index block, and lie behind it in one sorted partition, so no join has a side to broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm.common import written
from ledgerforge.llm.vectors import beside, meetings

BLOCK_ROWS, PACK_QUERIES, GROUP, BATCH = 8192, 1024, 4, 64
SIGN = np.uint64(1)


def _bits(values: np.ndarray, count: int) -> np.ndarray:
    """Bitmaps (count, ..., words) of the lowest bits of values (..., rows), 64 rows a word."""
    words = -(-values.shape[-1] // 64)
    out = np.zeros((count, *values.shape[:-1], words * 8), np.uint8)
    for b in range(count):
        packed = np.packbits(((values >> b) & 1).astype(np.uint8), axis=-1, bitorder="little")
        out[b, ..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


def _add(total: list[np.ndarray], other: list[np.ndarray], shift: int = 0) -> None:
    """total += other << shift, both lists of bitmaps from the lowest slice up; total grows by the last carry."""
    carry = None
    k = shift
    for part in other:
        while len(total) <= k:
            total.append(np.zeros_like(part))
        x = total[k]
        half = x ^ part
        if carry is None:
            total[k], carry = half, x & part
        else:
            total[k], carry = half ^ carry, (x & part) | (half & carry)
        k += 1
    while carry is not None and carry.any():
        if k == len(total):
            total.append(carry)
            return
        total[k], carry = total[k] ^ carry, total[k] & carry
        k += 1


class Block:
    """An index block: rows by id, and for each four attributes the bit-sliced sums of their subsets."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        rows, dims = self.values.shape
        self.low = int(self.values.min())
        shifted = (self.values - self.low).T
        self.words = -(-rows // 64)
        self.groups = []
        for g in range(0, dims, GROUP):
            part = shifted[g : g + GROUP]
            subsets = np.stack([part[[d for d in range(len(part)) if m >> d & 1]].sum(axis=0) for m in range(1 << len(part))])
            self.groups.append(_bits(subsets, max(1, int(subsets.max()).bit_length())))
        alive = np.zeros(self.words * 64, np.uint8)
        alive[:rows] = 1
        self.alive = np.packbits(alive, bitorder="little").view(np.uint64)

    def best(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its id, the ids of its k best rows here (ties: smaller ids), and their scores."""
        low = int(queries.min())
        bits = max(1, int((queries - low).max()).bit_length())
        total: list[np.ndarray] = []
        digits = queries - low  # >= 0: the part of the score that depends on the row is then sum(digit * shifted) + low * sum(shifted)
        base = self._plain_sum() if low else None
        for j in range(bits):
            one: list[np.ndarray] = []
            for g, table in enumerate(self.groups):
                d = digits[:, g * GROUP : (g + 1) * GROUP] >> j & 1
                mask = (d << np.arange(d.shape[1])).sum(axis=1)
                _add(one, [table[b][mask] for b in range(len(table))])
            _add(total, one, j)
        if base is not None:
            # + low * sum: low is negative or positive; in two's complement, over enough slices for any sum
            most = int(digits.sum(axis=1).max()) * int((self.values - self.low).max()) + abs(low) * int((self.values - self.low).sum(axis=1).max())
            width = most.bit_length() + 2
            offset = (low * base) & ((1 << width) - 1)
            part = _bits(offset, width)
            while len(total) < width:
                total.append(np.zeros_like(total[0]))
            _add(total, [np.broadcast_to(s, total[0].shape) for s in part])
            total = total[:width]
            total[-1] = ~total[-1]  # the sign's slice, turned so that larger is better in every slice
        chosen, edge = self._select(total, query_ids, k)
        for q in range(len(queries)):
            sure, open_ = (np.flatnonzero(np.unpackbits(x[q].view(np.uint8), bitorder="little")) for x in (chosen, edge))
            rows = np.concatenate([sure, open_[: max(0, k - len(sure))]])
            yield query_ids[q], self.ids[rows], self.values[rows] @ queries[q]

    def _plain_sum(self) -> np.ndarray:
        return (self.values - self.low).sum(axis=1)

    def _select(self, total: list[np.ndarray], query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows surely among the k best, and those tied at the edge; from the most significant slice downward."""
        open_ = np.repeat(self.alive[None], len(query_ids), axis=0)
        first, last = np.searchsorted(self.ids, query_ids), np.searchsorted(self.ids, query_ids, "right")
        for q in np.flatnonzero(first < last):
            for r in range(first[q], last[q]):
                open_[q, r >> 6] &= ~(SIGN << np.uint64(r & 63))
        chosen = np.zeros_like(open_)
        for s in reversed(total):
            with_bit = open_ & s
            count = np.bitwise_count(chosen | with_bit).sum(axis=1)
            over, under = (count > k)[:, None], (count <= k)[:, None]
            chosen = np.where(under, chosen | with_bit, chosen)
            open_ = np.where(over, with_bit, open_ & ~s)
        return chosen, open_


def quantised(vector: list, scale: int) -> np.ndarray | None:
    """floor(scale * x) of each component; None for a null vector or one with a null or non-finite component."""
    if vector is None or any(x is None for x in vector):
        return None
    x = np.array(vector, np.float64)
    if not np.isfinite(x).all():
        return None
    out = np.floor(x * scale)
    if len(out) * max(1.0, np.abs(out).max(initial=0)) ** 2 >= 2.0**62:
        raise ValueError(f"a component of {np.abs(x).max()} makes scores that no long can hold")
    return out.astype(np.int64)


def _unpack(data: bytes, rows: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(data, "<i8", rows)
    return ids, np.frombuffer(data, "<i8", offset=8 * rows).reshape(rows, -1)


def packed(vectors: DataFrame, vec_id: str, vector: str, scale: int, rows: int, width: int, keep=None) -> DataFrame:
    """(n, data): up to `rows` ids and quantised vectors of one task, shorter vectors filled with zeros to `width`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        values: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            matrix = np.zeros((len(ids), width), "<i8")
            for k, v in enumerate(values):
                matrix[k, : len(v)] = v
            row = pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), pa.array([np.array(ids, "<i8").tobytes() + matrix.tobytes()])], ["n", "data"])
            ids.clear()
            values.clear()
            return row

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is not None and (keep is None or keep(i)) and (q := quantised(v, scale)) is not None:
                    ids.append(i)
                    values.append(q)
                    if len(ids) == rows:
                        yield out()
        if ids:
            yield out()

    return vectors.select(F.col(vec_id).cast("long").alias("i"), F.col(vector).alias("v")).mapInArrow(pack, "n long, data binary")


def top_k(vectors: DataFrame, *, k: int = 20, every: int = 20, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each row whose id is divisible by `every`, against all other rows.

    The score is the inner product of the vectors floor(scale * x); a vector whose product with one like it could pass a long fails the
    query. Ties go to the smaller id. Rows with a null id, a null vector, or a null or non-finite component take no part. Vectors of different
    lengths compare as if filled with zeros. Rows that share an id are left out of their own query together; each of them is ranked by
    itself, if that id is a query's. Other columns of vectors don't matter, and no rows give none.
    """
    width = vectors.agg(F.max(F.size(vector))).first()[0]
    if width is None or width < 1:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = vectors.count()
    # as many tasks as full blocks: small files would otherwise make small blocks, whose work is mostly calls
    blocks = max(1, math.ceil(rows / BLOCK_ROWS))
    index = written(packed(vectors.repartition(blocks), vec_id, vector, scale, 2 * BLOCK_ROWS, width).withColumns({"block": F.spark_partition_id().cast("long"), "part": F.monotonically_increasing_id()}), "index")
    few = vectors.where(F.col(vec_id) % every == 0)
    packs = packed(few.repartition(max(1, math.ceil(rows / every / PACK_QUERIES))), vec_id, vector, scale, PACK_QUERIES, width).withColumnRenamed("data", "queries").withColumnRenamed("n", "asked")
    packs = written(packs.withColumn("pack", F.monotonically_increasing_id()), "packs")
    both = beside(index.select("block", "part", "n", "data"), packs.select(F.col("asked").alias("n"), F.col("queries").alias("data"), F.col("pack").alias("part")), blocks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, pack, asked, queries in meetings(batches, lambda data, n: Block(*_unpack(data, n))):
            ids, values = _unpack(queries, asked)
            for block in kept:  # a task may have filled more than one block
                for a in range(0, len(ids), BATCH):
                    found = list(block.best(values[a : a + BATCH], ids[a : a + BATCH], k))
                    sizes = [len(f[1]) for f in found]
                    columns = (np.full(sum(sizes), pack), np.repeat(np.arange(a, a + len(found)), sizes), np.repeat([f[0] for f in found], sizes), np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found]))
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["pack", "place", "query_id", "vec_id", "score"])

    near = both.mapInArrow(search, "pack long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("pack", "place").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
