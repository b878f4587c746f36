"""Connected components over edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.sources.shared import at_most, written

#: Up to so many edges (16 MB of numbers) one task finds the components; more go round by round through joins.
ONE_TASK_EDGES = 1_000_000


def least_labels(x: np.ndarray, y: np.ndarray, nodes: int) -> np.ndarray:
    """For each of so many nodes, known by number, the least that it reaches over the edges (x, y)."""
    label = np.arange(nodes)
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        # hook both ends' roots to the lower label, then shorten all ways
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["a"].dataType.simpleString()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            table = pa.Table.from_batches(parts)
            n = table.num_rows
            coded = pa.concat_arrays([*table["a"].chunks, *table["b"].chunks]).dictionary_encode()
            order = pc.sort_indices(coded.dictionary)  # texts by their bytes, as minima are
            nodes, rank = coded.dictionary.take(order), np.empty(len(order), np.int64)
            rank[order.to_numpy()] = np.arange(len(order))
            at = rank[coded.indices.to_numpy()]
            least = nodes.take(pa.array(least_labels(at[:n], at[n:], len(nodes))))
            for k in range(0, len(nodes), 10_000):
                yield pa.RecordBatch.from_arrays([nodes.slice(k, 10_000), least.slice(k, 10_000)], ["id", "comp"])

    return written(edges.select("a", "b").repartition(1).mapInArrow(solve, f"id {kind}, comp {kind}"), "components")


def connected_components(edges: DataFrame, *, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(id, comp): the least node that each node of the edges (a, b) reaches.

    Beyond `one_task_edges` by alternating stars: each node's neighbours are joined to the least of them, larger ones first, then
    smaller ones. Edges never grow in number, and about log(n) written rounds suffice; only minima are aggregated, so hubs don't
    matter. Both ways give the same rows.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if at_most(edges, one_task_edges):
        return _in_one_task(edges)
    state = None
    while True:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tops = sides.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("top"))
        upper = sides.join(tops, "a").where("b > a AND b <> top").select(F.col("b").alias("a"), F.col("top").alias("b"))
        # a local minimum keeps its own edges: they are those to the top itself
        upper = upper.unionByName(sides.join(tops, "a").where("b > a AND top = a").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        upper = upper.unionByName(tops.where("top <> a").select("a", F.col("top").alias("b"))).distinct()
        tops = upper.groupBy("a").agg(F.min("b").alias("top"))
        lower = upper.join(tops, "a").where("b <> top").select(F.greatest("b", "top").alias("a"), F.least("b", "top").alias("b"))
        edges = written(lower.unionByName(tops.select("a", F.col("top").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == state:
            roots = edges.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("id"), "comp")
            return roots.unionByName(roots.select(F.col("comp").alias("id"), "comp").distinct())
        state = now
