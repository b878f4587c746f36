"""Exact k-means with grouped bounds.

The centroids are cut into groups once, by the nearest of a few spread ones. A vector keeps its cluster, an upper bound of the
distance to its centroid, and for each group a lower bound of the distance to the group's other centroids. When centroids have
moved, the bounds move by as much as they did; a vector whose upper bound stays under all its lower bounds is passed over whole,
else only the groups whose bound is reached are scanned, with exact distances in whole numbers. Bounds carry a margin for rounding,
and only what is surely farther is passed over, so clusters and ties are those of a full scan.

Vectors lie in blocks, each a row with its state and the sums of its clusters. A round reads the blocks of the last one and writes
them with new bounds; only k sums a block go on, and k centroids come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import col, delete, shared_path
from ledgerforge.llm.vectors import blocks_of, packed, quantised, unpacked

#: Factors by which bounds are widened for rounding.
UP, DOWN = 1 + 1e-9, 1 - 1e-9
STATE = "n long, data binary, cluster binary, upper binary, lower binary, distance binary, sums array<long>, scanned long"


def centroid_groups(centroids: np.ndarray, groups: int) -> np.ndarray:
    """The group of each centroid: that of the nearest of `groups` centroids, chosen one by one as the farthest from those before."""
    chosen = [0]
    far = squared(centroids, centroids[:1])[:, 0]
    while len(chosen) < min(groups, len(centroids)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(centroids, centroids[chosen[-1:]])[:, 0])
    return squared(centroids, centroids[chosen]).argmin(axis=1)


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, centroids)."""
    out = np.empty((len(rows), len(centroids)), np.int64)
    for c, centre in enumerate(centroids):
        apart = rows - centre
        out[:, c] = np.einsum("ij,ij->i", apart, apart)
    return out


class Bounds:
    """The state of a block: cluster, upper (one a row), lower (row, group)."""

    def __init__(self, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.cluster, self.upper, self.lower = cluster, upper, lower

    @classmethod
    def scanned(cls, values: np.ndarray, centroids: np.ndarray, group: np.ndarray) -> Bounds:
        """From all distances."""
        all_ = squared(values, centroids)
        cluster = all_.argmin(axis=1)
        upper = np.sqrt(all_[np.arange(len(values)), cluster]) * UP
        all_ = np.sqrt(all_) * DOWN
        all_[np.arange(len(values)), cluster] = np.inf
        return cls(cluster, upper, np.stack([all_[:, group == g].min(axis=1) for g in range(group.max() + 1)], axis=1))

    def moved(self, values: np.ndarray, centroids: np.ndarray, group: np.ndarray, drift: np.ndarray) -> int:
        """Takes the centroids, which have moved by drift at most; returns how many distances were evaluated."""
        self.upper = (self.upper + drift[self.cluster]) * UP
        # a bound below zero is none
        self.lower = np.maximum(self.lower - np.array([drift[group == g].max() for g in range(self.lower.shape[1])]), 0) * DOWN
        rows = np.flatnonzero(self.upper >= self.lower.min(axis=1))
        if not len(rows):
            return 0
        own = self.cluster[rows]
        apart = values[rows] - centroids[own]
        best = old = np.einsum("ij,ij->i", apart, apart)
        self.upper[rows] = np.sqrt(old) * UP
        count, left = len(rows), self.upper[rows] >= self.lower[rows].min(axis=1)
        rows, own, old, best = rows[left], own[left], old[left], best[left].copy()
        now, reached = own.copy(), self.upper[rows, None] >= self.lower[rows]
        scans = []
        for g in range(self.lower.shape[1]):
            at, members = np.flatnonzero(reached[:, g]), np.flatnonzero(group == g)
            if not len(at):
                continue
            all_ = squared(values[rows[at]], centroids[members])
            count += all_.size
            nearest = all_.argmin(axis=1)
            least, which = all_[np.arange(len(at)), nearest], members[nearest]
            better = (least < best[at]) | (least == best[at]) & (which < now[at])
            best[at[better]], now[at[better]] = least[better], which[better]
            scans.append((g, at, members, all_))
        for g, at, members, all_ in scans:
            others = np.where(members[None] == now[at, None], np.inf, np.sqrt(all_))
            self.lower[rows[at], g] = others.min(axis=1) * DOWN
        # the centroid left behind is one of its group's others now
        left_behind = np.flatnonzero((now != own) & ~reached[np.arange(len(rows)), group[own]])
        at, g = rows[left_behind], group[own[left_behind]]
        self.lower[at, g] = np.minimum(self.lower[at, g], np.sqrt(old[left_behind]) * DOWN)
        self.cluster[rows], self.upper[rows] = now, np.sqrt(best) * UP
        return count


def _assigned(blocks: DataFrame, centroids: np.ndarray, group: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """The blocks with every vector at its nearest centroid, and per block the count and the sums of each cluster."""
    k, dims = centroids.shape
    drift = None if before is None else np.sqrt([float(sum(int(x) ** 2 for x in row)) for row in centroids - before]) * UP

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, values = unpacked(row["data"], row["n"], 2)
                if drift is None:
                    state, scanned = Bounds.scanned(values, centroids, group), values.shape[0] * k
                else:
                    cluster, upper = np.frombuffer(row["cluster"], "<i4").astype(np.int64), np.frombuffer(row["upper"], "<f8")
                    state = Bounds(cluster, upper, np.frombuffer(row["lower"], "<f8").reshape(row["n"], -1).copy())
                    scanned = state.moved(values, centroids, group, drift)
                sums = np.zeros((k, dims + 1), np.int64)
                for c in range(k):
                    mine = state.cluster == c
                    sums[c, 0], sums[c, 1:] = mine.sum(), values[mine].sum(axis=0)
                out = {"n": row["n"], "data": row["data"], "cluster": state.cluster.astype("<i4").tobytes(), "upper": state.upper.tobytes(), "lower": state.lower.tobytes()}
                apart = values - centroids[state.cluster]
                out |= {"distance": np.einsum("ij,ij->i", apart, apart).tobytes(), "sums": sums.ravel().tolist(), "scanned": scanned}
                yield pa.RecordBatch.from_pylist([out], schema)

    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in STATE.split(", ")])
    return blocks.mapInArrow(assign, STATE)


def yinyang(vectors: DataFrame, *, k: int = 8, rounds: int = 10, groups: int = 3, seed: int = 3, dims: int = 64, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia and inertia (distances summed over the cluster, over all), centroid_sha256 (of the
    final centroid's components as text), for each vector of `dims` components, none null or non-finite; others are left out.

    Components are floor(scale * x). The first centroids are the k vectors with the smallest sha256 of '<seed>:<vec_id>'; of equal ids
    the smaller vectors, and rows without an id come last. Each round takes every vector to the nearest centroid (ties: the smaller
    number), then moves every centroid with vectors to their floored means; rounds in which nothing would move are not run. With fewer
    than k vectors there are as many centroids; without any, no rows. Repeated rows count each by itself. Components beyond 2^26 fail the
    query, as their squared distances could pass a double's whole numbers. Other columns don't matter.
    """
    spark = vectors.sparkSession
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    plain = quantised(vectors.where(F.size(col(vector)) == dims).select(col(vec_id).alias("id"), col(vector).alias("v")), "id", "v", scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = plain.orderBy(key.asc_nulls_last(), "q").limit(k).collect()
    if not first:
        return spark.createDataFrame([], result)
    centroids = np.array([r["q"] for r in first], np.int64)
    group = centroid_groups(centroids, groups)
    limit = min(2.0**26, (2.0**53 / (4 * dims)) ** 0.5)
    rows = plain.select(F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.col("id").isNull().cast("long").alias("none"), "q")
    blocks = packed(rows.repartition(blocks_of(vectors.count(), dims)), ["id", "none"], dims, limit)

    last, before = None, None
    for step in range(rounds + 1):
        path = shared_path(spark, "clusters")
        _assigned(blocks, centroids, group, before).write.option("compression", "zstd").parquet(path)
        if last:
            delete(spark, last)  # from here on the new blocks are all that is read
        blocks, last = spark.read.schema(STATE).parquet(path), path
        if step == rounds:
            break
        # only a block's sums are read, and summed where they lie first
        parts = blocks.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
        sums = np.zeros(len(centroids) * (dims + 1), np.int64)
        for r in parts:
            sums[r["at"]] = r["x"]
        sums = sums.reshape(len(centroids), -1)
        before, centroids = centroids, centroids.copy()
        held = sums[:, 0] > 0
        centroids[held] = sums[held, 1:] // sums[held, :1]
        if (before == centroids).all():
            break

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, data, cluster, distance in zip(*batch.columns, strict=True):
                (ids, none), _ = unpacked(data.as_py(), n.as_py(), 2)
                found = [pa.array(ids, mask=none > 0), pa.array(np.frombuffer(cluster.as_py(), "<i4")), pa.array(np.frombuffer(distance.as_py(), "<i8"))]
                yield pa.RecordBatch.from_arrays(found, ["vec_id", "cluster", "distance"])

    found = blocks.select("n", "data", "cluster", "distance").mapInArrow(unpack, "vec_id long, cluster int, distance long")
    inertia = {r["cluster"]: r["x"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("x")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of = spark.createDataFrame([(c, inertia.get(c, 0), sum(inertia.values()), d) for c, d in enumerate(digests)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
