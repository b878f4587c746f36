"""A ledger that a stream feeds: batches are written as they come, and merged when they are read.

Keys belong to buckets by their hash. A batch writes its own rows, by bucket, and nothing else, so what it costs doesn't grow with the
ledger. Reading merges a bucket's base with what batches have added. A compaction rewrites the buckets that were touched since the last
one, then points to the new versions; old ones stay until the compaction after that, for those who still read them.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources import files


class BucketedLedger:
    """columns: a schema with key, first_seen and last_seen. `apply` is a foreachBatch function."""

    def __init__(self, spark: SparkSession, path: str, columns: str, *, buckets: int = 64):
        self.spark, self.path, self.buckets, self.columns = spark, path.rstrip("/"), buckets, columns
        self.names = spark.createDataFrame([], columns).columns

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _state(self) -> dict:
        """versions: of each bucket's base; through, more: the batches folded into them; retired: folders to go at the next compaction."""
        return json.loads(files.read_text(self.spark, f"{self.path}/CURRENT") or '{"versions": {}, "through": -1, "more": [], "retired": []}')

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row a key: the first and last date of any, the rest of the row last seen (of equal dates the largest), in whatever order they came."""
        rest = [c for c in self.names if c not in ("key", "first_seen", "last_seen")]
        out = rows.groupBy("key").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max(F.struct("last_seen", *rest)).alias("x"))
        return out.select(*(F.col(f"x.{c}").alias(c) if c in rest else F.col(c) for c in self.names))

    def _folded(self, state: dict, batch_id: int) -> bool:
        return batch_id <= state["through"] or batch_id in state["more"]

    def _open(self, state: dict) -> list[int]:
        """Batches that were written whole and aren't folded yet."""
        ids = [int(n) for n in files.children(self.spark, f"{self.path}/batches") if n.isdigit() and not self._folded(state, int(n))]
        return [i for i in ids if files.exists(self.spark, f"{self.path}/batches/{i}/_SUCCESS")]

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a batch. One that runs again replaces itself, and one that was folded already is passed over."""
        if self._folded(self._state(), batch_id):
            return
        rows = self._merged(batch).withColumn("b", self._bucket(F.col("key")))
        rows.repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/batches/{batch_id}")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The ledger, or of it these buckets alone."""
        state = self._state()
        parts = []
        by: dict[int, list[str]] = {}
        for b, v in state["versions"].items():
            if buckets is None or int(b) in buckets:
                by.setdefault(v, []).append(f"{self.path}/base/{v}/b={b}")
        for paths in by.values():
            parts.append(self.spark.read.schema(self.columns).parquet(*paths))
        for i in self._open(state):
            held = [n for n in files.children(self.spark, f"{self.path}/batches/{i}") if n.startswith("b=") and (buckets is None or int(n[2:]) in buckets)]
            if held:
                parts.append(self.spark.read.schema(self.columns).parquet(*(f"{self.path}/batches/{i}/{n}" for n in held)))
        return self._merged(reduce(DataFrame.unionByName, parts)) if parts else self.spark.createDataFrame([], self.columns)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of keys (key); only their buckets are read."""
        wanted = [r["b"] for r in keys.select(self._bucket(F.col("key")).alias("b")).distinct().collect()]  # at most as many as there are buckets
        return self.read(wanted).join(keys.select("key").distinct(), "key", "left_semi")

    def compact(self) -> None:
        """Folds the batches so far into new versions of the buckets that they touch."""
        state = self._state()
        ids = self._open(state)
        if not ids:
            return
        touched = sorted({int(n[2:]) for i in ids for n in files.children(self.spark, f"{self.path}/batches/{i}") if n.startswith("b=")})
        version = max(state["versions"].values(), default=0) + 1
        files.delete(self.spark, f"{self.path}/base/{version}")  # of a compaction that died
        if touched:
            self.read(touched).withColumn("b", self._bucket(F.col("key"))).repartition("b").write.partitionBy("b").parquet(f"{self.path}/base/{version}")
        retired = [f"base/{v}/b={b}" for b, v in state["versions"].items() if int(b) in touched]
        through, more = state["through"], {*state["more"], *ids}
        while through + 1 in more:
            through += 1
            more.discard(through)
        versions = {**state["versions"], **{str(b): version for b in touched}}
        new = {"versions": versions, "through": through, "more": sorted(more), "retired": retired}
        files.write_text(self.spark, f"{self.path}/CURRENT", json.dumps(new))
        for gone in [*state["retired"], *(f"batches/{i}" for i in ids)]:
            files.delete(self.spark, f"{self.path}/{gone}")
