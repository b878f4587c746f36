"""MinHash near-duplicates by an LSH forest, with links confirmed on full shingle sets.

Every document gets one signature per tree: a row of minhashes. A tree is the order of all documents by that row; the longer the
prefix that two neighbours share, the likelier they are alike. Three passes find the links:

1. Neighbours in the orders, which have the longest common prefixes, are candidates; those whose whole signatures agree well chain
   documents to clusters.
2. Documents with the same first `MIN_DEPTH` values form a region; a region with many pairs that aren't joined yet is read a value
   deeper, up to the whole row. In a region all such pairs are compared by their signatures.
3. Documents of regions with many such pairs even at the whole row (texts that share a passage, say) are compared in an exact way:
   two sets that are similar enough have a shingle in common among the rarest of each, as many as they may differ in and one more.

Nothing is linked but by full sets: all pairs of a cluster, and then of a chain of such candidates, are compared in blocks, first every
block with itself and the first one, then what is still apart from the main component with all blocks. So no pair becomes a row.

Texts are read once for signatures and once for the sets of candidates; only sets, signatures and ids move. Copies (equal sets)
are one class from the start. Sorted orders are range-partitioned with the id as the last key, so a region of any size spreads
over tasks, and a block's size is bounded whatever the cluster's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import at_most, semi, written
from ledgerforge.operators.components import connected_components

TREES, MIN_DEPTH, DEPTH = 24, 4, 5
#: A region with more pairs than this is read one value deeper; at the whole row its documents are compared by rare shingles.
REGION_PAIRS = 20_000
#: Shingles of dense regions' documents that are sorted by how often they come (16 bytes each); all rarer ones come before them.
FREQUENT = 500_000
#: Texts with copies that may be broadcast (24 bytes each).
COPIES_BROADCAST = 250_000
#: Documents in a block of a cluster, and shingles of them (16 MB), about: whichever is reached first.
BLOCK, BLOCK_SHINGLES = 400, 2_000_000
#: Least share of equal minhashes with which neighbours are of one cluster, and with which a pair's sets are compared; at a similarity
#: of 0.8 the deviation is 0.037.
CLUSTER_ESTIMATE, LEAST_ESTIMATE = 0.74, 0.62


def shingle_hashes(text: str, size: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of the whole sequence if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # lower() of bytes is A-Z only
    if not words:
        return np.empty(0, np.uint64)
    if len(cache) > 1_000_000:
        cache.clear()
    ids = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        ids.append(h)
    ids = np.array(ids, np.uint64)
    size = min(size, len(ids))
    out = ids[: len(ids) - size + 1].copy()
    for k in range(1, size):
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += ids[k : len(ids) - size + 1 + k]
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    return np.unique(out)


def minhashes(hashes: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> np.ndarray:
    """The least of each multiply-add hash, its upper 32 bits, in slices that stay in the processor's cache."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 512):
        part = np.multiply.outer(factors, hashes[a : a + 512])
        part += addends[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(">u4")


def signatures(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null without shingles), sig (big-endian, so that bytes sort as numbers do)."""
    count = TREES * DEPTH
    schema = "doc_id long, n_shingles long, digest binary, sig binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(20_001)
        factors = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        addends = draw.integers(0, 1 << 63, count, dtype=np.uint64)
        cache: dict[bytes, int] = {}
        for batch in batches:
            sizes, digests, sigs = [], [], []
            for x in batch.column(1):
                hashes = shingle_hashes(x.as_py() or "", shingle, cache)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                sigs.append(minhashes(hashes, factors, addends).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(sign, schema)


def shingle_sets(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """id, digest, set of each row of docs."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            hashes = [shingle_hashes(x.as_py() or "", shingle, cache) for x in batch.column(1)]
            digests, sets = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in hashes], pa.binary()), pa.array([x.view(np.int64) for x in hashes], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), digests, sets], ["id", "digest", "set"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(build, "id long, digest binary, set array<long>")


def forest_members(classes: DataFrame) -> DataFrame:
    """tree, id, n, key (the row's bytes) for documents in regions of two or more, and prev: the one before in the order, if it is of the
    same region.

    The first and last row of a partition are always there, since what lies beyond isn't seen.
    """
    width = 4 * DEPTH
    rows = classes.select("id", "n", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    rows = rows.select("tree", F.col("sig").substr(F.col("tree") * width + 1, F.lit(width)).alias("key"), "id", "n")
    rows = rows.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, met, back = None, True, None  # the last row seen, held back until its neighbour is known; whether it belongs to a region; its own neighbour
        for batch in batches:
            if not batch.num_rows:
                continue
            if before is not None:
                batch = pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            tree, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(n, DEPTH)[:, :MIN_DEPTH]
            near = (keys[1:] == keys[:-1]).all(axis=1) & (tree[1:] == tree[:-1])
            keep = np.zeros(n, bool)
            keep[:-1] |= near
            keep[1:] |= near
            keep[0] |= met
            met = bool(keep[-1]) and n > 1 or n == 1 and met
            prev = pa.array(np.concatenate([[0 if back is None else back], ids[:-1]]), pa.int64(), mask=np.concatenate([[back is None], ~near]))
            yield pa.RecordBatch.from_arrays([*batch.slice(0, n - 1).columns, prev.slice(0, n - 1)], MEMBER_NAMES).filter(pa.array(keep[: n - 1]))
            before, back = batch.slice(n - 1), prev[n - 1].as_py()
        if before is not None:
            yield pa.RecordBatch.from_arrays([*before.columns, pa.array([back], pa.int64())], MEMBER_NAMES)

    return rows.mapInArrow(walk, MEMBER)


MEMBER = "tree int, key binary, id long, n long, prev long"
MEMBER_NAMES = [x.split()[0] for x in MEMBER.split(", ")]


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The share of equal minhashes, from their lowest bytes, of which one in 256 is equal by chance."""
    return ((x == y).mean(axis=-1) - 1 / 256) * (256 / 255)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def agreeing(pairs: DataFrame, shorts: DataFrame, least: float) -> DataFrame:
    """Distinct pairs (a, b) whose signatures (shorts: id, short) agree on at least this share."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = np.flatnonzero(agreement(matrix(batch.column(2)), matrix(batch.column(3))) >= least)
                yield batch.select([0, 1]).take(pa.array(good))

    both = pairs.select("a", "b").distinct().join(shorts.toDF("a", "sa"), "a").join(shorts.toDF("b", "sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(alike, "a long, b long")


def region_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join what a region (rows: region, id, n, comp, short) has of different components whose sizes and signatures
    allow a link: a document with all its candidates.

    A region has few pairs, if perhaps many rows of one component; those are compared with the others only.
    """
    sorted_ = rows.select("region", "id", "n", "comp", "short").repartition("region").sortWithinPartitions("region")

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        region, ids, n, comp = (table[c].to_numpy() for c in ("region", "ids", "n", "comp"))
        sig = matrix(table["short"].combine_chunks() if isinstance(table["short"], pa.ChunkedArray) else table["short"])
        ends = np.flatnonzero(np.concatenate([region[1:] != region[:-1], [True]])) + 1
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            values, counts = np.unique(comp[a:b], return_counts=True)
            main = values[counts.argmax()]
            for i in a + np.flatnonzero(comp[a:b] != main):
                lo, hi = np.minimum(n[a:b], n[i]), np.maximum(n[a:b], n[i])
                j = a + np.flatnonzero((comp[a:b] != comp[i]) & (100 * lo >= percent * hi))
                j = j[agreement(sig[j], sig[i]) >= LEAST_ESTIMATE] if len(j) else j
                found.append((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]), pa.int64()) for k in (0, 1)], ["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.rename_columns(["region", "ids", "n", "comp", "short"])
            region = batch.column(0).to_numpy()
            last = int(np.searchsorted(region, region[-1]))  # where the last region begins: it may go on
            if last:
                yield from compare(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif held and held[-1].column(0)[0].as_py() != region[0]:
                yield from compare(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from compare(pa.Table.from_batches(held))

    return sorted_.mapInArrow(walk, "a long, b long")


def block_links(sets: list[np.ndarray], comps: np.ndarray, few: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (positions) that join components: pairs with an end in `few`, similar enough, not yet in one component.

    Pairs that are joined through others already are passed over, so a block of near copies costs little more than its size.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[k]) for k in order])
    flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    root, few = comps[order].copy(), few[order]
    mark, out = np.zeros(int(flat.max()) + 1, bool), []
    for i in np.flatnonzero(few):
        first = np.searchsorted(sizes, -(-sizes[i] * percent // 100))
        last = np.searchsorted(sizes, sizes[i] * 100 // percent, "right")
        apart = root[first:last] != root[i]
        if not apart.any():
            continue
        own = flat[starts[i] : starts[i + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[flat[starts[first] : starts[last]]], starts[first:last] - starts[first], dtype=np.int64)
        mark[own] = False
        alike = 100 * shared >= percent * (sizes[first:last] + sizes[i] - shared)
        for j in first + np.flatnonzero(apart & alike):
            if root[j] != root[i]:
                out.append((int(order[i]), int(order[j])))
                root[root == root[j]] = root[i]
    return out


class Forest:
    """The search over one table of documents."""

    def __init__(self, docs: DataFrame, *, doc_id: str, text: str, shingle: int, percent: int):
        self.source, self.doc_id, self.text, self.shingle, self.percent = docs, doc_id, text, shingle, percent
        self.docs = written(signatures(docs, doc_id, text, shingle), "signatures")
        with_set = self.docs.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        copies = with_set.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("k"))
        self.copies = written(copies.where("k > 1").select("digest", "id"), "copies")
        classes = with_set.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        self.classes = written(classes, "classes")
        self.repeated = with_set.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
        if self.repeated:  # of several texts of one id alone, one counts
            self.classes = written(self.classes.groupBy("id").agg(F.min_by(F.struct("digest", "n", "sig"), "digest").alias("x")).select("id", "x.*"), "classes")
        self.members = written(forest_members(self.classes), "members")
        # the lowest byte of each minhash is enough to tell how well two signatures agree
        lowest = lambda sig: F.unhex(F.regexp_replace(F.hex(sig), "[0-9A-F]{6}([0-9A-F]{2})", "$1"))
        met = written(self.members.select("id").distinct(), "met")
        self.shorts = written(semi(self.classes, met, "id").select("id", lowest(F.col("sig")).alias("short")), "shorts")

    def sets(self, ids: DataFrame) -> DataFrame:
        """id, set of the classes whose id is among ids' only column."""
        found = shingle_sets(semi(self.source, ids, self.doc_id), self.doc_id, self.text, self.shingle)
        if self.repeated:
            found = found.join(self.classes.select("id", "digest"), ["id", "digest"])
        return found.select("id", "set").dropDuplicates(["id"])

    def clusters(self) -> DataFrame:
        """id, cluster: documents chained by neighbours whose signatures agree; those of one only are left out."""
        near = self.members.where("prev IS NOT NULL").select(F.least("id", "prev").alias("a"), F.greatest("id", "prev").alias("b"))
        return written(connected_components(agreeing(near, self.shorts, CLUSTER_ESTIMATE)).withColumnRenamed("comp", "cluster"), "clusters")

    def components(self) -> DataFrame:
        """(id, comp) of every class that isn't alone."""
        comps = self.compared(self.clusters(), None)
        chains = connected_components(self._apart(comps)).withColumnRenamed("comp", "cluster")
        return self.compared(written(chains, "chains"), comps) if chains.limit(1).count() else comps

    def compared(self, clusters: DataFrame, comps: DataFrame | None) -> DataFrame:
        """comps (id, comp), joined further by all links between documents of a cluster (id, cluster)."""
        blocks = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")
        weighed = clusters.join(self.classes.select("id", "n"), "id")
        sizes = weighed.groupBy("cluster").agg(blocks(F.count("*"), F.sum("n")).alias("blocks"))
        placed = weighed.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        placed = written(placed.join(self.sets(clusters.select("id")), "id"), "sets")
        of = lambda rows, known: (rows.join(known, "id", "left") if known is not None else rows.withColumn("comp", F.col("id"))).withColumn("comp", F.coalesce("comp", "id"))
        # every block with itself and with the first
        where = F.when(F.col("block") > 0, F.array("block")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
        comps = self._merged(comps, self._in_blocks(of(placed, comps).select("cluster", F.explode(where).alias("at"), F.lit(0).alias("by"), "id", "comp", F.lit(True).alias("few"), "set")))
        # what is still apart, in large clusters, with every block
        large = of(placed.where("blocks > 1"), comps)
        parts = large.groupBy("cluster", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("s")).groupBy("cluster").agg(F.max(F.struct("k", "comp", "s")).alias("x"), F.sum("k").alias("all"), F.sum("s").alias("shingles"))
        parts = parts.where(F.col("all") > F.col("x.k")).select("cluster", F.col("x.comp").alias("main"), blocks(F.col("all") - F.col("x.k"), F.col("shingles") - F.col("x.s")).alias("rows"))
        left = written(large.join(parts, "cluster"), "apart")
        if not left.limit(1).count():
            return comps
        few = left.where(F.col("comp") != F.col("main")).withColumn("by", F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")).cast("int"))
        few = few.select("cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), "by", "id", "comp", F.lit(True).alias("few"), "set")
        rest = left.select("cluster", F.col("block").alias("at"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("by"), "id", "comp", F.lit(False).alias("few"), "set")
        return self._merged(comps, self._in_blocks(few.unionByName(rest)))

    def _in_blocks(self, rows: DataFrame) -> DataFrame:
        """Confirmed links between components, of the documents in each (cluster, at, by)."""
        percent = self.percent

        def compare(table: pa.Table) -> pa.Table:
            ids, comps, few = (table[c].to_numpy() for c in ("id", "comp", "few"))
            found = []
            if len(ids) > 1:
                column = table["set"].combine_chunks()
                flat, at = column.values.to_numpy(), column.offsets.to_numpy()
                found = block_links([flat[a:b] for a, b in zip(at, at[1:], strict=False)], comps, few, percent)
            return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

        return written(rows.groupBy("cluster", "at", "by").applyInArrow(compare, "a long, b long"), "links")

    @staticmethod
    def _labelled(pairs: DataFrame, comps: DataFrame) -> DataFrame:
        for side in "ab":
            label = comps.select(F.col("id").alias(side), F.col("comp").alias("__c"))
            pairs = pairs.join(label, side, "left").withColumn(f"c{side}", F.coalesce("__c", side)).drop("__c")
        return pairs

    def _merged(self, comps: DataFrame | None, links: DataFrame) -> DataFrame:
        """comps, joined further by links (a, b) of documents."""
        if comps is None:
            return connected_components(links)
        if not links.limit(1).count():
            return comps
        more = connected_components(self._labelled(links, comps).select(F.col("ca").alias("a"), F.col("cb").alias("b"))).toDF("__m", "__to")
        old = comps.join(more, comps["comp"] == more["__m"], "left").select("id", F.coalesce("__to", "comp").alias("comp"))
        new = more.join(comps, comps["id"] == more["__m"], "left_anti").select(F.col("__m").alias("id"), F.col("__to").alias("comp"))
        return written(old.unionByName(new), "components")

    def _apart(self, comps: DataFrame) -> DataFrame:
        """Links (a, b) that chain documents of different components which may be similar enough."""
        rows = self.members.select("tree", "key", "id", "n").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        sparse, deep = None, written(rows, "labelled")
        for depth in range(MIN_DEPTH, DEPTH + 1):
            keyed = deep.withColumn("region", F.xxhash64("tree", F.substring("key", 1, 4 * depth)))
            parts = keyed.groupBy("region", "comp").agg(F.count("*").alias("k"))
            regions = parts.groupBy("region").agg(F.sum("k").alias("size"), F.max("k").alias("most"))
            # all pairs between components have an end outside the region's largest one
            pairs = F.col("size") * (F.col("size") - F.col("most"))
            regions = written(regions.where(pairs > 0).select("region", (pairs > REGION_PAIRS).alias("dense")), "regions")
            here = keyed.join(regions.where("NOT dense"), "region").select("region", "id", "n", "comp")
            sparse = here if sparse is None else sparse.unionByName(here)
            deep = written(keyed.join(regions.where("dense"), "region", "left_semi").drop("region"), "deeper")
            if not deep.limit(1).count():
                break
        found = region_pairs(sparse.join(self.shorts, "id"), self.percent)
        dense = written(deep.select("id", "comp").distinct(), "dense")
        return found.unionByName(self._by_rare_shingles(dense)) if dense.limit(1).count() else found

    def _by_rare_shingles(self, dense: DataFrame) -> DataFrame:
        """Links (a, b) that chain documents (id, comp) of different components which may be similar enough, none left out.

        Sets that are similar enough differ in at most (100 - percent) % of either; so of that many and one more of a set's shingles, the
        other set has one, and if all sets are sorted alike, in whatever order, they meet among both sets' first. With frequent shingles
        last, few others do.
        """
        sets = written(self.sets(dense.select("id")).join(dense, "id"), "dense_sets")
        total = sets.agg(F.sum(F.size("set"))).first()[0] or 0

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """How often shingles come in a batch of documents; what no batch has twice is rare."""
            for batch in batches:
                values, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values[n > 1], pa.int64()), pa.array(n[n > 1], pa.int64())], ["shingle", "n"])

        often = sets.select("set").mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("count"))
        often = often.where(F.col("count") > max(10, total // FREQUENT)).toArrow().sort_by([("count", "ascending"), ("shingle", "ascending")])["shingle"].to_numpy()
        by_value, percent = np.argsort(often, kind="stable"), self.percent

        def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values = often[by_value]
            for batch in batches:
                out: list[np.ndarray] = []
                for row in batch.column(1):
                    x = row.values.to_numpy()
                    rank = np.zeros(len(x), np.int64)
                    if len(values):
                        at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                        rank = np.where(values[at] == x, 1 + by_value[at], 0)
                    out.append(x[np.lexsort((x, rank))[: len(x) - -(-percent * len(x) // 100) + 1]])
                n = [len(x) for x in out]
                columns = (np.repeat(batch.column(k).to_numpy(), n) for k in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*out, np.empty(0, np.int64)])), *map(pa.array, columns)], ["shingle", "id", "comp"])

        first = written(sets.select("id", "set", "comp").mapInArrow(rarest, "shingle long, id long, comp long"), "rarest")
        mixed = first.groupBy("shingle").agg(F.min("id").alias("b"), F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most").select("shingle", "b")
        return first.join(mixed, "shingle").select(F.col("id").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest id reachable over links), kept (doc_id = component_id).

    Words are runs of characters other than ASCII white space, A-Z lowered. Sets of distinct shingles are linked where
    100 * intersection >= percent * union, confirmed on the full sets of 64-bit shingle hashes. Null or empty texts have no
    shingles and no links. A null id has a null component and is kept. Rows that repeat an id get the component of their own text, if
    another id has that text too; of several texts that this id alone has, that of the least digest counts for all.
    Other columns of docs don't matter. Two texts at exactly 0.8 share the first four values in none of the 24 trees with a
    probability of 3e-6, the whole row, where regions are dense, with one of 7e-5, and seem less than 0.62 alike with one of 1e-6.
    """
    forest = Forest(docs, doc_id=doc_id, text=text, shingle=shingle, percent=percent)
    comps = forest.components()
    # most texts have no copy: those that have return by a broadcast while they are few, so that a text of many copies isn't one task's
    copies = F.broadcast(forest.copies) if at_most(forest.copies, COPIES_BROADCAST) else forest.copies
    out = forest.docs.select("doc_id", "n_shingles", "digest").join(copies, "digest", "left").withColumn("id", F.coalesce("id", "doc_id"))
    out = out.join(comps, "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "id", "doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
