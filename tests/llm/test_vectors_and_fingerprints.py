"""Hard negatives, clusters and fingerprints against brute force, on planted and odd rows."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerforge.llm import clustering, simhash
from ledgerforge.llm.clustering import Bounds, centroid_groups, squared, yinyang
from ledgerforge.llm.hard_negatives import CellBlock, hard_negatives
from ledgerforge.llm.simhash import bucket_links, deeper, fingerprint, fingerprint_links, simhash_duplicates

VECTORS = "vec_id long, embedding array<float>, label int, q string, block int"
DOCS = "doc_id long, text string, fp string, first int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)


# hard negatives


def mined_by_brute_force(rows, every=50, scale=256):
    good = [(i, np.floor(np.array(v, np.float64) * scale).astype(np.int64), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width, out = max((len(v) for _, v, _ in good), default=0), []
    good = [(i, np.concatenate([v, np.zeros(width - len(v), np.int64)]), lab) for i, v, lab in good]
    for i, q, lab in good:
        if i % every == 0:
            scored = sorted((-int(v @ q), j, other) for j, v, other in good)
            for p, j, _ in [x for x in scored if x[2] == lab and x[1] != i][:5]:
                inside = [x for x in scored if x[2] != lab and 50 * -p <= 100 * -x[0] <= 95 * -p]
                out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def drawn(seed, n, dims=8, labels=3, hot=0.4):
    """Vectors around few centres, a share of them copies of one."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, dims))
    return [(k, [1.0] * dims if draw.random() < hot / 4 else (centres[draw.integers(4)] + draw.normal(size=dims) * 0.5).astype(np.float32).tolist(), int(draw.integers(labels)) if draw.random() > hot else 0) for k in range(n)]


@pytest.mark.parametrize("seed,block", [(1, 8192), (2, 64)])
def test_hard_negatives_equal_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr("ledgerforge.llm.vectors.BLOCK_ROWS", block)
    rows = drawn(seed, 600)
    got = hard_negatives(vectors(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined_by_brute_force(rows) != []


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [0.5 + k / 100, 1.0, 0.0], k % 2) for k in range(8)]
    rows += [(50, [0.9, 1.0, 0.3], 0), (50, [0.9, 0.8, 0.3], 0), (3, [0.5, 1.0, 0.0], 0), (3, [0.5, 1.0, 0.0], 0)]  # repeated ids, a repeated row
    rows += [(100, [1.0], 1), (150, [], 1), (200, [-1.0, -1.0, -1.0], 1), (-50, [0.7, 0.7, 0.7], 0)]
    rows += [(None, [1.0, 1.0, 1.0], 0), (300, None, 0), (350, [1.0, None, 1.0], 0), (400, [nan, 1.0, 1.0], 0), (450, [inf, 1.0, 1.0], 1), (500, [1.0, 1.0, 1.0], None)]
    assert sorted(map(tuple, hard_negatives(vectors(spark, rows)).collect())) == mined_by_brute_force(rows) != []
    for few in ([], rows[-5:], [(50, [1.0], 0)], [(50, [], 0), (1, [], 1)]):
        assert sorted(map(tuple, hard_negatives(vectors(spark, few)).collect())) == mined_by_brute_force(few)
    with pytest.raises(Exception, match="no long can hold"):
        hard_negatives(vectors(spark, [(0, [1e9], 0)])).collect()


def test_bounds_hold_and_spare_exact_scores():
    draw = np.random.default_rng(5)
    values = (draw.normal(size=(3000, 17)) * 100).astype(np.int64)
    block = CellBlock(np.arange(3000), draw.integers(0, 3, 3000), values)
    query = values[7]
    low, high = block.bounds(block.tables(query), 0, 3000)
    scores = block.values @ query
    assert (low <= scores).all() and (scores <= high).all()
    start, end = block.stretch(1)
    mine = high[start:end] >= np.partition(low[start:end], -5)[-5]
    assert mine.sum() < 0.2 * (end - start)


# clusters


def clustered_by_brute_force(rows, k=8, rounds=10, dims=64):
    good = [(i, np.floor(np.array(v, np.float64) * 1024).astype(np.int64)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not good:
        return []
    values = np.stack([v for _, v in good])
    order = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1].tolist()))
    centroids = np.stack([v for _, v in order[:k]])
    for step in range(rounds + 1):
        apart = ((values[:, None] - centroids) ** 2).sum(axis=2)
        cluster, distance = apart.argmin(axis=1), apart.min(axis=1)
        if step < rounds:
            for c in range(len(centroids)):
                if (cluster == c).any():
                    centroids[c] = values[cluster == c].sum(axis=0) // (cluster == c).sum()
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of = {c: int(distance[cluster == c].sum()) for c in set(cluster.tolist())}
    return sorted(((i, int(c), int(d), of[int(c)], int(distance.sum()), digest[c]) for (i, _), c, d in zip(good, cluster, distance, strict=True)), key=repr)


@pytest.mark.parametrize("seed,spread", [(1, 0.4), (2, 3.0)])
def test_clusters_equal_full_scans(spark, seed, spread, monkeypatch):
    monkeypatch.setattr("ledgerforge.llm.vectors.BLOCK_ROWS", 500)
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, 64))
    rows = [(k, (centres[draw.integers(12)] + draw.normal(size=64) * spread).astype(np.float32).tolist()) for k in range(1500)]
    rows += [(5000 + k, rows[3][1]) for k in range(500)]  # many copies
    got = yinyang(vectors(spark, [(*r, 0) for r in rows]))
    assert sorted(map(tuple, got.collect()), key=repr) == clustered_by_brute_force(rows)


def test_clusters_of_odd_rows(spark):
    def wide(*start):
        return [*start, *[0.0] * (64 - len(start))]

    rows = [(k % 4, wide(float(k // 2), 1.0)) for k in range(14)] + [(None, wide(0.25)), (None, wide(0.25))]
    odd = [(20, None), (21, [1.0] * 63), (22, [1.0] * 65), (23, []), (24, wide(float("nan"))), (25, wide(float("-inf"))), (26, [None] * 64)]
    for some in (rows + odd, rows[:3], [(1, wide(1.0))] * 20, odd, []):
        got = yinyang(vectors(spark, [(*r, 0) for r in some])).collect()
        assert sorted(map(tuple, got), key=repr) == clustered_by_brute_force(some)
    with pytest.raises(Exception, match="no long can hold"):
        yinyang(vectors(spark, [(1, wide(1e9), 0)])).collect()


def test_bounds_spare_distances():
    draw = np.random.default_rng(3)
    values = (np.repeat(draw.normal(size=(20, 16)), 100, axis=0) * 1000 + draw.normal(size=(2000, 16)) * 50).astype(np.int64)
    centroids = values[draw.choice(2000, 20, replace=False)]
    group = centroid_groups(centroids, 4)
    assert set(group) == {0, 1, 2, 3}
    state, counts = Bounds.scanned(values, centroids, group), []
    for _ in range(6):
        moved = np.stack([values[state.cluster == c].mean(axis=0) if (state.cluster == c).any() else centroids[c] for c in range(20)]).astype(np.int64)
        drift, centroids = np.sqrt(((moved - centroids) ** 2).sum(axis=1)) * clustering.UP, moved
        counts.append(state.moved(values, centroids, group, drift))
        all_ = squared(values, centroids)
        assert (state.cluster == all_.argmin(axis=1)).all()
        assert (state.upper**2 >= all_.min(axis=1)).all()
    assert counts[-1] < 0.1 * all_.size


# fingerprints


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reached(values, radius):
    """For each value the first of those that it reaches."""
    first = list(range(len(values)))
    for a, b in combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= radius:
            low, high = sorted((first[a], first[b]))
            first = [low if x == high else x for x in first]
    return first


def test_fingerprints_are_those_of_the_hashes(spark):
    draw = random.Random(1)
    texts = [None, "", " \n", "one", "One TWO", "a\x1cb\xa0c\x85d É é İ", "x " * 700, " ".join(f"w{draw.randrange(90)}" for _ in range(3000))]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    want = spark.sql("SELECT xxhash64('one two three') AS h").first()["h"]  # Spark's own hash has the same seed
    assert fingerprint("One two\tthree") == want % (1 << 64)


def close(seed, n, near=0.6):
    """Different 64-bit numbers, many of them a few bits from another."""
    draw, values = random.Random(seed), []
    while len(values) < n:
        x = draw.getrandbits(64) if not values or draw.random() > near else draw.choice(values)
        for _ in range(draw.randrange(4)):
            x ^= 1 << draw.randrange(64)
        if x not in values:
            values.append(x)
    return values


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_buckets_link_what_is_within_the_radius(radius):
    parts = [close(k, n) for k, n in enumerate((1, 130, 64, 2, 65, 1, 300))]
    a, b = bucket_links(np.array([x for p in parts for x in p], np.uint64), np.array([len(p) for p in parts]), radius)
    want = sorted((p[k], p[f]) for p in parts for k, f in enumerate(reached(p, radius)) if k != f)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_deeper_masks_lose_no_pair():
    draw = random.Random(2)
    mask = 0xFFFFFFFF
    for _ in range(200):
        x = draw.getrandbits(64)
        y = x ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)
        if (x ^ y) & mask == 0:
            assert any((x ^ y) & m == 0 for m in deeper(mask, 2))
    assert all(m & mask == mask for m in deeper(mask, 2))


@pytest.mark.parametrize("bucket", [1024, 20])
def test_links_of_dense_buckets_are_all_there(spark, bucket):
    values = close(7, 500, near=0.95) + [0xABCDEF << 40 | x for x in range(150)]
    values = list(dict.fromkeys(values))
    rows = spark.createDataFrame([(x - (1 << 64 if x >> 63 else 0),) for x in values], "fp long")
    links = fingerprint_links(rows, bucket=bucket).collect()
    first, at = list(range(len(values))), {x: k for k, x in enumerate(values)}
    for r in links:
        low, high = sorted((first[at[r.a % (1 << 64)]], first[at[r.b % (1 << 64)]]))
        first = [low if x == high else x for x in first]
        assert ((r.a ^ r.b) % (1 << 64)) != 0
    want = reached(values, 2)
    assert first == want and len(set(want)) < len(want)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_simhash_of_the_corpus_equals_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) if len(r.text or "") < 3000 else fingerprint(r.text) for r in rows]
    first = reached(prints, 2)
    least = {}
    for r, f in zip(rows, first, strict=True):
        least[f] = min(r.doc_id, least.get(f, r.doc_id))
    want = sorted((r.doc_id, f"{p:016x}", least[f]) for r, p, f in zip(rows, prints, first, strict=True))
    got = sorted(map(tuple, simhash_duplicates(docs).collect()))
    assert got == want and any(d != c for d, _, c in got)


def test_simhash_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHANGED_BROADCAST", 0)
    long = "a very long word sequence " * 100_000
    rows = [(5, "one two three four"), (2, "One TWO three four"), (7, None), (9, ""), (9, "something else entirely here"), (None, "one two three four"), (None, None), (5, "one two three four"), (1, long), (11, long + "A")]
    got = simhash_duplicates(spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    same, empty, other = f"{plain_fingerprint('one two three four'):016x}", "0" * 16, f"{plain_fingerprint('something else entirely here'):016x}"
    big = f"{fingerprint(long):016x}"
    want = [(5, same, 2), (2, same, 2), (7, empty, 7), (9, empty, 7), (9, other, 9), (None, same, None), (None, empty, None), (5, same, 2), (1, big, 1), (11, f"{fingerprint(long + 'A'):016x}", 1)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert simhash_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    assert simhash_duplicates(spark.createDataFrame([(1, "x", "", 0)], DOCS).withColumn("TEXT2", F.lit(1))).count() == 1
