"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint is cut into four pieces; two that differ in few bits agree in all but as many pieces, so they meet in a bucket of two
pieces. Buckets that hold more than BUCKET fingerprints are dealt anew by pieces of the bits they have not yet in common, and again, up
to buckets that share all but ten bits, which no more than 1,024 different fingerprints can.

Within a task buckets stand one after the other, as 64 bitmaps, one for each bit of all its fingerprints. Comparing every row with the
one s places on is then one exclusive-or a bitmap; carry-save counters add the 64 results up for 64 rows a word, and words in which
all rows have passed the radius are left. Links go on as one row for each fingerprint that isn't its component's first, never as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import at_most, col, semi, written
from ledgerforge.operators.components import connected_components

BITS, PIECES, BUCKET = 64, 4, 1024
#: Rows of buckets that a task compares at a time.
BATCH_ROWS = 1 << 16
#: Fingerprints with others or with copies that may be broadcast (16 bytes each).
CHANGED_BROADCAST = 500_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each 1 if it is set in more than half of the hashes of the text's word shingles; of the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lower() of bytes is A-Z only
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    ends = starts[size - 1 :] + lengths[size - 1 :] - 1
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    hashes = np.array([digest(view[a:b], 42) for a, b in zip(starts[: len(ends)].tolist(), ends.tolist(), strict=True)], "<u8")
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 255):  # sums of a byte each
        part = np.unpackbits(hashes[a : a + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(part, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """doc_id, fp (a long of the same bits)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text")).mapInArrow(sign, "doc_id long, fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bitmap b has bit b of each value, 64 values a word, with a word of zeros behind."""
    words = -(-len(values) // 64)
    filled = np.zeros(words * 64, "<u8")
    filled[: len(values)] = values
    bits = np.unpackbits(filled.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((BITS, words + 1), np.uint64)
    out[:, :words] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return out


def within(maps: np.ndarray, by: int, open_: np.ndarray, radius: int) -> np.ndarray:
    """Of the rows in the bitmap open_, those that differ from the row `by` places on in at most `radius` bits.

    The counters are bitmaps, one a binary digit; a row whose count passes the radius is closed, and words without open rows are left.
    """
    words, bits = divmod(by, 64)
    at = np.flatnonzero(open_)
    alive = open_[at]
    digits = [np.zeros_like(alive) for _ in range(radius.bit_length())]
    for b in range(BITS):
        carry = maps[b, at + words]
        if bits:
            carry = carry >> np.uint64(bits) | maps[b, at + words + 1] << np.uint64(64 - bits)
        carry = carry ^ maps[b, at]
        for digit in digits:
            digit ^= carry  # the sum's digit; where it turned to zero, a carry goes on
            carry &= ~digit
        over, equal = carry, np.full_like(alive, np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in reversed(range(len(digits))):
            if radius >> k & 1:
                equal &= digits[k]
            else:
                over = over | equal & digits[k]
                equal &= ~digits[k]
        alive &= ~over
        if b % 4 == 3 and (kept := alive != 0).mean() < 0.5:
            alive, at, digits = alive[kept], at[kept], [d[kept] for d in digits]
            if not len(at):
                break
    out = np.zeros_like(open_)
    out[at] = alive
    return out


def bucket_links(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that reach an earlier one of their bucket by steps within the radius, and the first that each reaches.

    sizes: how many fingerprints each bucket has; buckets stand one after the other.
    """
    if not len(sizes):
        return values[:0], values[:0]
    # larger buckets first: at any shift the rows with a partner are those of the first few
    starts, order = np.cumsum(sizes) - sizes, np.argsort(-sizes, kind="stable")
    values, sizes = np.concatenate([values[starts[k] : starts[k] + sizes[k]] for k in order]), sizes[order]
    last = np.cumsum(sizes)
    ends, begins = np.repeat(last, sizes), np.repeat(last - sizes, sizes)
    label, maps = np.arange(len(values)), planes(values)
    for by in range(1, int(sizes[0])):
        rows = int(last[np.count_nonzero(sizes > by) - 1])
        open_ = np.zeros(-(-rows // 64) * 64, bool)
        open_[:rows] = np.arange(by, rows + by) < ends[:rows]
        found = within(maps, by, np.packbits(open_, bitorder="little").view("<u8"), radius)
        pairs = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
        for x in pairs[label[pairs] != label[pairs + by]]:
            low, high = sorted((label[x], label[x + by]))
            if low != high:
                part = label[begins[x] : ends[x]]
                part[part == high] = low
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def pieces(bits: list[int], count: int) -> list[int]:
    """Masks of so many pieces of the bits, of about equal length."""
    edges = [len(bits) * k // count for k in range(count + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:], strict=False)]


def deeper(mask: int, radius: int) -> list[int]:
    """The mask with one more piece of the bits that it leaves: one of them two fingerprints within the radius have in common."""
    return [mask | p for p in pieces([b for b in range(BITS) if not mask >> b & 1], radius + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS if mask >> BITS - 1 else 0)


def _compared(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of each bucket (mask, bits) of the rows' fingerprints, as a tree."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((3, 0), np.int64)

        def links(part: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.concatenate([[True], (part[:2, 1:] != part[:2, :-1]).any(axis=0), [True]]))
            sizes = np.diff(edge)
            shared = np.repeat(sizes > 1, sizes)
            a, b = bucket_links(part[2, shared].view(np.uint64), sizes[sizes > 1], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rest = np.concatenate([rest, np.stack([batch.column(c).to_numpy() for c in range(3)])], axis=1)
            if rest.shape[1] >= BATCH_ROWS:
                whole = int(np.flatnonzero((rest[:2] != rest[:2, -1:]).any(axis=0))[-1]) + 1  # the last bucket may go on
                yield links(np.ascontiguousarray(rest[:, :whole]))
                rest = rest[:, whole:]
        if rest.shape[1]:
            yield links(np.ascontiguousarray(rest))

    return rows.repartition("mask", "bits").sortWithinPartitions("mask", "bits").select("mask", "bits", "fp").mapInArrow(compare, "a long, b long")


def fingerprint_links(classes: DataFrame, *, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b): enough links between the different fingerprints fp that whatever is within the radius is connected."""
    masks = [sum(x) for x in combinations(pieces(list(range(BITS)), radius + 2), 2)]
    found: list[DataFrame] = []
    rows = classes.select("fp", F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks))).alias("mask")).withColumn("bits", F.expr("fp & mask"))
    while True:
        # buckets of so few bits can't hold more
        last = 1 << BITS - min(m.bit_count() for m in masks) <= bucket
        hot = None if last else written(rows.groupBy("mask", "bits").count().where(F.col("count") > bucket).select("mask", "bits"), "hot")
        if hot is None or at_most(hot, 0):
            return reduce(DataFrame.unionByName, [*found, written(_compared(rows, radius), "links")])
        marked = F.broadcast(hot) if at_most(hot, 1_000_000) else hot
        found.append(written(_compared(rows.join(marked, ["mask", "bits"], "left_anti"), radius), "links"))
        below = {m: deeper(m, radius) for m in masks}
        next_ = F.create_map(*(x for m, more in below.items() for x in (F.lit(_signed(m)).cast("long"), F.array(*(F.lit(_signed(y)).cast("long") for y in more)))))
        rows = rows.join(marked, ["mask", "bits"], "left_semi").select("fp", F.explode(next_[F.col("mask")]).alias("mask")).distinct()
        rows = written(rows.withColumn("bits", F.expr("fp & mask")), "dense")
        masks = sorted({y for more in below.values() for y in more})


def simhash_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that is reached over fingerprints within the radius).

    Words are cut at ASCII white space and lower-cased A-Z. Null and empty texts have the fingerprint zero, which links like any other.
    Every row is a document: rows that repeat an id are linked by their fingerprints alone, and a row reaches itself. Rows without an
    id get a fingerprint, but no component, and link nothing. No rows give none; other columns don't matter.
    """
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = written(rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    near = connected_components(fingerprint_links(classes, radius=radius))
    labels = written(near.join(classes, near["id"] == classes["fp"]).select("fp", "comp", "first"), "labels")
    least = labels.groupBy("comp").agg(F.min("first").alias("component_id"))
    if at_most(least, CHANGED_BROADCAST):
        least = F.broadcast(least)
    linked = labels.join(least, "comp").select("fp", "component_id")
    copies = semi(classes.where("n > 1"), labels.select("fp"), "fp", how="left_anti").select("fp", F.col("first").alias("component_id"))
    changed = written(linked.unionByName(copies), "changed")
    if at_most(changed, CHANGED_BROADCAST):
        changed = F.broadcast(changed)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(changed, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))
