"""Temperature mixing of sources to a token budget, realised as block permutations.

Weights are token shares to the power of an exponent, which is bisected for the target entropy or the repetition limit. A source
then gets as many whole passes as its quota holds, and a part of one more: its documents lie in blocks, a pass is a permutation
of the blocks, and the part ends at a block's place in it and a document's place in that block. So each document finds its copies
from its own hash and one row per source: no text moves, and the budget is met to within one document a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm.common import at_most, col, free, written

BLOCKS, SEED = 4096, 11
#: Sections of the bracket that one pass over the sources' totals tells apart, and passes.
SECTIONS, PASSES = 16, 6


def word_tokens(text: Column) -> Column:
    """Words and an end: a stand-in for a tokenizer's count that needs no Python."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def exponent(totals: DataFrame, *, target_entropy: float, max_epochs: float, budget: float | None) -> tuple[float, float]:
    """The exponent, and the budget in tokens, for sources' totals (tokens > 0).

    target_entropy is a share of that of equal weights. Entropy falls with the exponent: the largest one in 0..1 that reaches the
    target is taken, or the least that keeps every source within max_epochs, if that is larger (1 is the bound). Without a budget it
    is the least that gives every source a whole pass.
    """
    n, low, high = totals.agg(F.count("*"), F.min("tokens"), F.max("tokens")).first()
    if not n:
        return 1.0, 0.0
    log, scale = F.log("tokens"), math.log(high)  # powers of tokens / high stay within range

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        power = lambda a: F.exp(F.lit(a) * (log - F.lit(scale)))
        row = totals.agg(*(f(a) for a in exponents for f in (lambda a: F.sum(power(a)), lambda a: F.sum(power(a) * (log - F.lit(scale)))))).first()
        return [(row[2 * k], row[2 * k + 1]) for k in range(len(exponents))]

    def epochs(a: float, z: float) -> float:
        """The most passes of any source: the smallest one's."""
        return (high / low) ** (1 - a) if budget is None else budget * math.exp((a - 1) * (math.log(low) - scale)) / high / z

    def enough(a: float, z: float, s: float) -> bool:
        return math.log(z) - a * s / z >= target_entropy * math.log(n) - 1e-12

    def section(holds) -> float:
        """The largest exponent that `holds`, which holds below it; 0 if none does."""
        a, b = 0.0, 1.0
        if holds(b, *sums([b])[0]):
            return b
        for _ in range(PASSES):
            steps = [a + (b - a) * k / SECTIONS for k in range(1, SECTIONS)]
            held = [holds(x, *s) for x, s in zip(steps, sums(steps), strict=True)]
            k = held.index(False) if False in held else SECTIONS - 1
            a, b = (steps[k - 1] if k else a), (steps[k] if k < SECTIONS - 1 else b)
        return a

    best = section(enough)
    if epochs(best, sums([best])[0][0]) > max_epochs:
        best = min(1.0, section(lambda a, z, s: epochs(a, z) > max_epochs) + SECTIONS**-PASSES)
    z = sums([best])[0][0]
    return best, float(budget if budget is not None else high * z)


def mixing_plan(rows: DataFrame, *, target_entropy: float, max_epochs: float, budget: float | None) -> DataFrame:
    """Per source: full (whole passes), cut (the partial pass's end among block keys), last (its block), least (its end therein).

    rows: source, block, place, tokens, one per document.
    """
    blocks = written(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    totals = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    a, wanted = exponent(totals, target_entropy=target_entropy, max_epochs=max_epochs, budget=budget)
    weight = F.pow(F.col("tokens").cast("double"), F.lit(a))
    z = totals.agg(F.sum(weight)).first()[0] or 1.0
    passes = F.lit(wanted) * weight / F.lit(z) / F.col("tokens")
    # a pass that misses by rounding alone is whole
    full = F.floor(passes + 1e-9).cast("int")
    plan = totals.select("source", full.alias("full"), F.greatest(F.floor((passes - full) * F.col("tokens") + 1e-6), F.lit(0)).cast("long").alias("rest"))
    keyed = blocks.join(plan, "source").withColumn("key", block_key(F.col("source"), F.col("block"), F.col("full")))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("key", "block")) - F.col("tokens")
    cuts = keyed.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("tokens")))
    cuts = written(cuts.select("source", "block", F.col("key").alias("cut"), (F.col("rest") - F.col("before")).alias("left")), "cuts")
    inside = rows.join(cuts.select("source", "block", "left"), ["source", "block"])
    upto = inside.withColumn("sum", F.sum("tokens").over(Window.partitionBy("source").orderBy("place"))).where("sum <= left").groupBy("source").agg(F.max("place").alias("least"))
    out = plan.select("source", "full").join(cuts.drop("left"), "source", "left").join(upto, "source", "left")
    return out.select("source", "full", F.col("block").alias("last"), "cut", "least")


def source_key(source: Column) -> Column:
    """A key that tells a null source from an empty one."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def block_key(source: Column, block: Column, epoch: Column) -> Column:
    """A block's place in the permutation of one pass over its source."""
    return F.xxhash64(F.lit(SEED), source, block, epoch.cast("int"))


def mix(docs: DataFrame, *, target_entropy: float = 0.87, max_epochs: float = 4.0, budget: float | None = None, source: str = "source", doc_id: str = "doc_id", text: str = "text", tokens: Column | None = None, plan_rows: int = 100_000) -> DataFrame:
    """docs, each row as often as its source's weight asks for, with __epoch, __place (order within a pass) and __tokens.

    Without a budget every document is there at least once, and the largest source exactly once. With one below that, sources
    that are weighed down lose documents: the rest of a permutation. Null sources make one source; repeated rows of a source have
    the same place, so they come and go together at the end of a pass. Null and empty texts count one token, their end. Columns of docs
    stay as they are, whatever their names; where they have one of the three names, the new column has underscores before its own.
    The plan, one row a source, is broadcast up to `plan_rows`.
    """
    tokens = word_tokens(col(text)) if tokens is None else tokens
    place = F.xxhash64(F.lit(SEED), col(doc_id), col(text))
    block = F.pmod(F.shiftright(place, 20), F.lit(BLOCKS)).cast("int")
    rows = written(docs.select(source_key(col(source)).alias("source"), block.alias("block"), place.alias("place"), tokens.cast("long").alias("tokens")), "tokens")
    plan = written(mixing_plan(rows, target_entropy=target_entropy, max_epochs=max_epochs, budget=budget), "plan")
    epoch, at, counted, of, hashed, inside, key, full, last, cut, least = free(docs.columns, "__epoch", "__place", "__tokens", "__of", "__hash", "__block", "__source", "__full", "__last", "__cut", "__least")
    plan = plan.toDF(key, full, last, cut, least)
    if at_most(plan, plan_rows):
        plan = F.broadcast(plan)
    out = docs.withColumns({of: source_key(col(source)), hashed: place, inside: block, counted: tokens.cast("long")})
    out = out.join(plan, F.col(of) == F.col(key))
    this = block_key(F.col(of), F.col(inside), F.col(full))
    more = (this < F.col(cut)) | ((F.col(inside) == F.col(last)) & (F.col(hashed) <= F.col(least)))
    copies = F.col(full) + F.coalesce(more, F.lit(False)).cast("int")
    out = out.where(copies > 0).withColumn(epoch, F.explode(F.sequence(F.lit(0), copies - 1)))
    order = F.xxhash64(block_key(F.col(of), F.col(inside), F.col(epoch)), F.col(hashed))
    return out.select(*map(col, docs.columns), epoch, order.alias(at), counted)
