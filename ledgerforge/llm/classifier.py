"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is the log odds of a logistic model over hashed words and a few ratios, fitted on a bounded sample of
labelled rows. Sites add theirs: the share of good documents by host and by path (host and language here), each a beta posterior
that shrinks to the level above, from sums gathered over all documents in one grouped aggregation. A site with few documents so
counts for little, whatever its share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import written

#: Hash buckets of words, and the ratios that follow them in a model's weights, with the constant as the last.
BUCKETS, RATIOS = 1 << 17, 6
#: The most labelled rows that a fit uses, and word buckets of them (four bytes each): the bound of what the driver holds.
FIT_ROWS, FIT_BUCKETS = 20_000, 20_000_000
MODEL_SEED = 7
#: A word is hashed as it is and without these, so that marks tell of quality and hide no word.
MARKS = b".,;:!?#*$%&|<>\"'()"
#: Of each target, how a text's words spread its evidence, and how telling a word must be to count.
TARGETS = {"quality": (0.5, 0.0), "toxic": (0.0, 5.0)}


def features(text: str, cache: dict[bytes, tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets of a text, and its ratios."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words))
    distinct = set(words)
    buckets = []
    for w in distinct:
        h = cache.get(w)
        if h is None:
            if len(cache) > 500_000:
                cache.clear()
            h = cache[w] = tuple({xxhash.xxh3_64_intdigest(x) % BUCKETS for x in (w.strip(b".,;:!?"), w.strip(MARKS))})
        buckets += h
    chars = max(1, len(text))
    marked = sum(map(text.count, "#*$%&|<>")) / chars
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    ratios = np.array([min(1, 10 * marked), repeats, 1 - len(distinct) / n, min(1, 5 * text.count("!") / chars), min(1, 20 / n), 1.0])
    return np.unique(np.array(buckets, np.int64)), ratios


@dataclass
class Model:
    """Weights of buckets and ratios; a text's buckets count with the number of them to the power of -`spread`.

    With 0.5 the whole of a text speaks, as for quality; with 0 a word is as telling in a long text as in a short one.
    """

    weights: np.ndarray
    spread: float

    def scale(self, buckets: np.ndarray) -> float:
        return max(1, len(buckets)) ** -self.spread

    def log_odds(self, buckets: np.ndarray, ratios: np.ndarray) -> float:
        return float(self.weights[buckets].sum() * self.scale(buckets) + self.weights[BUCKETS:] @ ratios)


def telling(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, least_z: float) -> np.ndarray:
    """Which buckets occur with a label more often, or less, than chance would have it: by at least so many deviations."""
    with_label, without = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for (buckets, _), y in zip(rows, labels, strict=True):
        (with_label if y else without)[buckets] += 1
    n, share = with_label + without, labels.mean()
    return np.abs(with_label - n * share) >= least_z * np.sqrt(n * share * (1 - share) + 1)


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, spread: float, least_z: float, *, epochs: int = 12, rate: float = 0.3, decay: float = 1e-5) -> Model:
    """Logistic regression by AdaGrad on telling buckets and all ratios, one row at a time in a fixed random order."""
    model, gathered = Model(np.zeros(BUCKETS + RATIOS), spread), np.full(BUCKETS + RATIOS, 1e-6)
    if len(set(labels.tolist())) < 2:
        return model
    told = telling(rows, labels, least_z)
    draw = np.random.default_rng(MODEL_SEED)
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            buckets, ratios = rows[k]
            error = 1 / (1 + np.exp(-np.clip(model.log_odds(buckets, ratios), -30, 30))) - labels[k]
            scale, known = model.scale(buckets), buckets[told[buckets]]
            at = np.concatenate([known, np.arange(BUCKETS, BUCKETS + RATIOS)])
            slope = error * np.concatenate([np.full(len(known), scale), ratios]) + decay * model.weights[at]
            gathered[at] += slope**2
            model.weights[at] -= rate * slope / np.sqrt(gathered[at])
    return model


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, tuple[float, float]], *, fit_rows: int = FIT_ROWS, fit_buckets: int = FIT_BUCKETS) -> dict[str, Model]:
    """One model per target column (0/1) of labels, given its spread and least z, on at most `fit_rows` labelled documents, drawn by a hash
    of their id, and of these the first that have `fit_buckets` word buckets between them.

    Rows without an id or a label don't count; a target without both classes gets a model of zeros. Of labels that repeat an id one
    counts; documents that repeat an id are rows of their own.
    """
    sample = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *targets).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = written(sample, "labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, tuple] = {}
        for batch in batches:
            found = [features(x.as_py() or "", cache) for x in batch.column(1)]
            columns = [pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *batch.columns[2:]], ["doc_id", "buckets", "ratios", *targets])

    schema = "doc_id long, buckets array<int>, ratios array<double>, " + ", ".join(f"{t} int" for t in targets)
    made = written(rows.select("doc_id", "text", *(F.col(t).cast("int").alias(t) for t in targets)).mapInArrow(featured, schema).withColumn("draw", F.xxhash64("doc_id")), "features")
    sizes = made.groupBy("draw").agg(F.sum(F.size("buckets")).alias("n")).toArrow().sort_by("draw")
    within = np.cumsum(sizes["n"].to_numpy()) <= fit_buckets
    if not within.all():
        made = made.where(F.col("draw") < int(sizes["draw"].to_numpy()[within.argmin()]))
    table = made.drop("draw").toArrow().sort_by([("doc_id", "ascending"), *((t, "ascending") for t in targets)])
    got = list(zip(table["buckets"], table["ratios"], strict=True))
    data = [(b.values.to_numpy(), r.values.to_numpy()) for b, r in got]
    out = {}
    for t, (spread, least_z) in targets.items():
        y = table[t].to_pylist()
        known = [k for k, v in enumerate(y) if v is not None]
        out[t] = _fit([data[k] for k in known], np.array([y[k] for k in known], float), spread, least_z)
    return out


def document_evidence(docs: DataFrame, models: dict[str, Model], *, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host, path, and the log odds of each model as `<name>_odds`. Null texts are empty, null hosts and paths are ''."""
    names = [f"{n}_odds" for n in models]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, tuple] = {}
        for batch in batches:
            found = [features(x.as_py() or "", cache) for x in batch.column(3)]
            odds = [pa.array([m.log_odds(*f) for f in found], pa.float64()) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *odds], ["doc_id", "host", "path", *names])

    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), of(host).alias("host"), of(path).alias("path"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, host string, path string, " + ", ".join(f"{n} double" for n in names))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def site_posteriors(scored: DataFrame, odds: str) -> DataFrame:
    """host, path, site: the posterior share of good documents of each path, shrunk to its host, and that to all documents.

    Prior strengths come from the data, by the method of moments: how much shares differ between hosts, and between the paths of
    a host, beyond what their sizes explain. Little difference makes a strong prior, so sites then hardly matter.
    """
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(logistic(F.col(odds))).alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.count("*").alias("k"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("q"), F.sum(F.col("hn") * F.col("hn")).alias("nn")).first()
    if not total["n"]:
        return scored.select("host", "path").withColumns({"site": F.lit(None).cast("double"), "mean": F.lit(None).cast("double")})
    mean = min(max(total["s"] / total["n"], 1e-6), 1 - 1e-6)

    def strength(n: float, k: int, q: float, nn: float) -> float:
        """Prior observations: between-site variance of a one-way layout with binomial noise, by moments; from 1 to 10,000."""
        between = (q - n * mean**2 - (k - 1) * mean * (1 - mean)) / max(1e-9, n - nn / n)
        return float(np.clip(mean * (1 - mean) / between - 1, 1, 1e4)) if between > 0 else 1e4

    upper = strength(total["n"], total["k"], total["q"], total["nn"])
    low = paths.agg(F.count("*").alias("k"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    lower = strength(total["n"], low["k"], low["q"], low["nn"])
    hosts = hosts.select("host", ((F.col("hs") + upper * mean) / (F.col("hn") + upper)).alias("host_share"))
    out = paths.join(hosts, "host")
    return out.select("host", "path", ((F.col("s") + lower * F.col("host_share")) / (F.col("n") + lower)).alias("site"), F.lit(mean).alias("mean"))


def classify(docs: DataFrame, labels: DataFrame, *, keep_odds: float = 0.0, toxic_odds: float = 0.0, fit_rows: int = FIT_ROWS, host: str = "source", path: str = "lang") -> DataFrame:
    """Per row of docs: doc_id, doc_odds, site, quality (0 to 1), toxicity (0 to 1), toxic, kept.

    quality combines the document's odds with how far its site's posterior lies from the mean; a document is kept if its quality
    odds reach `keep_odds` and it isn't toxic. Sites count for quality only: an insult is in the text. Null or empty texts are judged
    by the ratios of an empty text and their site. Null hosts and paths make a site of their own; repeated rows and ids are rows of
    their own, equal ones judged alike; other columns of docs don't matter.
    """
    models = fit(docs, labels, TARGETS, fit_rows=fit_rows)
    scored = written(document_evidence(docs, models, host=host, path=path), "evidence")
    sites = site_posteriors(scored, "quality_odds")
    odds = lambda p: F.log(p / (1 - p))
    bounded = F.least(F.greatest(F.col("site"), F.lit(1e-6)), F.lit(1 - 1e-6))
    out = scored.join(sites, ["host", "path"]).withColumn("odds", F.col("quality_odds") + odds(bounded) - odds(F.col("mean")))
    toxic = F.col("toxic_odds") > toxic_odds
    return out.select("doc_id", F.col("quality_odds").alias("doc_odds"), "site", logistic(F.col("odds")).alias("quality"), logistic(F.col("toxic_odds")).alias("toxicity"), toxic.alias("toxic"), ((F.col("odds") >= keep_odds) & ~toxic).alias("kept"))
