"""Secret scans: spans of credentials in texts, judged by how many owners of the corpus hold the same string.

DataFrame functions only. One pass over the texts finds the spans; what follows works on narrow rows of candidates: their
hashes are aggregated by distinct repositories and owners, so that a string copied by many owners (an example) is told apart
from one that a single owner holds (live-looking).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.common import at_most, col, free, written

# The kinds in their order, with patterns, the group that holds the secret and its least length.
# A longest run of at least n characters is found by {n,} as by + and a later test; in assign the test must come later, since a
# match that is too short still uses up its characters.
# A private key goes from BEGIN to its END, whatever is between; without an END before the next BEGIN or the text's end, as far as
# what follows reads as a key: headers and runs of base64, then one short run that ends a line. The possessive loops don't recurse.
_RULE = r"[A-Z ]{0,20}PRIVATE KEY-----"
PEM = (
    rf"-----BEGIN {_RULE}(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END {_RULE}"
    r"|(?:(?:\s|\\[nr])*+(?:(?:Proc-Type|DEK-Info): [^\r\n\\]*+|[A-Za-z0-9+/=]{16,}+))*+(?:(?:\s|\\[nr])++[A-Za-z0-9+/]{1,15}+={0,2}+(?=\\[nr]|[\r\n]|-----|\z))?)"
)
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("key", r"gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|" + PEM, 0, 1),
)
BASE = ("assign", "access", "hex")
#: From so many occurrences on, a string's verdict returns to them by a broadcast: such strings are few, and one of them can be a third
#: of all candidates. More of them than HOT_STRINGS, which takes a thousand million candidates, go the way of the others.
HOT_SPANS, HOT_STRINGS = 10_000, 100_000
SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,hash:bigint>>"
CHUNK = 64


def running(values: Column, zero: Column, merge, kind: str = "bigint") -> Column:
    """What `merge` has gathered before each element of an array.

    Appending to an array copies it, so this goes by chunks of 64 elements and then within them: about linear for any length.
    """

    def plain(array: Column, start: Column) -> Column:
        state = F.struct(start.alias("now"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(array, state, lambda s, x: F.struct(merge(s["now"], x).alias("now"), F.array_append(s["out"], s["now"]).alias("out")))["out"]

    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / CHUNK), F.lit(0)).cast("int")), lambda c: F.slice(values, c * CHUNK + 1, F.lit(CHUNK)))
    starts = plain(F.transform(chunks, lambda a: F.aggregate(a, zero, merge)), zero)
    return F.flatten(F.zip_with(chunks, starts, plain))


def _spans(text: Column, rank: int) -> Column:
    """The spans of one kind: code points, end exclusive. Matches and the text between them alternate, so lengths give places."""
    kind, pattern, group, least = KINDS[rank]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # a private key is known by its body, however its lines are broken
    held = (lambda x: F.when(x.startswith("-----BEGIN "), F.regexp_replace(x, r"-----(?:BEGIN|END) [A-Z ]*-----|\s+|\\[nr]", "")).otherwise(x)) if kind == "key" else (lambda x: x)
    sizes = lambda array: F.transform(array, lambda x: F.length(x).cast("bigint"))
    between = sizes(F.split(text, pattern, -1))
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(whole)), sizes(whole), lambda b, m: b + m)
    ends = F.zip_with(running(steps, F.lit(0).cast("bigint"), lambda a, b: a + b), steps, lambda a, b: a + b)
    found = F.zip_with(F.arrays_zip(whole.alias("m"), secret.alias("s")), ends, lambda x, end: F.struct((end - F.length(x["m"])).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), F.when(F.length(x["s"]) >= least, F.xxhash64(held(x["s"]))).alias("hash")))
    return F.when(F.size(whole) > 0, F.filter(found, lambda x: x["hash"].isNotNull())).otherwise(F.array().cast(SPAN)).cast(SPAN)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _holder(columns: str | tuple[str, ...]) -> Column:
    """A key of one or several columns; null tells itself apart from empty."""
    names = (columns,) if isinstance(columns, str) else columns
    return F.to_json(F.array(*(F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit("")) for c in names)))


def find_secrets(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", repository: str | tuple[str, ...] = ("source", "lang"), owner: str | tuple[str, ...] = "source",
    example_owners: int = 3, example_repositories: int = 6,
) -> DataFrame:
    """Per row of docs: row, doc_id, text_hash, and `spans`, an array of (start, rank, kind, end, hash, owners, repositories, live).

    A string is a widely copied example if `example_owners` owners hold it, or two owners in `example_repositories` repositories; else it
    is live, however often its one owner has it. Owners are told by their column, repositories by theirs: here a source is an owner, and
    what it has in one language a repository of it. Spans of the base kinds are always there, with `live`; those of kind `key` only if live.

    Spans are sorted by start, then by kind. A null or empty text has no spans; null owners and repositories count as one owner and one
    repository. Repeated rows are rows of their own; other columns of docs don't matter. No rows give none.
    """
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    found = docs.select(
        col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), _holder(repository).alias("repository"), _holder(owner).alias("owner"),
        F.concat(*(_spans(body, k) for k in range(len(KINDS)))).alias("found"),
    )
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = found.where(F.size("found") > 0).select("row", "repository", "owner", F.explode("found").alias("x"))
    held = each.groupBy("x.hash", "owner", "repository").count().groupBy("hash").agg(F.countDistinct("owner").alias("owners"), F.count("*").alias("repositories"), F.sum("count").alias("n"))
    held = written(held, "held")
    spans = each.select("row", "x", F.col("x.hash").alias("hash"))
    hot = held.where(F.col("n") >= HOT_SPANS).drop("n")
    if at_most(hot, HOT_STRINGS):
        hot = F.broadcast(hot)
        judged = spans.join(hot, "hash").unionByName(spans.join(hot, "hash", "left_anti").join(held.where(F.col("n") < HOT_SPANS).drop("n"), "hash"))
    else:
        judged = spans.join(held.drop("n"), "hash")
    copied = (F.col("owners") >= example_owners) | ((F.col("owners") > 1) & (F.col("repositories") >= example_repositories))
    judged = judged.withColumn("live", ~copied).where(F.col("live") | (F.col("x.rank") < len(BASE)))
    parts = ("x.start", "x.rank", "x.kind", "x.end", "x.hash", "owners", "repositories", "live")
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id", "text_hash").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """find_secrets, with the counts and digests of its spans per row of docs."""
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_secrets(docs, **options).select(
        "doc_id", *(of(kind) for kind in BASE), F.sha2(joined(F.filter(spans, lambda x: x["rank"] < len(BASE))), 256).alias("base_sha256"), joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda x: x["live"])).cast("long").alias("n_live"),
    )


def redact(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", mark: str = "<secret>", broadcast_spans: int = 500_000, **options) -> DataFrame:
    """docs, with every live span of its text replaced by `mark`; widely copied examples stay. No row goes, and no other column changes.

    Rows that repeat an id and a text are treated alike. The spans return to the texts by a broadcast while they are at most
    `broadcast_spans` (some 20 MB), else by a shuffle.
    """
    key, hashed, cut = free(docs.columns, "__id", "__hash", "__spans")
    live = F.transform(F.filter("spans", lambda x: x["live"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    spans = find_secrets(docs, doc_id=doc_id, text=text, **options).select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), live.alias(cut))
    spans = written(spans.where(F.size(cut) > 0).dropDuplicates([key, hashed]), "live")
    if (spans.agg(F.sum(F.size(cut))).first()[0] or 0) <= broadcast_spans:
        spans = F.broadcast(spans)
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    out = docs.join(spans, col(doc_id).cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(body) == F.col(hashed)), "left")
    before = running(F.transform(cut, lambda x: x["end"]), F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b))
    cuts = F.zip_with(cut, before, lambda x, at: F.when(x["end"] <= at, F.lit("")).otherwise(F.concat(F.substring(body, at.cast("int") + 1, F.greatest(x["start"] - at, F.lit(0)).cast("int")), F.lit(mark))))
    tail = F.substring(body, F.array_max(F.transform(cut, lambda x: x["end"])).cast("int") + 1, F.length(body))
    new = F.when(F.col(cut).isNull(), col(text)).otherwise(F.concat(F.array_join(cuts, ""), tail))
    return out.select(*(new.alias(c) if c == text else col(c) for c in docs.columns))
