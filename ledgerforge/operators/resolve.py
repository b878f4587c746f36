"""Entity resolution: observations to entities, and entities to attributes.

Observations: key, source, kind, priority, manufacturer, code, ean, name. The order of trust is (priority, key) throughout. Links go
from each row to the first row of its group, never between all rows of a group, so groups cost what they hold.

Rows that are alike in what links them are one pack (`packed`). Packs are tied and named instead of rows, unless forced joins name single
rows; a pack's rows are read once, and are shuffled again only where several packs are one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.operators.components import connected_components
from ledgerforge.sources.shared import at_most, written

ORDER = ("priority", "key")
#: Kinds whose rows may be live; imports and snapshots attest history.
LIVE_KINDS = ("manufacturer", "retailer")
#: Up to so many rows a table of links is broadcast.
BROADCAST_LINKS = 200_000


def order() -> Column:
    return F.struct(*ORDER)


def reassigned(obs: DataFrame, codes: DataFrame) -> DataFrame:
    """obs, with the codes that a hand-kept list (key, code) corrects."""
    new = codes.select("key", F.col("code").alias("__code"))
    return obs.join(new, "key", "left").withColumn("code", F.coalesce("__code", "code")).select(*obs.columns)


def unattributed(obs: DataFrame) -> DataFrame:
    """key, name of rows without a manufacturer: they join nothing."""
    return obs.where("manufacturer IS NULL").select("key", "name")


def _with_forced(obs: DataFrame, joins: DataFrame | None) -> DataFrame:
    if joins is None:
        return obs.withColumn("__forced", F.lit(False))
    forced_keys = joins.select("key", F.lit(True).alias("__forced")).distinct()
    return obs.join(forced_keys, "key", "left").withColumn("__forced", F.coalesce("__forced", F.lit(False)))


def _nameless(slug: Column) -> Column:
    """Whether a row has neither code nor barcode nor a name to make an id of, nor a forced join."""
    return F.col("code").isNull() & F.col("ean").isNull() & ~F.col("__forced") & (F.coalesce(slug, F.lit("")) == "")


def degenerate_names(obs: DataFrame, slug: Column, joins: DataFrame | None = None) -> DataFrame:
    """key, name of attributed rows that would make an id of nothing: they join nothing."""
    return _with_forced(joinable(obs, joins), joins).where(_nameless(slug)).select("key", "name")


def _guarded(obs: DataFrame, joins: DataFrame | None) -> DataFrame:
    """Attributed rows with __joins: false for rows of barcode databases whose manufacturer and barcode nobody else asserts, unless a
    forced join names them."""
    own = obs.where("kind <> 'barcode-db' AND ean IS NOT NULL").select("manufacturer", "ean", F.lit(True).alias("__own")).distinct()
    out = _with_forced(obs.where("manufacturer IS NOT NULL"), joins).join(own, ["manufacturer", "ean"], "left")
    return out.withColumn("__joins", (F.col("kind") != "barcode-db") | F.col("__forced") | F.coalesce("__own", F.lit(False)))


def unjoined_barcode_claims(obs: DataFrame, joins: DataFrame | None = None) -> DataFrame:
    """Rows of barcode databases whose manufacturer and barcode nobody else asserts: they name no product of their own.

    Those that a forced join names are joined all the same, as are no rows without a manufacturer.
    """
    return _guarded(obs, joins).where("NOT __joins").select(*obs.columns)


def joinable(obs: DataFrame, joins: DataFrame | None = None) -> DataFrame:
    return _guarded(obs, joins).where("__joins").select(*obs.columns)


def group_links(obs: DataFrame, by: list[str]) -> DataFrame:
    """(a, b): each row of a group and the group's first row in the order of trust."""
    given = obs.dropna(subset=by).select("key", "priority", *by)
    first = given.groupBy(*by).agg(F.min_by("key", order()).alias("b"))
    return given.select("key", *by).join(first, by).select(F.col("key").alias("a"), "b").where("a <> b")


def ean_owners(obs: DataFrame) -> DataFrame:
    """ean, owner: the manufacturer of the most trusted row; claims: how many manufacturers claim it."""
    return obs.where("ean IS NOT NULL").groupBy("ean").agg(F.min_by("manufacturer", order()).alias("owner"), F.countDistinct("manufacturer").alias("claims"))


def owned_links(obs: DataFrame) -> DataFrame:
    """(a, b): each row of a barcode that its manufacturer owns and the barcode's first row, which is the owner's."""
    given = obs.where("ean IS NOT NULL").select("key", "manufacturer", "ean", "priority")
    first = given.groupBy("ean").agg(F.min_by(F.struct("manufacturer", "key"), order()).alias("first"))
    # one row a barcode is hashed, so that not all rows are sorted to meet it
    return given.join(first.hint("shuffle_hash"), "ean").where((F.col("manufacturer") == F.col("first.manufacturer")) & (F.col("key") != F.col("first.key"))).select(F.col("key").alias("a"), F.col("first.key").alias("b"))


def disputed(obs: DataFrame) -> DataFrame:
    """ean, owner, claimants: barcodes of several manufacturers, with all claiming keys in order."""
    both = obs.join(ean_owners(obs).where("claims > 1"), "ean")
    return both.groupBy("ean", "owner").agg(F.array_sort(F.collect_list("key")).alias("claimants"))


def entity_ids(rows: DataFrame, slug: Column, aliases: DataFrame | None = None) -> DataFrame:
    """comp, entity: the most trusted row's manufacturer, with the most trusted code, else that row's name; renamed once by aliases."""
    ids = rows.withColumn("__slug", slug).groupBy("comp").agg(F.min_by("manufacturer", order()).alias("m"), F.expr("min_by(code, struct(priority, key)) FILTER (WHERE code IS NOT NULL)").alias("code"), F.min_by("__slug", order()).alias("slug"))
    return _renamed(ids.select("comp", _entity("m", "code", "slug").alias("entity")), aliases)


def _entity(manufacturer: str, code: str, slug: str) -> Column:
    return F.concat_ws("/", F.col(manufacturer).cast("string"), F.coalesce(code, slug))


def _renamed(ids: DataFrame, aliases: DataFrame | None) -> DataFrame:
    if aliases is None:
        return ids
    new = aliases.select(F.col("old").alias("entity"), F.col("new").alias("__new"))
    return ids.join(new, "entity", "left").withColumn("entity", F.coalesce("__new", "entity")).select(*ids.columns)


def name_candidates(rows: DataFrame, slug: Column, *, single: bool = False) -> DataFrame:
    """comp (a group without code and barcode), targets: the groups with a code of the same manufacturer and name's slug; target: the least.

    A name's targets are counted once, whoever asks for them. Only a group of several names, which forced joins alone make, meets the
    targets of each: those that two of its names share count once. single: no two rows are of one comp, so none needs to be grouped.
    """
    named = rows.where("manufacturer IS NOT NULL").withColumn("__slug", slug).where("__slug IS NOT NULL")
    if single:
        named = named.select("comp", "manufacturer", "__slug", F.col("code").isNotNull().cast("int").alias("codes"), F.col("ean").isNotNull().cast("int").alias("eans"))
    else:
        groups = rows.groupBy("comp").agg(F.count("code").alias("codes"), F.count("ean").alias("eans"))
        named = named.select("comp", "manufacturer", "__slug").distinct().join(groups, "comp")
    coded = named.where("codes > 0").select("manufacturer", "__slug", F.col("comp").alias("target"))
    bare, name = named.where("codes = 0 AND eans = 0"), F.struct("manufacturer", "__slug")
    bare = bare.select("comp", F.array(name).alias("names")) if single else bare.groupBy("comp").agg(F.collect_set(name).alias("names"))
    one = bare.where(F.size("names") == 1).select("comp", F.col("names")[0]["manufacturer"].alias("manufacturer"), F.col("names")[0]["__slug"].alias("__slug"))
    known = coded.groupBy("manufacturer", "__slug").agg(F.count("*").alias("targets"), F.min("target").alias("target"))
    out = one.join(known, ["manufacturer", "__slug"]).select("comp", "targets", "target")
    several = bare.where(F.size("names") > 1).select("comp", F.inline("names")).join(coded, ["manufacturer", "__slug"])
    return out.unionByName(several.groupBy("comp").agg(F.countDistinct("target").alias("targets"), F.min("target").alias("target")))


def _forced_in(facts: list[dict]) -> Iterator[tuple]:
    """(comp, __to, landed) of what a region's joins merge. Facts are of `what` 0 (a component: its first row, its best code), 1 (a
    join: its key's component and its target) or 2 (an alias)."""
    new = {f["x"]: f["y"] for f in facts if f["what"] == 2}
    state = {f["comp"]: ((f["priority"], f["key"], (f["x"], f["y"])), None if f["code"] is None else (f["code_priority"], f["code_key"], f["code"])) for f in facts if f["what"] == 0}
    entries = sorted((f["key"], f["x"], f["comp"]) for f in facts if f["what"] == 1)
    rank = lambda x: tuple((v is not None, v) for v in x[:2])

    def name(at) -> str:
        (_, _, (maker, slug)), best = state[at]
        raw = "/".join(v for v in (maker, best[2] if best else slug) if v is not None)
        return new.get(raw, raw)

    parent, ids = {c: c for c in state}, {c: name(c) for c in state}
    having: dict[str, set] = {}
    for c, i in ids.items():
        having.setdefault(i, set()).add(c)

    def root(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    changed = True
    while changed:
        changed = False
        for _, target, comp in entries:
            at = root(comp)
            others = having.get(target, set()) - {at}
            if ids[at] == target or not others:
                continue
            low, high = sorted((at, min(others)))
            for c in (low, high):
                having[ids[c]].discard(c)
            codes = [x for x in (state[low][1], state[high][1]) if x]
            state[low] = (min(state[low][0], state[high][0], key=rank), min(codes, key=rank, default=None))
            parent[high] = low
            del ids[high]
            ids[low] = name(low)
            having.setdefault(ids[low], set()).add(low)
            changed = True
    yield from ((c, root(c), False) for c in parent if root(c) != c)
    yield from ((c, None, True) for c in {root(comp) for _, target, comp in entries if ids[root(comp)] == target})


def forced_fixpoint(rows: DataFrame, joins: DataFrame, slug: Column, aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(comp, __to): components that forced joins merge, and (comp): merged components in which a forced join landed.

    The joins go in the order of their keys, pass by pass, until no pass merges any: each goes to the component that has its target's
    id then, and ids follow every merge. rows: of a manufacturer each, as `linked` gives them.

    An id begins with a manufacturer of its component, or is the alias of one that does. So manufacturers that no join ties, neither by
    its target nor by an alias of that, can't meet: what they tie is a region, and regions are solved apart, one in a task at a time.
    """
    node, kind = lambda c: F.substring_index(c, "/", 1), rows.schema["comp"].dataType.simpleString()
    wanted = joins.select("key", F.col("entity").alias("target"))
    if aliases is not None:
        wanted = wanted.join(aliases.select(F.col("old").alias("target"), "new"), "target", "left").select("key", F.coalesce("new", "target").alias("target"))
    first = F.min(F.struct(*ORDER, F.col("manufacturer").cast("string").alias("x"), F.col("__slug").alias("y"))).alias("first")
    code = F.min(F.when(F.col("code").isNotNull(), F.struct(F.col("priority").alias("code_priority"), F.col("key").alias("code_key"), F.col("code").cast("string").alias("code")))).alias("best")
    comps = rows.withColumn("__slug", slug).groupBy("comp").agg(first, code).select("comp", "first.*", "best.*").withColumn("entity", F.concat_ws("/", "x", F.coalesce("code", "y")))
    if aliases is not None:
        comps = comps.join(aliases.select(F.col("old").alias("entity"), "new"), "entity", "left").withColumn("entity", F.coalesce("new", "entity")).drop("new")
    comps = written(comps, "components")
    entries = wanted.distinct().join(rows.select("key", "comp"), "key").join(comps.select("comp", node("x").alias("node")), "comp")
    entries = written(entries, "forced")
    reach = entries.select("comp").unionByName(comps.join(entries.select(F.col("target").alias("entity")), "entity", "left_semi").select("comp")).distinct()
    edges = entries.select(F.col("node").alias("a"), node("target").alias("b"))
    facts = comps.join(reach, "comp", "left_semi").select(node("x").alias("node"), F.lit(0).alias("what"), *(c for c in comps.columns if c != "entity"))
    facts = facts.unionByName(entries.select("node", F.lit(1).alias("what"), "comp", "key", F.col("target").alias("x")), allowMissingColumns=True)
    if aliases is not None:
        edges = edges.unionByName(aliases.join(entries, aliases["new"] == entries["target"], "left_semi").select(node("old").alias("a"), node("new").alias("b")))
        facts = facts.unionByName(aliases.select(node("old").alias("node"), F.lit(2).alias("what"), F.col("old").alias("x"), F.col("new").alias("y")), allowMissingColumns=True)
    regions = connected_components(edges).select(F.col("id").alias("node"), F.col("comp").alias("region"))
    facts = facts.join(regions, "node", "left").withColumn("region", F.coalesce("region", "node")).drop("node")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, comp = [], None
        def solved(found: list[tuple]) -> pa.RecordBatch:
            of, to, landed = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(of, comp), pa.array(to, comp), pa.array(landed, pa.bool_())], ["comp", "__to", "landed"])

        for batch in batches:
            comp, found = batch.schema.field("comp").type, []
            for f in batch.to_pylist():
                if held and held[0]["region"] != f["region"]:
                    found += _forced_in(held)
                    held = []
                held.append(f)
            yield solved(found)
        if held:
            yield solved(list(_forced_in(held)))

    out = written(facts.repartition("region").sortWithinPartitions("region").mapInArrow(solve, f"comp {kind}, __to {kind}, landed boolean"), "forced")
    return out.where("__to IS NOT NULL").select("comp", "__to"), out.where("landed").select("comp")


def unlanded(obs: DataFrame, joins: DataFrame, resolved: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """key, entity: forced joins of observed keys that aren't in their (renamed) target in what `resolve` gives, before retraction."""
    out = joins.select("key", "entity").join(obs.select("key"), "key", "left_semi").withColumn("__target", F.col("entity"))
    if aliases is not None:
        out = out.join(aliases.select("old", "new"), out["entity"] == F.col("old"), "left").withColumn("__target", F.coalesce("new", "entity"))
    out = out.join(resolved.select("key", F.col("entity").alias("__in")), "key", "left")
    return out.where("__in IS NULL OR __in <> __target").select("key", "entity")


def survivors(rows: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """Per entity and field the first value that isn't null, in the order of trust. An empty text is a value.

    Where rows have `superseded`, those of an old packaging come last within their kind.
    """
    trust = "priority, superseded, key" if "superseded" in rows.columns else "priority, key"
    return rows.groupBy(by).agg(*(F.expr(f"min_by({f}, struct({trust})) FILTER (WHERE {f} IS NOT NULL)").alias(f) for f in fields))


def ean_assertions(rows: DataFrame, by: str = "comp") -> DataFrame:
    """Per entity and barcode: sources, whether an authority or another than a barcode database asserts it, confidence, strength."""
    out = rows.where("ean IS NOT NULL").groupBy(by, "ean").agg(
        F.countDistinct("source").alias("sources"), F.bool_or(F.col("kind").isin("curated", "manufacturer")).alias("authority"),
        F.bool_or(F.col("kind") != "barcode-db").alias("independent"), F.min("priority").alias("best"),
    )
    confirmed = F.col("authority") | ((F.col("sources") >= 2) & F.col("independent"))
    return out.withColumn("confidence", F.when(confirmed, "confirmed").otherwise("provisional"))


def corroborated_eans(rows: DataFrame, by: str = "entity") -> DataFrame:
    """Per entity its barcode, confidence, `others` (kept as further ones), decision and `disputed` (the barcodes in conflict).

    rows: as `superseded` gives them, with `live` (listed now: neither archived nor missed too often). The strongest barcode is live,
    of the better live kind, of the better kind, of more sources, the smaller. Barcodes known only from superseded rows are never
    the first while another is there. Else the one barcode that a live manufacturer lists under the surviving code decides, unless
    a loser is known only from other codes; without such a one the barcodes are in conflict.
    """
    live = F.coalesce("live", F.lit(False)) & F.col("kind").isin(*LIVE_KINDS)
    carried = F.coalesce(F.col("code") == F.col("surviving"), F.col("surviving").isNull())
    each = rows.where("ean IS NOT NULL").groupBy(by, "ean").agg(
        F.countDistinct("source").alias("sources"), F.min("priority").alias("best"), F.bool_or(F.col("kind").isin("curated", "manufacturer")).alias("authority"), F.bool_or(F.col("kind") != "barcode-db").alias("independent"),
        F.bool_or(live).alias("live"), F.bool_or(live & (F.col("kind") == "manufacturer") & carried).alias("decides"), F.bool_or(carried).alias("carried"), F.bool_and("superseded").alias("old"),
    )
    confidence = F.when(F.col("authority") | ((F.col("sources") >= 2) & F.col("independent")), "confirmed").otherwise("provisional")
    strength = F.struct((~F.col("live")).alias("a"), F.when(F.col("decides"), 1).when(F.col("live"), 2).otherwise(9).alias("b"), "best", (-F.col("sources")).alias("c"), F.col("ean").alias("d"))
    each = each.withColumn("x", F.struct("ean", confidence.alias("confidence"))).withColumn("strength", strength)
    first = lambda where: F.expr(f"min_by(x, strength) FILTER (WHERE {where})")
    listed = lambda where: F.expr(f"array_sort(collect_list(ean) FILTER (WHERE {where}))")
    out = each.groupBy(by).agg(
        first("NOT old").alias("new"), first("decides").alias("decided"), first("true").alias("any"), listed("old").alias("olds"), listed("NOT old").alias("news"), listed("true").alias("all"),
        F.count_if("decides").alias("deciding"), F.count_if(~F.col("carried") & ~F.col("decides")).alias("bridged"),
    )
    decision = F.when((F.size("olds") > 0) & (F.size("news") > 0), "repackaged").when(F.size("all") == 1, "single").when((F.col("deciding") == 1) & (F.col("bridged") == 0), "authority").otherwise("conflicted")
    out = out.withColumn("decision", decision)
    chosen = F.when(F.col("decision") == "repackaged", F.col("new")).when(F.col("deciding") == 1, F.col("decided")).otherwise(F.col("any"))
    none = F.array().cast(each.select(F.array("ean")).schema[0].dataType)
    disputed = F.when(F.col("decision") == "conflicted", F.col("all")).when((F.col("decision") == "repackaged") & (F.size("news") > 1), F.col("news")).otherwise(none)
    others = F.when(F.col("decision") == "repackaged", F.col("olds")).when(F.col("decision") == "authority", F.array_remove("all", chosen["ean"])).otherwise(none)
    return out.select(by, chosen["ean"].alias("ean"), F.when(F.size(disputed) > 0, "conflicted").otherwise(chosen["confidence"]).alias("confidence"), others.alias("others"), "decision", disputed.alias("disputed"))


def shared_eans(primary: DataFrame, by: str = "comp") -> DataFrame:
    """Barcodes of several entities, as primary or further ones, with where they are further ones."""
    # a list of both, or the decisions would be made once for each
    claims = F.concat(F.array(F.struct("ean", F.lit(False).alias("further"))), F.transform(F.coalesce("others", F.array()), lambda e: F.struct(e.alias("ean"), F.lit(True).alias("further"))))
    each = primary.select(F.col(by).alias("entity"), F.inline(claims))
    out = each.groupBy("ean").agg(F.array_sort(F.collect_set("entity")).alias("entities"), F.array_sort(F.collect_set(F.when(F.col("further"), F.col("entity")))).alias("further_in"))
    return out.where(F.size("entities") > 1)


def lifecycle(rows: DataFrame, by: str, *, miss_threshold: int = 3) -> DataFrame:
    """Per entity its status, and whether its availability is unknown for that.

    rows: kind, priority, key, archived, miss_streak, claimed (a curated row's own word on the status, or null). Archived rows and
    barcode databases tell nothing; without others the entity is discontinued. Curated rows alone are believed, current if they say
    nothing. Of scraped rows one that was missed less often than the threshold makes it current, else it is suspected to be
    discontinued. A curated word that it is discontinued or delisted comes before all that.
    """
    live = ~F.coalesce("archived", F.lit(False)) & (F.col("kind") != "barcode-db")
    scraped = live & (F.col("kind") != "curated")
    # the best of an entity's rows tells: a number, so groups are hashed; words are few, and only theirs are sorted
    rank = F.when(scraped & (F.col("miss_streak") < miss_threshold), 3).when(scraped, 2).when(live, 1).otherwise(0)
    ranks = rows.groupBy(by).agg(F.max(rank).alias("rank"))
    words = rows.where("kind = 'curated' AND claimed IS NOT NULL").groupBy(F.col(by).alias("__by")).agg(F.min_by("claimed", order()).alias("word"))
    out = ranks.join(words, F.col(by).eqNullSafe(F.col("__by")), "left")
    told = F.when(F.col("rank") == 0, "discontinued").when(F.col("rank") == 1, F.coalesce(F.nullif("word", F.lit("")), F.lit("current"))).when(F.col("rank") == 3, "current").otherwise("suspected-discontinued")
    status = F.when(F.col("word").isin("discontinued", "delisted"), F.col("word")).otherwise(told)
    return out.select(by, status.alias("status"), (told == "suspected-discontinued").alias("availability_unknown"))


def patched(base: DataFrame, patches: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """base, with the fields that a patch (key, field, value) names replaced, by null too. A patch of any other field fails the query."""
    field = F.when(F.col("field").isin(fields), F.col("field")).otherwise(F.raise_error(F.concat(F.lit("no such field: "), F.coalesce("field", F.lit("null")))))
    wide = patches.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(field.alias("field"), F.struct("value").alias("v")))).alias("__p"))
    out = base.join(wide, key, "left")
    has = lambda f: F.coalesce(F.map_contains_key("__p", F.lit(f)), F.lit(False))
    return out.withColumns({f: F.when(has(f), F.try_element_at("__p", F.lit(f))["value"].cast(dict(base.dtypes)[f])).otherwise(F.col(f)) for f in fields}).drop("__p")


def require_live_targets(retracted: DataFrame, aliases: DataFrame | None = None, joins: DataFrame | None = None) -> None:
    """Raises if an alias or a forced join leads to a retracted entity."""
    for what, of, column in (("alias", aliases, "new"), ("join", joins, "entity")):
        if of is not None and (bad := [r["entity"] for r in of.select(F.col(column).alias("entity")).join(retracted.select("entity"), "entity", "left_semi").limit(10).collect()]):
            raise ValueError(f"{what} targets are retracted: {bad}")


def category_fallback(base: DataFrame, members: DataFrame, systems: DataFrame, factions: DataFrame, by: str) -> DataFrame:
    """base, its null `system` filled from the first member, in the order of trust, whose source maps its category, and its null
    `faction` with it.

    members: source, category. systems: source, prefix (a category's part before ' - '), mapped; factions: source, category, mapped.
    Where base has a system, or no member's category is mapped, both stay.
    """
    prefix = F.split_part("category", F.lit(" - "), F.lit(1))
    mapped = members.where("category IS NOT NULL").withColumn("prefix", prefix).join(systems.select("source", "prefix", F.col("mapped").alias("__s")), ["source", "prefix"])
    mapped = mapped.join(factions.select("source", "category", F.col("mapped").alias("__f")), ["source", "category"], "left")
    trust = F.struct("priority", "superseded", "key") if "superseded" in members.columns else order()
    found = mapped.groupBy(by).agg(F.min_by(F.struct("__s", "__f"), trust).alias("__x"))
    out = base.join(found, by, "left")
    filled = F.col("system").isNull()
    return out.withColumn("faction", F.when(filled, F.coalesce("faction", "__x.__f")).otherwise(F.col("faction"))).withColumn("system", F.coalesce("system", "__x.__s")).drop("__x")


def superseded(rows: DataFrame, forced: DataFrame | Column) -> DataFrame:
    """rows (with entity), `surviving` (the code in the entity's id, if a row has it) and `superseded`: whether the row has another
    code that a forced key brought into an entity with a surviving code. forced: the keys (key), or a condition on rows.

    An entity's rows meet once, in windows that share a sort, and stay together for what is grouped by entity afterwards.
    """
    if isinstance(forced, DataFrame):
        rows, forced = rows.join(forced.select("key", F.lit(True).alias("__forced")).distinct(), "key", "left"), F.col("__forced")
    own = F.col("code").cast("string") == F.regexp_extract("entity", r"(?s)^[^/]*/(.*)$", 1)
    rows = rows.withColumn("__forced", F.coalesce(forced, F.lit(False))).repartition("entity")
    rows = rows.withColumn("__folded", F.max("__forced").over(Window.partitionBy("entity", "code"))).withColumn("surviving", F.min(F.when(own, F.col("code"))).over(Window.partitionBy("entity")))
    return rows.withColumn("superseded", F.coalesce(F.col("__folded") & (F.col("code") != F.col("surviving")), F.lit(False))).drop("__forced", "__folded")


def _few(links: DataFrame) -> DataFrame:
    """links, broadcast if they are few by count: a file's size, by which Spark would decide, is a small part of what it holds."""
    return F.broadcast(links) if at_most(links, BROADCAST_LINKS) else links.hint("merge")


def _same(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """a, with what b has of the same values, null being one, in the columns `on`."""
    b = _few(b.toDF(*(f"__{c}" if c in on else c for c in b.columns)))
    return a.join(b, reduce(and_, (a[c].eqNullSafe(b[f"__{c}"]) for c in on)), "left").drop(*(f"__{c}" for c in on))


def packed(obs: DataFrame, within: list[str] | None = None, *, by: list[str] | None = None, rows: bool = True) -> DataFrame:
    """Rows alike in manufacturer, code, barcode and the columns `within` and `by` as one, a pack.

    key, priority: its most trusted row's; __low: its least key; __members; __asserts: whether a row isn't a barcode database's. rows:
    __rows, which are their further columns, too; then a row without code and barcode is a pack by itself, or lists of such rows would grow without
    end. Left out are rows without a manufacturer, and those of barcode databases without a barcode.

    Where obs is partitioned by some of these columns, nothing is shuffled.
    """
    of = ["manufacturer", "code", "ean", *(within or [])]
    given = obs.where("manufacturer IS NOT NULL AND (ean IS NOT NULL OR kind <> 'barcode-db')")
    sums = [F.min(order()).alias("__best"), F.min("key").alias("__low"), F.count("*").alias("__members"), F.coalesce(F.bool_or(F.col("kind") != "barcode-db"), F.lit(False)).alias("__asserts")]
    keys = [*of, *(by or [])]
    if rows:
        sums.append(F.collect_list(F.struct(*(c for c in obs.columns if c not in keys))).alias("__rows"))
        given = given.withColumn("__solo", F.when(F.col("code").isNull() & F.col("ean").isNull(), F.col("key")))
    # sorted by the most distinct first
    packs = given.groupBy(*reversed(of), *(by or []), *(["__solo"] if rows else [])).agg(*sums)
    return written(packs.select(*keys, "__best.*", "__low", "__members", "__asserts", *(["__rows"] if rows else [])), "packs")


def _claims(kinds: DataFrame) -> DataFrame:
    """Of (ean, manufacturer, own, best): __owned, whether it is the one of its barcode's most trusted row."""
    first = F.row_number().over(Window.partitionBy("ean").orderBy("best")) == 1
    return written(kinds.select("ean", "manufacturer", first.alias("__owned")), "claims")


def _ties(kinds: DataFrame, claims: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(__low, comp): kinds that links of code and of owned barcode tie to one of a lesser key, with the least that they reach.

    Groups of one kind tie nothing. Where code and barcode lead to different kinds, components are sought between these.
    """
    several = lambda rows, by, name: written(rows.groupBy(*by).agg(F.min("__low").alias(name), F.count("*").alias("n")).where("n > 1").drop("n"), "groups")
    attributed, by_ean = kinds.where("manufacturer IS NOT NULL"), ["ean", "manufacturer", *(within or [])]
    codes = several(attributed.where("code IS NOT NULL"), ["manufacturer", "code"], "__c")
    eans = several(attributed.where("ean IS NOT NULL"), by_ean, "__e")
    eans = written(claims.where("__owned").select("ean", "manufacturer").join(_few(eans), ["ean", "manufacturer"]), "groups")
    found = _same(kinds.select("__low", "code", *by_ean).join(_few(codes), ["manufacturer", "code"], "left"), eans.select(*by_ean, "__e"), by_ean)
    found = written(found.where("__c IS NOT NULL OR __e IS NOT NULL").select("__low", F.coalesce("__c", "__e").alias("__c"), F.coalesce("__e", "__c").alias("__e")), "ties")
    comps = connected_components(found.select(F.col("__c").alias("a"), F.col("__e").alias("b")))
    found = found.join(_few(comps), found["__c"] == comps["id"], "left").select("__low", F.coalesce("comp", "__c").alias("comp"))
    return written(found.where("comp <> __low"), "ties")


def tied(packs: DataFrame, within: list[str] | None = None) -> tuple[DataFrame, bool]:
    """Packs that join, with comp and __alone (no code, and no barcode that its manufacturer owns: then each row is a component, and comp the
    least key); and whether a component has several packs.

    A pack's rows are all of a barcode database only if none of them, so the pack joins whole: if it asserts, or another pack of its
    manufacturer and barcode does. within: columns whose values barcode links don't cross, for barcodes that were given out again.
    """
    claims = packs.where("ean IS NOT NULL").groupBy("ean", "manufacturer").agg(F.bool_or("__asserts").alias("own"), F.min(order()).alias("best"))
    claims = _claims(claims.where("own"))
    # of most packs both is plain; only the others meet their barcode's claims
    plain = F.col("ean").isNull() | (F.col("__asserts") & F.col("code").isNotNull())
    out = packs.where(~plain).join(_few(claims), ["ean", "manufacturer"]).withColumn("__alone", F.col("code").isNull() & ~F.col("__owned")).drop("__owned")
    out = packs.where(plain).withColumn("__alone", F.col("code").isNull()).unionByName(out)
    if "__rows" not in packs.columns:
        out = written(out, "kinds")
    ties = _ties(out, claims, within)
    if at_most(ties, 0):
        return out.withColumn("comp", F.col("__low")), False
    return out.join(_few(ties), "__low", "left").withColumn("comp", F.coalesce("comp", "__low")), True


def _unpacked(packs: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """A pack's rows; one without links has its own key for comp."""
    own = [c for c in packs.columns if c in columns and c not in ORDER]
    rows = packs.select("comp", "__alone", *own, *more, F.inline("__rows"))
    return rows.select(F.when(F.col("__alone"), F.col("key")).otherwise(F.col("comp")).alias("comp"), *columns, *more)


def gathered(obs: DataFrame, within: list[str] | None = None) -> DataFrame:
    """comp, code, ean (the most trusted that are given) and rows (the further columns) of each component, linked as `linked` does."""
    packs, several = tied(packed(obs, within), within)
    whole = F.array(F.struct("comp", *ORDER, F.col("__rows").alias("rows")))
    each = F.transform("__rows", lambda r: F.struct(r["key"].alias("comp"), *(r[c].alias(c) for c in ORDER), F.array(r).alias("rows")))
    out = packs.select("code", "ean", F.inline(F.when(F.col("__alone"), each).otherwise(whole)))
    if not several:
        return out.select("comp", "code", "ean", "rows")
    first = [F.expr(f"min_by({c}, struct(priority, key)) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in ("code", "ean")]
    return out.groupBy("comp").agg(*first, F.flatten(F.collect_list("rows")).alias("rows"))


def foremost(rows: str, field: str) -> Column:
    """Of a list of rows the first value of a field that isn't null, in the order of trust."""
    given = F.filter(rows, lambda r: r[field].isNotNull())
    return F.array_min(F.transform(given, lambda r: F.struct(*(r[c].alias(c) for c in ORDER), r[field].alias("value"))))["value"]


def labelled(rows: DataFrame, within: list[str] | None = None) -> DataFrame:
    """rows with comp, the least key that links by code and by owned barcode reach; a row without links has its own. A key is one row's.

    Rows of one manufacturer, code and barcode are alike: links are found between such kinds of rows, by the least keys of a code's and
    of a barcode's rows, so components are sought only where these two differ. within: columns whose values barcode links don't cross,
    for barcodes that were given out again.
    """
    of = ["manufacturer", "code", "ean", *(within or [])]
    kinds = written(rows.groupBy(*of).agg(F.min("key").alias("__low"), F.min(order()).alias("__best")), "kinds")
    claims = _claims(kinds.where("ean IS NOT NULL").groupBy("ean", "manufacturer").agg(F.min("__best").alias("best")))
    found = kinds.join(_few(_ties(kinds, claims, within)), "__low", "left").withColumn("comp", F.coalesce("comp", "__low"))
    owned = claims.where("__owned AND manufacturer IS NOT NULL").select("ean", "manufacturer")
    coded = found.where("manufacturer IS NOT NULL AND code IS NOT NULL")
    found = coded.unionByName(found.where("code IS NULL").join(owned, ["ean", "manufacturer"], "left_semi")).select(*of, "comp")
    return _same(rows, written(found, "kinds"), of).withColumn("comp", F.coalesce("comp", "key"))


def linked(obs: DataFrame, joins: DataFrame | None = None, slug: Column | None = None, within: list[str] | None = None) -> DataFrame:
    """Joinable rows with comp: linked by code and by owned barcode. Rows are written once, since links are found in several passes."""
    if joins is None:
        given = obs if slug is None else _with_forced(obs, None).where(~_nameless(slug)).select(*obs.columns)
        return written(_unpacked(tied(packed(given, within), within)[0], obs.columns), "labelled")
    rows = joinable(obs, joins)
    if slug is not None:
        rows = _with_forced(rows, joins).where(~_nameless(slug)).select(*obs.columns)
    rows = written(rows, "joinable")
    return written(labelled(rows, within), "labelled")


def _resolved(obs: DataFrame, slug: Column, aliases: DataFrame | None, within: list[str] | None, *, rows: bool) -> DataFrame:
    """Packs of rows of one name with comp, __alone and entity, as `resolve` finds them without forced joins."""
    given = _with_forced(obs, None).where(~_nameless(slug)).select(*obs.columns, slug.alias("__slug"))
    packs, several = tied(packed(given, within, by=["__slug"], rows=rows), within)
    # rows without links of one pack have one name, so they are all led to one group or to none
    more = name_candidates(packs, F.col("__slug"), single=not several).where("targets = 1").select(F.col("comp").alias("a"), F.col("target").alias("b"))
    comps = connected_components(more).select(F.col("id").alias("comp"), F.col("comp").alias("__to"))
    if not at_most(comps, 0):
        packs, several = packs.join(_few(comps), "comp", "left").withColumns({"__alone": F.col("__alone") & F.col("__to").isNull(), "comp": F.coalesce("__to", "comp")}).drop("__to"), True
    if several:
        return packs.join(entity_ids(packs, F.col("__slug"), aliases), "comp")
    return _renamed(packs.withColumn("entity", _entity("manufacturer", "code", "__slug")), aliases)


def entities(obs: DataFrame, slug: Column, *, aliases: DataFrame | None = None, within: list[str] | None = None) -> DataFrame:
    """entity, members (rows) and first_key of what `resolve` finds without forced joins. No row is kept but for these, so packs alone are written."""
    return _resolved(obs, slug, aliases, within, rows=False).groupBy("entity").agg(F.sum("__members").alias("members"), F.min("__low").alias("first_key"))


def resolve(obs: DataFrame, slug: Column, *, aliases: DataFrame | None = None, joins: DataFrame | None = None, retracted: DataFrame | None = None, codes: DataFrame | None = None, within: list[str] | None = None) -> DataFrame:
    """Observations with comp and entity: links by code and by owned barcode, forced joins, names, then equal ids.

    Rows without a manufacturer, and those with nothing to make an id of, are left out. codes (key, code) corrects single rows.
    Barcodes link no rows that differ in the columns `within`. Groups whose forced join landed take no link by name. Aliases and joins that lead to what is retracted are refused.
    """
    if retracted is not None:
        require_live_targets(retracted, aliases, joins)
    obs = reassigned(obs, codes) if codes is not None else obs
    if joins is None:
        out = _unpacked(_resolved(obs, slug, aliases, within, rows=True), obs.columns, "entity")
    else:
        rows = linked(obs, joins, slug, within)
        moved, landed = forced_fixpoint(rows, joins, slug, aliases)
        rows = written(rows.join(moved, "comp", "left").withColumn("comp", F.coalesce("__to", "comp")).drop("__to"), "forced")
        more = name_candidates(rows, slug).where("targets = 1").select(F.col("comp").alias("a"), F.col("target").alias("b"))
        more = more.join(landed.select(F.col("comp").alias("a")), "a", "left_anti")
        comps = connected_components(more).select(F.col("id").alias("comp"), F.col("comp").alias("__to"))
        rows = rows.join(comps, "comp", "left").withColumn("comp", F.coalesce("__to", "comp")).drop("__to")
        out = rows.join(entity_ids(rows, slug, aliases), "comp")
    return out.join(retracted, "entity", "left_anti") if retracted is not None else out
