"""State between runs: evidence, liveness, reconciliation, incremental scans, guards.

Each function takes the state and a run's rows and returns the new state; writing it is the caller's, to a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.sources.shared import written


def upsert(state: DataFrame, seen: DataFrame, key: str = "key") -> DataFrame:
    """Rows seen replace those held, but for first_seen (the earlier) and last_seen (the later); their streak of misses ends."""
    old = state.select(F.col(key).alias("__k"), F.col("first_seen").alias("__f"), F.col("last_seen").alias("__l"))
    new = seen.join(old, seen[key] == old["__k"], "left").withColumns({"first_seen": F.least("first_seen", "__f"), "last_seen": F.greatest("last_seen", "__l"), "miss_streak": F.lit(0)})
    kept = state.join(seen.select(key), key, "left_anti")
    return new.select(*state.columns).unionByName(kept)


def mark_missed(state: DataFrame, seen: DataFrame, *, full_sweep: bool, key: str = "key") -> DataFrame:
    """One more miss for what a full sweep didn't see; a partial sweep says nothing."""
    if not full_sweep:
        return state
    hit = seen.select(F.col(key).alias("__k")).distinct()
    out = state.join(hit, state[key] == hit["__k"], "left")
    return out.withColumn("miss_streak", F.when(F.col("__k").isNull(), F.col("miss_streak") + 1).otherwise(F.col("miss_streak"))).select(*state.columns)


def miss_streaks(sweeps: DataFrame, seen: DataFrame) -> DataFrame:
    """key, streak: listed sweeps since a key was last seen, over a history of sweeps (sweep) and sightings (key, sweep).

    A key whose last sighting is of no listed sweep counts those after it.
    """
    last = seen.groupBy("key").agg(F.max("sweep").alias("last"))
    listed = sweeps.select(F.col("sweep").alias("last"), F.lit(1).alias("n")).unionByName(last.select("last", F.lit(0).alias("n"))).groupBy("last").agg(F.max("n").alias("n"))
    later = Window.orderBy(F.desc("last")).rowsBetween(Window.unboundedPreceding, -1)  # one row a sweep
    since = listed.select("last", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("streak"))
    return last.join(since, "last").select("key", "streak")


def liveness(records: DataFrame, seen: DataFrame, sources: DataFrame, threshold: int = 3) -> DataFrame:
    """records (path, source, last_seen, miss_streak, flagged) after a run: of sources that failed they stay; of others, seen ones
    start anew and unseen ones miss once more. `event`: flag when a streak reaches the threshold (once), reactivate when a flagged one is seen.
    """
    out = records.join(sources.select("source", "succeeded", "run_date"), "source", "left")
    hit = seen.select(F.col("path").alias("__p")).distinct()
    out = out.join(hit, out["path"] == hit["__p"], "left")
    ran, found = F.coalesce("succeeded", F.lit(False)), F.col("__p").isNotNull()
    streak = F.when(~ran, F.col("miss_streak")).when(found, 0).otherwise(F.col("miss_streak") + 1)
    out = out.withColumn("__s", streak).withColumn("event", F.when(ran & found & F.col("flagged"), "reactivate").when(ran & ~found & (F.col("__s") == threshold), "flag"))
    return out.select("path", "source", F.when(ran & found, F.col("run_date")).otherwise(F.col("last_seen")).alias("last_seen"), F.col("__s").alias("miss_streak"), F.when(F.col("event") == "flag", True).when(F.col("event") == "reactivate", False).otherwise(F.col("flagged")).alias("flagged"), "event")


def status_after(status: Column, availability: Column, event: Column) -> tuple[Column, Column]:
    """Status and availability by a liveness event: only current becomes suspected, only suspected becomes current."""
    flags = (event == "flag") & (status == "current")
    back = (event == "reactivate") & (status == "suspected-discontinued")
    new = F.when(flags, "suspected-discontinued").when(back, "current").otherwise(status)
    return new, F.when(flags, "unknown").otherwise(availability)


def implausible_drop(now: Column, before: Column, share: float = 0.5) -> Column:
    return F.coalesce(now < share * before, F.lit(False))


def without_orphans(records: DataFrame, paths: DataFrame, healthy: DataFrame, *, full_run: bool) -> DataFrame:
    """Records of healthy sources whose path is gone are dropped, on full runs only."""
    if not full_run:
        return records
    gone = records.join(healthy.select("source"), "source", "left_semi").join(paths.select("path"), "path", "left_anti").select("path")
    return records.join(gone, "path", "left_anti")


def _granted(wishes: DataFrame) -> DataFrame:
    """key, target: what keys get in their order, each the first of its wishes (key, way, target) that is left.

    Round by round every key asks for its next wish, and a target keeps the smallest key that asked; who is turned away asks again. As
    all targets prefer smaller keys, that is what one key after another would have got.
    """
    wishes = wishes.groupBy("key").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("way", "target"))), lambda x: x["target"])).alias("wishes")).withColumn("at", F.lit(1))
    while True:
        wishes = written(wishes, "wishes")
        kept = wishes.select("key", F.try_element_at("wishes", F.col("at")).alias("target")).where("target IS NOT NULL").groupBy("target").agg(F.min("key").alias("key"))
        again = wishes.where(F.col("at") <= F.size("wishes")).join(kept.select("key"), "key", "left_anti")
        if not again.limit(1).count():
            return kept.select("key", "target")
        wishes = wishes.join(again.select("key", F.lit(1).alias("__more")), "key", "left").withColumn("at", F.col("at") + F.coalesce("__more", F.lit(0))).drop("__more")


def reconcile(archive: DataFrame, incoming: DataFrame, aliases: DataFrame, retracted: DataFrame) -> DataFrame:
    """The archive after a run: key, url, name, status, first_seen.

    Incoming rows that are retracted don't count, and of rows with equal keys the first by URL and name does. A row with an archived key
    merges into it; else it renames the archived row that has its URL, or, if a smaller key has taken that one, the row that its alias
    names, if no smaller key has; else it is new. What is retracted is never renamed. Names are filled if blank, status
    only moves away from current, the first date stays. What isn't seen stays; what is retracted goes.
    """
    new = incoming.join(retracted, "key", "left_anti")
    new = new.groupBy("key").agg(F.min_by(F.struct(*new.columns), F.struct(F.coalesce("url", F.lit("")), F.coalesce("name", F.lit("")))).alias("x")).select("x.*")
    by_key = new.join(archive.select("key"), "key", "left_semi").withColumn("target", F.col("key"))
    rest = new.join(archive.select("key"), "key", "left_anti")
    free = archive.join(by_key.select("key"), "key", "left_anti").join(retracted, "key", "left_anti")

    url_wish = rest.where("url IS NOT NULL").join(free.where("url IS NOT NULL").groupBy("url").agg(F.min("key").alias("target")), "url").select("key", F.lit(0).alias("way"), "target")
    alias_wish = rest.join(aliases.select(F.col("new").alias("key"), F.col("old").alias("target")), "key").join(free.select(F.col("key").alias("target")), "target", "left_semi").select("key", F.lit(1).alias("way"), "target")
    taken = _granted(url_wish.unionByName(alias_wish))
    renamed = rest.join(taken, "key")
    fresh = rest.join(taken, "key", "left_anti").withColumn("target", F.lit(None).cast(dict(archive.dtypes)["key"]))
    hits = by_key.select(*new.columns, "target").unionByName(renamed.select(*new.columns, "target")).unionByName(fresh.select(*new.columns, "target"))
    old = archive.select(F.col("key").alias("__k"), F.col("url").alias("__u"), F.col("name").alias("__n"), F.col("status").alias("__s"), F.col("first_seen").alias("__f"))
    out = hits.join(old, hits["target"] == old["__k"], "left")
    blank = lambda c: F.when(F.trim(c) != "", c)
    ends = F.col("status").isin("discontinued", "delisted")
    out = out.select("key", F.coalesce(blank(F.col("url")), "__u").alias("url"), F.coalesce(blank(F.col("name")), "__n").alias("name"), F.when(ends | F.col("__s").isNull(), F.col("status")).otherwise(F.col("__s")).alias("status"), F.coalesce("__f", "first_seen").alias("first_seen"))
    kept = archive.join(hits.where("target IS NOT NULL").select(F.col("target").alias("key")), "key", "left_anti").join(retracted, "key", "left_anti")
    return out.unionByName(kept.select(*out.columns))


def auto_aliases(archive: DataFrame, incoming: DataFrame, explicit: DataFrame) -> DataFrame:
    """new, old: a row that has got its hex value is the one without; a hand-made alias comes first."""
    made = incoming.where("hex IS NOT NULL").select(F.col("key").alias("new"), F.col("stem")).join(archive.where("hex IS NULL").select(F.col("key").alias("__old"), "stem"), "stem").groupBy("new").agg(F.min("__old").alias("__old"))
    both = made.join(explicit.select("new", "old"), "new", "full")
    return both.select("new", F.coalesce("old", "__old").alias("old"))


def detail_queue(items: DataFrame, state: DataFrame, budget: int, cap: int = 3) -> DataFrame:
    """key, reason: what to fetch within a budget: new items, then changed or incomplete ones with misses under the cap, then the stalest."""
    s = state.select(F.col("key").alias("__k"), F.col("updated_at").alias("__u"), "value", "misses", "fetched")
    q = items.join(s, items["key"] == s["__k"], "left")
    changed = F.col("updated_at") != F.col("__u")
    reason = F.when(F.col("__k").isNull(), 0).when(changed | (F.col("value").isNull() & (F.col("misses") < cap)), 1).when(F.col("value").isNotNull(), 2)
    q = q.withColumn("reason", reason).where("reason IS NOT NULL")
    return q.orderBy("reason", F.col("fetched").asc_nulls_first(), "key").limit(budget).select("key", "reason")


def barcode_queue(items: DataFrame, state: DataFrame, pending: DataFrame, budget: int | None, cap: int = 3) -> DataFrame:
    """key, reason: which details to fetch within a budget: new items (0), those without a barcode and with misses under the cap, or still
    pending (1), those that changed since (2), the longest known first. Known barcodes of unchanged items aren't fetched again."""
    s = state.select(F.col("key").alias("__k"), F.col("updated_at").alias("__u"), "value", "misses")
    q = items.join(s, items["key"] == s["__k"], "left").join(pending.select("key", F.lit(True).alias("__p")).distinct(), "key", "left")
    reason = F.when(F.col("__k").isNull() & F.col("__p").isNull(), 0).when(F.col("__k").isNull(), 1).when(F.col("updated_at") > F.coalesce("__u", F.lit("")), 2).when(F.col("value").isNull() & (F.coalesce("misses", F.lit(0)) < cap), 1)
    q = q.withColumn("reason", reason).where("reason IS NOT NULL").orderBy("reason", F.when(F.col("reason") == 2, F.coalesce("__u", F.lit(""))), "key")
    return (q if budget is None else q.limit(max(budget, 0))).select("key", "reason")


def carried(state: DataFrame, fetched: DataFrame, items: DataFrame) -> DataFrame:
    """state after fetches (key, ok, value): errors change nothing, a success without a value is a miss, a changed item counts anew."""
    f = fetched.select(F.col("key").alias("__k"), "ok", F.col("value").alias("__v"))
    out = items.select("key", F.col("updated_at").alias("__n")).join(state, "key", "left").join(f, F.col("key") == F.col("__k"), "left")
    ok = F.coalesce("ok", F.lit(False))
    anew = F.coalesce(F.col("updated_at") != F.col("__n"), F.lit(True))
    base = F.when(anew, 0).otherwise(F.coalesce("misses", F.lit(0)))
    return out.select("key", F.when(ok, F.col("__n")).otherwise(F.coalesce("updated_at", "__n")).alias("updated_at"), F.when(ok & F.col("__v").isNotNull(), F.col("__v")).otherwise(F.col("value")).alias("value"), F.when(ok & F.col("__v").isNotNull(), 0).when(ok, base + 1).otherwise(F.coalesce("misses", F.lit(0))).alias("misses"))


def batches(rows: DataFrame, order: list[Column], size: int, budget: int) -> DataFrame:
    """The first `budget` batches of `size` rows, with their batch."""
    head = rows.orderBy(*order).limit(size * budget)
    n = F.row_number().over(Window.orderBy(*order))  # a budget's rows only
    return head.withColumn("batch", F.floor((n - 1) / size))


def due(last: Column, run_date: Column, days: int) -> Column:
    """Whether a listing is to be enumerated again: never done, or so many days ago."""
    return F.coalesce(F.datediff(run_date, last) >= days, F.lit(True))


def paging(captures: DataFrame, *, most_rows: int | None = None, most_pages: int | None = None) -> DataFrame:
    """slice, rows, next_page, state of listings by their captured pages (slice, page from 1, rows, reported: how many pages the platform
    says, or null): 'done' at a page without rows or at the last reported one, 'capped' where the platform gives no more, else 'open'.

    What counts are the pages before the first that is missing, which is the next one: a page that failed is asked again.
    """
    pages = captures.groupBy("slice", "page").agg(F.max("rows").alias("rows"), F.max("reported").alias("reported"))
    after = pages.select("slice", (F.col("page") + 1).alias("page")).unionByName(pages.select("slice", F.lit(1).cast(pages.schema["page"].dataType).alias("page")).distinct())
    gap = after.join(pages.select("slice", "page"), ["slice", "page"], "left_anti").groupBy("slice").agg(F.min("page").alias("next_page"))
    seen = pages.join(gap, "slice").where(F.col("page") < F.col("next_page"))
    sums = seen.groupBy("slice").agg(F.sum("rows").alias("rows"), F.max("reported").alias("reported"), F.bool_or(F.col("rows") == 0).alias("empty"))
    out = gap.join(sums, "slice", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
    done = F.coalesce("empty", F.lit(False)) | F.coalesce(F.col("next_page") > F.col("reported"), F.lit(False))
    capped = F.lit(False)
    if most_rows is not None:
        capped = capped | (F.col("rows") >= most_rows)
    if most_pages is not None:
        capped = capped | (F.col("next_page") > most_pages)
    state = F.when(done, "done").when(capped, "capped").otherwise("open")
    return out.select("slice", "rows", F.when(state == "open", F.col("next_page")).alias("next_page"), state.alias("state"))


def full_sweep(pending: DataFrame, *, capped: bool = False, walks: DataFrame | None = None) -> bool:
    """Whether a run saw all that its source has: nothing is pending, no listing was capped, and (walks, as paging gives them) all were walked to their end."""
    return not capped and not pending.limit(1).count() and (walks is None or not walks.where("state <> 'done'").limit(1).count())
