"""One run of one source: observations, contract, then state; nothing is written if the contract is broken."""

from __future__ import annotations

import inspect
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.operators import ledger, quality
from ledgerforge.sources import paint_shops
from ledgerforge.sources.store import SourceStore
from ledgerforge.sources.strategies import STRATEGIES, SWEEPS

__all__ = ["Contract", "Outcome", "Source", "paint_shops", "run", "run_source"]


@dataclass
class Contract:
    min_count: int = 0
    max_drop_pct: float = 100.0
    rates: dict[str, float] = field(default_factory=dict)


@dataclass
class Source:
    """A source's descriptor. options are the strategy's own: vendors, manufacturers, prefixes and the like."""

    id: str
    strategy: str
    options: dict = field(default_factory=dict)
    contract: Contract = field(default_factory=Contract)


@dataclass
class Outcome:
    source: str
    ok: bool
    count: int
    failed: list[str]
    state: DataFrame
    full_sweep: bool = False
    counters: dict[str, int] = field(default_factory=dict)


def dated(seen: DataFrame, run_date: str) -> DataFrame:
    """Observations as the ledger holds them."""
    day = F.lit(run_date).cast("date")
    return seen.withColumns({"first_seen": day, "last_seen": day, "miss_streak": F.lit(0)})


def run_source(
    payloads: DataFrame, strategy: str, source: str, state: DataFrame | None, run_date: str, contract: Contract, *, full_sweep: bool | None = None, complete: bool = True, last_good: int = 0, options: dict | None = None
) -> Outcome:
    """Applies a strategy and, if its rows keep the contract, returns the new state; a broken one leaves the state alone.

    Whether the run is a full sweep is the strategy's to say; for most it depends on whether everything was fetched that had to be
    (complete). The drop against the last good count is judged on full sweeps only, and not against nothing. Rates are judged on any
    run that observed something. Without a state the source has none yet.
    """
    if full_sweep is None:
        full_sweep = SWEEPS[strategy] == "full" or SWEEPS[strategy] == "complete" and complete
    seen = STRATEGIES[strategy](payloads, source, **(options or {}))
    state = dated(seen, run_date).limit(0) if state is None else state
    metrics = quality.contract_metrics(seen.withColumn("source", F.lit(source)), ["source"], list(contract.rates) or ["name"])
    row = metrics.first()
    count = row["n"] if row else 0
    failed = ["min_count"] * (count < contract.min_count) + [f for f, r in contract.rates.items() if row and row[f"rate_{f}"] < r]
    if full_sweep and last_good and 100.0 * (last_good - count) > contract.max_drop_pct * last_good:
        failed.append("drop")
    if failed:
        return Outcome(source, False, count, failed, state, full_sweep)
    new = ledger.upsert(state, dated(seen, run_date).select(*state.columns))
    return Outcome(source, True, count, [], ledger.mark_missed(new, seen, full_sweep=full_sweep), full_sweep)


def merged_progress(old: DataFrame | None, new: DataFrame, keep: DataFrame | None) -> DataFrame:
    """Rows by their first column: new ones replace old ones; of those the ones that keep's only column doesn't list go."""
    key = new.columns[0]
    if old is None:
        return new if keep is None else new.join(keep.toDF(key), key, "left_semi")
    both = new.unionByName(old.join(new.select(key), key, "left_anti").select(*new.columns))
    return both if keep is None else both.join(keep.toDF(key).distinct(), key, "left_semi")


def run(store: SourceStore, source: Source, payloads: DataFrame, run_date: str, *, complete: bool = True, progress: dict[str, DataFrame] | None = None, keep: dict[str, DataFrame] | None = None) -> Outcome:
    """Runs a source with what the store holds of it, and commits evidence, cursor and progress in one step; a broken contract commits nothing.

    progress: what this run learnt, by name, keyed by its first column: dates of fetched pages, barcodes that details gave. It is merged
    into what is held, and what keep doesn't list any more goes. A strategy that takes an option of a progress table's name gets it.
    """
    held, progress = store.load(source.id), progress or {}
    tables = {**held.progress, **{n: merged_progress(held.progress.get(n), t, (keep or {}).get(n)) for n, t in progress.items()}}
    takes = inspect.signature(STRATEGIES[source.strategy]).parameters
    options = {**{n: t for n, t in tables.items() if n in takes}, **source.options}
    if "run_date" in takes:
        options.setdefault("run_date", run_date)
    out = run_source(payloads, source.strategy, source.id, held.evidence, run_date, source.contract, complete=complete, last_good=held.cursor.get("last_good_count") or 0, options=options)
    if not out.ok:
        return out
    last_good = out.count if out.full_sweep else held.cursor.get("last_good_count")
    cursor = {**held.cursor, "last_run_date": run_date, "last_good_count": last_good}
    store.commit(source.id, out.state, cursor, tables)
    out.state = store.load(source.id).evidence
    before = held.evidence.count() if held.evidence is not None else 0
    now = out.state.agg(F.count("*").alias("n"), F.count_if(F.col("miss_streak") > 0).alias("missed")).first()
    out.counters = {"observed": out.count, "added": now["n"] - before, "missed": now["missed"], "held": now["n"]}
    return out
