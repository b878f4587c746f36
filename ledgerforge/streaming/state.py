"""Stateful operators on streams: streaks, fed micro-batch by micro-batch. The ledger that a stream feeds is in `buckets`."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Streak(StatefulProcessor):
    """Per key the sweeps missed in a row: rows (key, sweep, seen) in any order within a batch; one row out per key and batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("streak", "streak int, sweep long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        streak, last = self.state.get() if self.state.exists() else (0, -1)
        batch = pd.concat(list(rows)).sort_values(["sweep", "seen"])
        for sweep, group in batch.groupby("sweep"):
            if sweep > last:  # a sweep counts once
                streak, last = (0 if group["seen"].any() else streak + 1), int(sweep)
        self.state.update((int(streak), int(last)))
        yield pd.DataFrame({"key": [key[0]], "streak": [int(streak)], "sweep": [int(last)]})

    def close(self) -> None:
        pass


def streaks(stream: DataFrame) -> DataFrame:
    return stream.groupBy("key").transformWithStateInPandas(Streak(), "key string, streak int, sweep long", "Update", "None")
