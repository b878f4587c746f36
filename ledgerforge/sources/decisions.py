"""A log of decisions that were asked for once: appended, compacted, and replayed without asking again.

Each line is one decision about an input, known by a hash of all that was asked. Lines carry the run that wrote them and their place in
it, so whatever is repeated, in whatever file, the last decision on an input is the same.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources import files

SCHEMA = "input string, run long, place long, item string, choice string, confidence double"


class DecisionLog:
    """path/log: appended files; path/compacted: tables of last decisions; path/CURRENT: the table that counts, and the files it has."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, rows: DataFrame) -> None:
        """Appends decisions (SCHEMA's columns); a run whose append is repeated repeats its lines, which changes nothing."""
        rows.select(F.to_json(F.struct(*(x.split()[0] for x in SCHEMA.split(", ")))).alias("value")).write.text(f"{self.path}/log/{uuid.uuid4().hex}")

    def _state(self) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/CURRENT") or '{"version": 0, "has": []}')

    def _lines(self, names: list[str]) -> DataFrame:
        return self.spark.read.text([f"{self.path}/log/{n}" for n in names]).select("value", F.from_json("value", SCHEMA).alias("x"))

    def _open(self, state: dict) -> list[str]:
        """The appended folders that were finished and that no compaction has."""
        names = [n for n in files.children(self.spark, f"{self.path}/log") if n not in state["has"]]
        return [n for n in names if any(not f.startswith(("_", ".")) for f in files.children(self.spark, f"{self.path}/log/{n}"))]

    def last(self) -> DataFrame:
        """The last decision on each input, by run and place. Lines that were cut off are none."""
        state = self._state()
        parts, names = [], self._open(state)
        if names:
            parts.append(self._lines(names).where("x.input IS NOT NULL").select("x.*"))
        if state["version"]:
            parts.append(self.spark.read.parquet(f"{self.path}/compacted/v{state['version']}"))
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows.groupBy("input").agg(F.max(F.struct("run", "place", "item", "choice", "confidence")).alias("x")).select("input", "x.*")

    def torn(self) -> DataFrame:
        """value: the lines since the last compaction that can't be read."""
        names = self._open(self._state())
        return self._lines(names).where("x.input IS NULL AND trim(value) <> ''").select("value") if names else self.spark.createDataFrame([], "value string")

    def compact(self) -> None:
        """Writes the last decisions as one table, points to it, and then deletes the files that it has."""
        state = self._state()
        names = self._open(state)
        if not names:
            return
        version = state["version"] + 1
        files.delete(self.spark, f"{self.path}/compacted/v{version}")  # of a compaction that died
        self.last().write.parquet(f"{self.path}/compacted/v{version}")
        left = [n for n in state["has"] if files.exists(self.spark, f"{self.path}/log/{n}")]
        files.write_text(self.spark, f"{self.path}/CURRENT", json.dumps({"version": version, "has": sorted({*left, *names})}))
        for n in {*left, *names}:
            files.delete(self.spark, f"{self.path}/log/{n}")
        files.delete(self.spark, f"{self.path}/compacted/v{version - 1}")

    def pending(self, candidates: DataFrame) -> DataFrame:
        """The candidates (input and others) that nobody has decided on."""
        return candidates.join(self.last().select("input"), "input", "left_anti")

    def accepted(self, candidates: DataFrame, least: float = 0.8) -> DataFrame:
        """The candidates with choice and confidence of their last decision, if that is confident enough: made again from the log alone.

        A null choice clears. A decision on another input, however alike, says nothing.
        """
        said = self.last().where(F.col("confidence") >= least).select("input", "choice", "confidence")
        return candidates.join(said, "input")
