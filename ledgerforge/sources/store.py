"""What is kept of a source between runs: its evidence, its cursor, and its progress, committed together.

A run writes a new version beside the last one, then moves one pointer. Whoever reads sees one version whole; a run that dies before
the pointer moves leaves nothing but a folder that the next run replaces.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerforge.sources import files


@dataclass
class Held:
    """evidence is None, and the rest empty, where a source has not run. cursor: small values; progress: tables by name."""

    evidence: DataFrame | None = None
    cursor: dict = field(default_factory=dict)
    progress: dict[str, DataFrame] = field(default_factory=dict)
    version: int = 0


class SourceStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def load(self, source: str) -> Held:
        at = files.read_text(self.spark, f"{self.path}/{source}/CURRENT")
        if at is None:
            return Held()
        folder = f"{self.path}/{source}/v{int(at)}"
        cursor = json.loads(files.read_text(self.spark, f"{folder}/cursor.json"))
        progress = {n: self.spark.read.parquet(f"{folder}/progress/{n}") for n in files.children(self.spark, f"{folder}/progress")}
        return Held(self.spark.read.parquet(f"{folder}/evidence"), cursor, progress, int(at))

    def commit(self, source: str, evidence: DataFrame, cursor: dict, progress: dict[str, DataFrame]) -> int:
        """Writes the next version and points to it; of earlier ones the last is kept, for those who still read it. Returns its number.

        Cursors are written with sorted keys, so that equal ones are equal texts.
        """
        last = files.read_text(self.spark, f"{self.path}/{source}/CURRENT")
        version = int(last or 0) + 1
        folder = f"{self.path}/{source}/v{version}"
        files.delete(self.spark, folder)  # of a run that died
        evidence.write.parquet(f"{folder}/evidence")
        for name, table in progress.items():
            table.write.parquet(f"{folder}/progress/{name}")
        files.write_text(self.spark, f"{folder}/cursor.json", json.dumps(cursor, sort_keys=True, default=str))
        files.write_text(self.spark, f"{self.path}/{source}/CURRENT", str(version))
        for name in files.children(self.spark, f"{self.path}/{source}"):
            if name.startswith("v") and name[1:].isdigit() and int(name[1:]) < version - 1:
                files.delete(self.spark, f"{self.path}/{source}/{name}")
        return version
