"""A Spark data source of captured responses: pages of a platform, read from files as if they were fetched.

    spark.dataSource.register(Captures)
    spark.read.format("captures").load("/folder")     # url, status, body
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Captures(DataSource):
    """One row per file of a folder that all executors see; the file's path under it is the URL's path. Missing folders are empty."""

    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return "url string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options.get("path", ""), self.options.get("baseurl", "https://example.org"), int(self.options.get("perpartition", "64")))


class _Reader(DataSourceReader):
    def __init__(self, path: str, base: str, per: int):
        self.path, self.base, self.per = path, base, per

    def partitions(self) -> list[InputPartition]:
        files = sorted(os.path.join(d, f) for d, _, names in os.walk(self.path) for f in names)
        return [InputPartition(files[k : k + self.per]) for k in range(0, len(files), self.per)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for f in partition.value:
            with open(f, encoding="utf-8", errors="replace") as body:
                yield f"{self.base}/{os.path.relpath(f, self.path)}", 200, body.read()


def backoff(attempt: int, status: int, retry_after: float | None = None, *, attempts: int = 3, longest: float = 30.0) -> float | None:
    """Seconds to wait before the next attempt (from 1), None to give up: twice as long each time, as told, and never over `longest` when limited."""
    if attempt >= attempts or status not in (429, 500, 502, 503, 504):
        return None
    wait = retry_after if retry_after is not None else float(2**attempt)
    return min(wait, longest) if status == 429 else wait
