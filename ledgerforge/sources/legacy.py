"""Old trees of hand-kept YAML: whatever can be read of them, row by row, and the rest with its reason."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources.yaml_text import emit, parse

ROW = "file string, place int, fields map<string,string>, reason string, text string"


def items_of(text: str) -> list[str]:
    """The texts of a list's items, one below the other; what stands before the first is an item too, if it says something."""
    out: list[list[str]] = [[]]
    for line in text.split("\n"):
        if line.startswith(("- ", "-\t")) or line == "-":
            out.append([])
        out[-1].append(line)
    whole = ["\n".join(x) for x in out]
    said = lambda x: any(y.strip() and not y.lstrip().startswith("#") and y.strip() != "---" for y in x.split("\n"))
    return [x for x in whole if said(x)]


def read_item(text: str, required: list[str]) -> tuple[dict[str, str] | None, str | None]:
    """The fields of an item as texts, numbers as they are written, or the reason why it has none.

    Tabs are read as spaces. Lists and maps within an item are kept as YAML.
    """
    try:
        value = parse(text.replace("\t", " "), verbatim=True)
    except (ValueError, IndexError) as e:
        return None, f"unreadable: {str(e)[:200]}"
    value = value[0] if isinstance(value, list) and len(value) == 1 else value
    if not isinstance(value, dict):
        return None, "no map"
    plain = {True: "true", False: "false"}
    fields = {str(k): plain[v] if isinstance(v, bool) else v if isinstance(v, str) else "\n".join(emit(v)) for k, v in value.items() if v is not None}
    missing = [k for k in required if not fields.get(k, "").strip()]
    return (None, f"without {', '.join(missing)}") if missing else (fields, None)


def read_legacy(spark: SparkSession, path: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, place, fields) of all items in path's .yaml files that can be read and have the required fields, and (file, place, reason,
    text) of all others. Together they are all items: a broken one costs no other.

    file is the path under the folder, place counts a file's items from 1. A file is a row, as it is one text.
    """
    root = path.rstrip("/")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.y*ml").text(root, wholetext=True)
    tail = root.rpartition("/")[2]
    files = files.select(F.substring_index(F.col("_metadata.file_path"), f"/{tail}/", -1).alias("file"), "value")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for place, item in enumerate(items_of(text or ""), 1):
                    fields, reason = read_item(item, required)
                    out.append((name, place, None if fields is None else list(fields.items()), reason, item))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in ROW.split(", ")])

    rows = files.mapInArrow(read, ROW)
    return rows.where("reason IS NULL").select("file", "place", "fields"), rows.where("reason IS NOT NULL").select("file", "place", "reason", "text")
