"""YAML documents as text: what catalogs, manifests and cursors are kept in. A small, fixed form of it, written and read back.

Block maps and lists with two spaces a level, keys as they come, nulls left out, no anchors. Texts are quoted where a reader could take
them for something else; texts of several lines are block literals. Also read: comments, quoted texts, and lists and maps in brackets.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_PLAIN = re.compile(r"[^\s\-?:,\[\]{}#&*!|>'\"%@`=~][^\n]*")
#: What a reader takes for a number, a truth value, a date or nothing.
_OTHER = re.compile(r"(?i)[-+]?(\d[\d_,.:]*(e[-+]?\d+)?|\.\d+|0x[0-9a-f]+|0o?[0-7]+|\.inf|\.nan)|true|false|yes|no|on|off|y|n|null|~|\d{4}-\d{1,2}-\d{1,2}.*")


_INT, _FLOAT = re.compile(r"[-+]?(0|[1-9][0-9]*)"), re.compile(r"[-+]?(\.[0-9]+|(0|[1-9][0-9]*)(\.[0-9]*)?)([eE][-+]?[0-9]+)?")
_SPECIAL = {".nan": float("nan"), ".inf": float("inf"), "+.inf": float("inf"), "-.inf": float("-inf")}


def _a_number(x: str) -> bool:
    """Whether some reader takes a text for a number."""
    try:
        float(x)
    except ValueError:
        return False
    return True


def scalar(x: object) -> str:
    if x is None:
        return "null"
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf"))):
        return next(k for k, v in _SPECIAL.items() if repr(v) == repr(x))
    if isinstance(x, int | float):
        return repr(x)
    x = str(x)
    plain = _PLAIN.fullmatch(x) and not _OTHER.fullmatch(x) and not _a_number(x) and ": " not in x and " #" not in x and x == x.strip() and not x.endswith(":") and x.isprintable()
    return x if plain else json.dumps(x, ensure_ascii=False)


def _literal(x: object, pad: str) -> list[str] | None:
    """The lines of a block literal, its mark first; None if a text isn't one: of one line, or with lines that wouldn't come back."""
    if not isinstance(x, str) or "\n" not in x:
        return None
    body, end = x.rstrip("\n"), len(x) - len(x.rstrip("\n"))
    lines = body.split("\n")
    if not body or lines[0][:1] in ("", " ") or any(not line.isprintable() for line in lines):
        return None
    return [("|-", "|", "|+")[min(end, 2)], *(pad + line if line else "" for line in lines), *[""] * max(0, end - 1)]


def emit(x: object, level: int = 0) -> list[str]:
    """The lines of a map, list or scalar."""
    pad = "  " * level
    if isinstance(x, dict):
        out = []
        for k, v in x.items():
            if v is None:
                continue
            if lines := _literal(v, pad + "  "):
                out += [f"{pad}{scalar(k)}: {lines[0]}", *lines[1:]]
                continue
            nested = isinstance(v, dict | list) and len(v)
            out += [f"{pad}{scalar(k)}:", *emit(v, level + 1)] if nested else [f"{pad}{scalar(k)}: {emit(v)[0] if isinstance(v, dict | list) else scalar(v)}"]
        return out or [f"{pad}{{}}"]
    if isinstance(x, list):
        out = []
        for v in x:
            lines = _literal(v, pad + "  ") or emit(v, level + 1)
            out += [f"{pad}- {lines[0].strip()}", *lines[1:]]
        return out or [f"{pad}[]"]
    return [f"{pad}{scalar(x)}"]


def sorted_keys(x: object) -> object:
    """The value with the keys of all its maps in order."""
    return {k: sorted_keys(x[k]) for k in sorted(x)} if isinstance(x, dict) else [sorted_keys(v) for v in x] if isinstance(x, list) else x


def _quoted(text: str) -> int:
    """The length of the quoted text that a text begins with, 0 if there is none."""
    m = re.match(r'"(?:[^"\\]|\\.)*"|\'(?:[^\']|\'\')*\'', text)
    return m.end() if m else 0


def _value(text: str, verbatim: bool = False) -> object:
    if n := _quoted(text):
        if text[n:].strip() and not text[n:].lstrip().startswith("#"):
            raise ValueError(f"can't read {text!r}")
        return json.loads(text[:n]) if text[0] == '"' else text[1 : n - 1].replace("''", "'")
    if text[:1] in ('"', "'"):
        raise ValueError(f"a quote that doesn't end: {text!r}")
    if text[:1] in ("[", "{"):
        value, rest = _flow(text, verbatim)
        if rest.strip() and not rest.lstrip().startswith("#"):
            raise ValueError(f"can't read {text!r}")
        return value
    text = re.split(r"(?:^|\s)#", text)[0].strip()  # a comment begins behind white space
    if text in ("null", "~", ""):
        return None
    if text in ("true", "false"):
        return text == "true"
    if verbatim:
        return text
    if text.lower() in _SPECIAL:
        return _SPECIAL[text.lower()]
    return int(text) if _INT.fullmatch(text) else float(text) if _FLOAT.fullmatch(text) else text


def _flow(text: str, verbatim: bool = False) -> tuple[object, str]:
    """The value in brackets that a text begins with, and what follows it."""
    closing, out, pairs = "]" if text[0] == "[" else "}", [], {}
    rest = text[1:].lstrip()
    while not rest.startswith(closing):
        if not rest:
            raise ValueError(f"can't read {text!r}")
        key = None
        if closing == "}":
            n = _quoted(rest)
            key, _, rest = (_value(rest[:n]), "", rest[n:].lstrip().removeprefix(":")) if n else rest.partition(":")
            key, rest = key.strip() if isinstance(key, str) else key, rest.lstrip()
        if rest[:1] in ("[", "{"):
            value, rest = _flow(rest, verbatim)
        else:
            n = _quoted(rest) or re.match(r"[^,\[\]{}]*", rest).end()
            value, rest = _value(rest[:n].strip(), verbatim), rest[n:]
        out.append(value)
        pairs[key] = value
        rest = rest.lstrip().removeprefix(",").lstrip()
    return (out if closing == "]" else pairs), rest[1:]


_KEY = re.compile(r'("(?:[^"\\]|\\.)*"|\'(?:[^\']|\'\')*\'|[^\s"\'\[{#].*?)\s*:(?:\s+(.*))?')
_LITERAL = re.compile(r"(.*(?::|-)\s+)\|([-+]?)\s*(?:#.*)?")


def _lines(text: str) -> list[tuple[int, str]]:
    """Indentation and text of each line that says something; block literals as quoted texts on the line of their mark."""
    raw, out, at = text.split("\n"), [], 0
    while at < len(raw):
        line, depth = raw[at], len(raw[at]) - len(raw[at].lstrip(" "))
        at += 1
        if not line.strip() or line.lstrip().startswith("#") or line.strip() == "---":
            continue
        if m := _LITERAL.fullmatch(line.strip()):
            dashes = re.match(r"(?:- +)*", m[1]).end()
            base = depth + dashes - 2 * (dashes == len(m[1]))  # where the list or map is that holds the text
            held = []
            while at < len(raw) and (not raw[at].strip() or len(raw[at]) - len(raw[at].lstrip(" ")) > base):
                held.append(raw[at])
                at += 1
            if at == len(raw) and held and not held[-1]:
                held.pop()  # the text's own last line end
            inner = next((len(x) - len(x.lstrip(" ")) for x in held if x.strip()), 0)
            body = "\n".join(x[inner:] for x in held) + "\n"
            body = body if m[2] == "+" else body.rstrip("\n") + ("" if m[2] == "-" else "\n")
            line = line[:depth] + m[1] + json.dumps(body)
        out.append((depth, line.strip()))
    return out


def parse(text: str, *, verbatim: bool = False) -> object:
    """The value of a document in this form; comments and document marks are passed over. verbatim: numbers are kept as they are written."""
    lines = _lines(text)
    at = 0

    def block(indent: int) -> object:
        nonlocal at
        if lines[at][1].startswith("- ") or lines[at][1] == "-":
            out: list = []
            while at < len(lines) and lines[at][0] == indent and (lines[at][1].startswith("- ") or lines[at][1] == "-"):
                rest = lines[at][1][1:].strip()
                if not rest:
                    at += 1
                    out.append(block(lines[at][0]) if at < len(lines) and lines[at][0] > indent else None)
                elif _KEY.fullmatch(rest) or rest.startswith("- "):
                    lines[at] = (indent + 2, rest)
                    out.append(block(indent + 2))
                else:
                    at += 1
                    out.append(_value(rest, verbatim))
            return out
        if not _KEY.fullmatch(lines[at][1]):
            at += 1
            return _value(lines[at - 1][1], verbatim)
        found: dict = {}
        while at < len(lines) and lines[at][0] == indent and (m := _KEY.fullmatch(lines[at][1])):
            key, rest = _value(m[1], verbatim), m[2]
            at += 1
            if rest and not rest.startswith("#"):
                found[key] = _value(rest, verbatim)
            elif at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("- ")):
                found[key] = block(lines[at][0])
            else:
                found[key] = None
        return found

    value = block(lines[0][0]) if lines else None
    if at < len(lines):
        raise ValueError(f"can't read {lines[at][1]!r}")
    return value


@F.pandas_udf(StringType())
def yaml_of(bodies: pd.Series) -> pd.Series:
    """YAML of JSON texts, keys in their order."""
    return bodies.map(lambda x: None if x is None else "\n".join(emit(json.loads(x))) + "\n")


@F.pandas_udf(StringType())
def sorted_yaml_of(bodies: pd.Series) -> pd.Series:
    """YAML of JSON texts, keys of all maps sorted."""
    return bodies.map(lambda x: None if x is None else "\n".join(emit(sorted_keys(json.loads(x)))) + "\n")


@F.pandas_udf(StringType())
def json_of(bodies: pd.Series) -> pd.Series:
    """JSON of YAML texts in this form."""
    return bodies.map(lambda x: None if x is None else json.dumps(parse(x), ensure_ascii=False))


def partition_documents(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """partition, body: a list of each partition's rows in order as one document, nulls left out. A partition must fit a task, as its file."""
    fields = [c for c in rows.columns if c != partition]
    listed = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("__row")))), lambda x: x["__row"])
    return rows.groupBy(F.col(partition).alias("partition")).agg(yaml_of(F.to_json(listed)).alias("body"))


def write_yaml(docs: DataFrame, path: str) -> None:
    """Documents (partition, body), one text file in a folder for each partition."""
    docs.select("partition", F.rtrim("body", F.lit("\n")).alias("value")).repartition("partition").write.mode("overwrite").partitionBy("partition").text(path)


def read_yaml(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole documents of a folder's files as rows of a schema, one a document or, of lists, one an item, with `partition` (or stem)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path_, body in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                value = parse(body)
                out += [(path_, json.dumps(x, ensure_ascii=False)) for x in (value if isinstance(value, list) else [value]) if x is not None]
            columns = list(zip(*out, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "item"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = files.mapInArrow(read, "path string, item string").select("path", F.from_json("item", schema, {"mode": "FAILFAST"}).alias("x"))
    name = F.coalesce(F.nullif(F.regexp_extract("path", r"/partition=([^/]+)/", 1), F.lit("")), F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1))
    return rows.select(name.alias("partition"), "x.*")


def cursor_body(state: Column) -> Column:
    """A source's cursor (a struct or map) as YAML, keys of all maps sorted, so that equal states are equal texts."""
    return sorted_yaml_of(F.to_json(state))
