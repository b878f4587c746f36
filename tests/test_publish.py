"""Publishing by staging, schemas, logs of decisions, ledgers in buckets."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerforge.functions.json_schema import schema_problems
from ledgerforge.plans import publish
from ledgerforge.sources import files
from ledgerforge.sources.decisions import SCHEMA as DECISIONS
from ledgerforge.sources.decisions import DecisionLog

SCHEMA = {
    "type": "object", "required": ["kind", "items"], "additionalProperties": False,
    "$defs": {"hex": {"type": ["string", "null"], "pattern": "^#[0-9a-f]{6}$"}, "item": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}, "hex": {"$ref": "#/$defs/hex"}, "when": {"format": "date"}, "tags": {"type": "array", "uniqueItems": True, "maxItems": 2, "items": {"enum": ["a", "b", 1, None, True]}}}}},
    "properties": {"kind": {"const": "paint"}, "items": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/item"}}, "size": {"oneOf": [{"type": "number", "maximum": 5}, {"type": "integer", "minimum": 3}]}, "link": {"anyOf": [{"type": "null"}, {"format": "uri", "type": "string", "minLength": 3, "maxLength": 20}]}, "more": {"type": "object", "additionalProperties": {"type": "boolean"}}, "no": {"not": {"type": "string"}}, "all": {"allOf": [{"minimum": 1}, {"maximum": 3}]}},
}
DOCS = {
    '{"kind":"paint","items":[{"n":1,"hex":null,"when":"2024-02-29","tags":["a",null]},{"n":2.0}],"size":4.5,"link":null,"more":{"x":true},"no":1,"all":2}': [],
    '{"kind":"x","items":[{"hex":"red","n":0,"when":"2023-02-29","tags":["c","c",1]},{"n":1.5},{}]}': ["/kind: not an allowed value", "/items/0/n: minimum", "/items/0/hex: pattern", "/items/0/when: format", "/items/0/tags: maxItems", "/items/0/tags: uniqueItems", "/items/0/tags/0: not an allowed value", "/items/0/tags/1: not an allowed value", "/items/1/n: not of type integer", "/items/2/n: missing"],
    '{"items":[],"size":4,"link":"x","more":{"x":1,"y":false},"no":"s","all":0,"other":1}': ["/kind: missing", "/items: minItems", "/size: not one of oneOf", "/link: none of anyOf", "/more/x: not of type boolean", "/no: as not", "/all: minimum", "/other: not allowed"],
    "[]": ["/: not of type object"], "{": ["/: no JSON"],
}


def test_schemas_compile_to_columns(spark):
    rows = spark.createDataFrame([(k, d) for k, d in enumerate(DOCS)], "k int, body string")
    got = {r.k: list(r.e) for r in rows.select("k", schema_problems(F.try_parse_json("body"), SCHEMA).alias("e")).collect()}
    assert [got[k] for k in range(len(DOCS))] == list(DOCS.values())
    with pytest.raises(ValueError, match="refers to itself"):
        schema_problems(F.col("v"), {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"})


def docs(spark, **bodies):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in bodies.items()], "partition string, body string")


def tree(path):
    return {p.parent.name.removeprefix("partition="): json.loads(p.read_text()) for p in path.glob("*/part-*")}


def test_publishing_replaces_a_tree_whole(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/out"
    assert sorted(r["partition"] for r in publish.write_documents(docs(spark, a={"n": 1}, b={"n": 2}), at).collect()) == ["a", "b"]
    publish.write_documents(docs(spark, b={"n": 3}, c={"n": 4}), at)
    assert tree(tmp_path / "out") == {"b": {"n": 3}, "c": {"n": 4}} and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out"]
    # an invalid document leaves the tree
    with pytest.raises(ValueError, match="minimum"):
        publish.write_documents(docs(spark, d={"n": 0}), at, schema={"properties": {"n": {"minimum": 1}}})
    # a run that dies once it has written leaves it too
    moved = files.rename
    for stop in (1, 2):
        calls = []

        def fails(spark, old, new, calls=calls, stop=stop):
            calls.append(new)
            if len(calls) == stop:
                raise OSError("lost")
            moved(spark, old, new)

        monkeypatch.setattr(files, "rename", fails)
        with pytest.raises(OSError, match="lost"):
            publish.write_documents(docs(spark, e={"n": 9}), at)
        monkeypatch.setattr(files, "rename", moved)
        publish.recover(spark, at)
        assert tree(tmp_path / "out") == {"b": {"n": 3}, "c": {"n": 4}} and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out"]
    publish.write_documents(docs(spark, e={"n": 9}), at)
    assert tree(tmp_path / "out") == {"e": {"n": 9}}


def test_decisions_are_replayed_from_their_log(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), DECISIONS)
    first = rows(("h1", 1, 0, "a", "x", 0.9), ("h2", 1, 1, "b", "y", 0.5), ("h1", 1, 2, "a", "z", 0.85))
    second = rows(("h2", 2, 0, "b", None, 0.95), ("h3", 2, 1, "c", "w", 0.99))
    want = {"h1": ("z", 0.85), "h2": (None, 0.95), "h3": ("w", 0.99)}
    for k, steps in enumerate(((first, second), (second, first, first), (first, "compact", second, first, "compact", "compact"))):
        log = DecisionLog(spark, f"file://{tmp_path}/{k}")
        assert log.last().count() == log.torn().count() == 0
        for step in steps:
            log.compact() if step == "compact" else log.append(step)
        assert {r.input: (r.choice, r.confidence) for r in log.last().collect()} == want
        # a file that was cut off loses its last line alone
        torn = tmp_path / str(k) / "log" / "torn"
        torn.mkdir(parents=True)
        (torn / "part-0").write_text('{"input":"h4","run":3,"place":0,"item":"d","choice":"v","confidence":1.0}\n{"input":"h1","run":3,"pla')
        assert {r.input for r in log.last().collect()} == {*want, "h4"} and log.torn().count() == 1
        candidates = spark.createDataFrame([("h1", 1), ("h2", 2), ("h5", 5)], "input string, n int")
        assert [(r.input, r.n) for r in log.pending(candidates).collect()] == [("h5", 5)]
        assert sorted((r.n, r.choice) for r in log.accepted(candidates).collect()) == [(1, "z"), (2, None)]
        log.compact()
        assert log.last().count() == 4 and log.torn().count() == 0 and files.children(spark, f"{log.path}/log") == []
