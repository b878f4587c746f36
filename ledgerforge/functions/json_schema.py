"""JSON schemas as column expressions: what is wrong with a document, without leaving the JVM.

A schema is compiled once, references and combinators included, to expressions over a parsed document (a variant).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERS = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"
KINDS = {"object": "^OBJECT", "array": "^ARRAY", "string": "^STRING$", "boolean": "^BOOLEAN$", "null": "^VOID$", "number": NUMBERS, "integer": NUMBERS}


def pointed(root: dict, ref: str) -> dict:
    """The part of a schema that a local reference (#/a/b) names."""
    if not ref.startswith("#"):
        raise ValueError(f"not a local reference: {ref}")
    at: object = root
    for step in filter(None, ref[1:].split("/")):
        at = at[step.replace("~1", "/").replace("~0", "~")] if isinstance(at, dict) else at[int(step)]
    return at


def schema_problems(document: Column, schema: dict, most: int = 10) -> Column:
    """The first `most` distinct problems of a document (a variant), each with its place; empty if it is as the schema says.

    Keywords: type, enum, const, required, properties, additionalProperties, items, minItems, maxItems, uniqueItems, minLength, maxLength,
    pattern, minimum, maximum, format (date, uri), $ref within the schema, allOf, anyOf, oneOf and not. Others are passed over. A schema
    that refers to itself, directly or by way of others, has no finite expression and is refused.
    """
    none = F.array().cast("array<string>")

    def say(at: Column, what: str) -> Column:
        return F.concat(F.when(at == "", F.lit("/")).otherwise(at), F.lit(f": {what}"))

    def when(bad: Column, problem: Column) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.array(problem)).otherwise(none)

    def both(parts: list[Column]) -> Column:
        return F.concat(*parts) if parts else none

    def check(v: Column, rule: dict | bool, at: Column, open_: tuple[str, ...]) -> Column:
        if rule is True or rule == {}:
            return none
        if rule is False:
            return F.array(say(at, "not allowed"))
        if "$ref" in rule:
            if rule["$ref"] in open_:
                raise ValueError(f"a schema that refers to itself: {' > '.join((*open_, rule['$ref']))}")
            rest = {k: x for k, x in rule.items() if k != "$ref"}
            return both([check(v, pointed(schema, rule["$ref"]), at, (*open_, rule["$ref"])), *([check(v, rest, at, open_)] if rest else [])])
        kind = F.schema_of_variant(v)
        is_a = lambda *names: reduce(Column.__or__, [kind.rlike(KINDS[n]) & (whole(v) if n == "integer" else F.lit(True)) for n in names])
        out = []
        types = rule.get("type")
        names = types if isinstance(types, list) else [types] if types else []
        fits = is_a(*names) if names else F.lit(True)
        plain = F.try_variant_get(v, "$", "string")
        if "enum" in rule or "const" in rule:
            allowed = rule.get("enum", [rule.get("const")])
            out.append(when(~reduce(Column.__or__, [equal(v, kind, x) for x in allowed]), say(at, "not an allowed value")))
        text, number = kind.rlike(KINDS["string"]), kind.rlike(NUMBERS)
        value = F.try_variant_get(v, "$", "double")
        for key, bad in (("minLength", lambda n: F.length(plain) < n), ("maxLength", lambda n: F.length(plain) > n), ("pattern", lambda p: ~plain.rlike(p))):
            if key in rule:
                out.append(when(text & bad(rule[key]), say(at, key)))
        if rule.get("format") in ("date", "uri"):
            bad = F.try_to_date(plain, "yyyy-MM-dd").isNull() if rule["format"] == "date" else ~plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$")
            out.append(when(text & bad, say(at, "format")))
        for key, bad in (("minimum", lambda n: value < n), ("maximum", lambda n: value > n)):
            if key in rule:
                out.append(when(number & bad(rule[key]), say(at, key)))
        if any(k in rule for k in ("items", "minItems", "maxItems", "uniqueItems")):
            listed = F.try_variant_get(v, "$", "array<variant>")
            array = kind.rlike(KINDS["array"])
            for key, bad in (("minItems", lambda n: F.size(listed) < n), ("maxItems", lambda n: F.size(listed) > n)):
                if key in rule:
                    out.append(when(array & bad(rule[key]), say(at, key)))
            if rule.get("uniqueItems"):
                texts = F.transform(listed, lambda x: F.coalesce(F.to_json(x), F.lit("null")))
                out.append(when(array & (F.size(F.array_distinct(texts)) < F.size(texts)), say(at, "uniqueItems")))
            if "items" in rule:
                inner = F.transform(listed, lambda x, k: check(F.coalesce(x, F.parse_json(F.lit("null"))), rule["items"], F.concat(at, F.lit("/"), k.cast("string")), open_))
                out.append(F.when(array, F.flatten(inner)).otherwise(none))
        own, more = rule.get("properties", {}), rule.get("additionalProperties", True)
        if own or "required" in rule or more is not True:
            held = F.try_variant_get(v, "$", "map<string,variant>")
            object_ = kind.rlike(KINDS["object"])
            has = lambda k: F.array_contains(F.map_keys(held), k)
            place = lambda k: F.concat(at, F.lit(f"/{k}"))
            out += [when(object_ & ~has(k), say(place(k), "missing")) for k in rule.get("required", [])]
            out += [F.when(object_ & has(k), check(F.coalesce(F.try_element_at(held, F.lit(k)), F.parse_json(F.lit("null"))), x, place(k), open_)).otherwise(none) for k, x in own.items()]
            if more is not True:
                others = F.array_sort(F.filter(F.map_keys(held), lambda k: ~k.isin(list(own)) if own else F.lit(True)))
                each = F.transform(others, lambda k: check(F.coalesce(F.try_element_at(held, k), F.parse_json(F.lit("null"))), more, F.concat(at, F.lit("/"), k), open_))
                out.append(F.when(object_, F.flatten(each)).otherwise(none))
        parts = lambda key: [check(v, x, at, open_) for x in rule.get(key, [])]
        out += parts("allOf")
        if "anyOf" in rule:
            out.append(when(~reduce(Column.__or__, [F.size(p) == 0 for p in parts("anyOf")]), say(at, "none of anyOf")))
        if "oneOf" in rule:
            out.append(when(sum(((F.size(p) == 0).cast("int") for p in parts("oneOf")), F.lit(0)) != 1, say(at, "not one of oneOf")))
        if "not" in rule:
            out.append(when(F.size(check(v, rule["not"], at, open_)) == 0, say(at, "as not")))
        # of a wrong type nothing else is said
        return F.when(fits, both(out)).otherwise(F.array(say(at, f"not of type {'|'.join(names)}"))) if names else both(out)

    problems = check(document, schema, F.lit(""), ())
    return F.when(document.isNull(), F.array(F.lit("/: no JSON"))).otherwise(F.slice(F.array_distinct(problems), 1, most))


def whole(v: Column) -> Column:
    """Whether a number has no fraction."""
    x = F.try_variant_get(v, "$", "double")
    return x == F.floor(x)


def equal(v: Column, kind: Column, value: object) -> Column:
    """Whether a variant is that value."""
    if value is None:
        return kind == "VOID"
    if isinstance(value, bool):
        return (kind == "BOOLEAN") & F.coalesce(F.try_variant_get(v, "$", "boolean") == value, F.lit(False))
    if isinstance(value, int | float):
        return kind.rlike(NUMBERS) & F.coalesce(F.try_variant_get(v, "$", "double") == float(value), F.lit(False))
    if isinstance(value, str):
        return (kind == "STRING") & F.coalesce(F.try_variant_get(v, "$", "string") == value, F.lit(False))
    raise ValueError(f"only plain values can be listed: {value!r}")
