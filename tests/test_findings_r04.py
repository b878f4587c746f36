"""What the fourth round's findings named: rows that link alike are one pack, and are written and shuffled once."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerforge.operators import resolve as R
from ledgerforge.plans import derive
from ledgerforge.plans.catalog_queries import QUERIES
from test_findings_r03 import same_as_sql, tables

KIND = "key string, source string, kind string, priority int, manufacturer string, code string, ean string, name string, part int, price double"


def dirty(seed):
    """Rows of few codes, barcodes and names, with nulls, codes of several barcodes and barcodes of several makers, codes and parts."""
    rng, rows = random.Random(seed), []
    for k in range(rng.choice([40, 150])):
        kind = rng.choice(["curated", "manufacturer", "retailer", "archive", "barcode-db", "barcode-db", None])
        code, ean = rng.choice([None, None, *map(str, range(12))]), rng.choice([None, None, *(f"e{n}" for n in range(14))])
        rows.append((f"k{rng.randrange(10**6):06}:{k}", "s", kind, rng.choice([None, 0, 1, 2]), rng.choice(["m", "m", "n", "o", None]), code, ean, rng.choice(["Alpha", "beta", "c d", "", "?", None, f"own{k}"]), rng.choice([None, 1, 2]), rng.choice([None, float(k)])))
    return rows


def by_hand(rows, within=(), codes=None):
    """key: (comp, entity, attributes) by comparing rows with each other."""
    rows = [dict(zip((c.split()[0] for c in KIND.split(", ")), r, strict=True)) for r in rows]
    for r in rows:
        r["code"] = (codes or {}).get(r["key"], r["code"])
        r["slug"] = r["name"] and r["name"].lower().replace(" ", "-").replace("?", "")
    trust = lambda r: (r["priority"] is not None, r["priority"] or 0, r["key"])
    own = {(r["manufacturer"], r["ean"]) for r in rows if r["kind"] not in (None, "barcode-db") and r["ean"]}
    rows = [r for r in rows if r["manufacturer"] and (r["code"] or r["ean"] or r["slug"]) and (r["kind"] not in (None, "barcode-db") or (r["manufacturer"], r["ean"]) in own)]
    owner, parent = {}, {r["key"]: r["key"] for r in rows}
    for r in sorted(rows, key=trust):
        if r["ean"]:
            owner.setdefault(r["ean"], r["manufacturer"])

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    def union(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    def groups():
        out = {}
        for r in sorted(rows, key=trust):
            out.setdefault(root(r["key"]), []).append(r)
        return out

    first = {}
    for r in rows:
        if r["code"]:
            union(r["key"], first.setdefault((r["manufacturer"], r["code"]), r["key"]))
        if r["ean"] and owner[r["ean"]] == r["manufacturer"]:
            union(r["key"], first.setdefault(("ean", r["ean"], *(r[c] for c in within)), r["key"]))
    linked = groups()
    names = {}
    for comp, members in linked.items():
        if any(r["code"] for r in members):
            for r in members:
                if r["slug"] is not None:
                    names.setdefault((r["manufacturer"], r["slug"]), set()).add(comp)
    for comp, members in linked.items():
        to = set().union(*(names.get((r["manufacturer"], r["slug"]), set()) for r in members))
        if not any(r["code"] or r["ean"] for r in members) and len(to) == 1:
            union(comp, *to)
    entity = {}
    for comp, members in groups().items():
        tail = next((r["code"] for r in members if r["code"]), members[0]["slug"])
        entity[comp] = "/".join(v for v in (members[0]["manufacturer"], tail) if v is not None)
    return linked, {r["key"]: (root(r["key"]), entity[root(r["key"])]) for r in rows}


def slug():
    return F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "^-|-$", "")


@pytest.mark.parametrize("seed", [0, 1, 2, 5])
def test_packs_are_linked_as_their_rows_would_be(spark, seed, monkeypatch):
    """Packs that others tie, that stand alone, that a name leads to another, and that nobody asserts; also where no table is broadcast."""
    if seed % 3 == 2:
        monkeypatch.setattr(R, "BROADCAST_LINKS", 0)
    rows, within = dirty(seed), ["part"] if seed % 2 else None
    df = spark.createDataFrame(rows, KIND)
    linked, want = by_hand(rows, within or ())
    assert {r["key"]: (r["comp"], r["entity"]) for r in R.resolve(df, slug(), within=within).collect()} == want
    got = R.entities(df, slug(), within=within).collect()
    entities = {}
    for key, (_, entity) in want.items():
        entities.setdefault(entity, []).append(key)
    assert {r["entity"]: (r["members"], r["first_key"]) for r in got} == {e: (len(keys), min(keys)) for e, keys in entities.items()}
    first = lambda members, f: next((r[f] for r in members if r[f] is not None), None)
    given = df.where("code IS NOT NULL OR ean IS NOT NULL OR trim(coalesce(name, '')) NOT IN ('', '?')")
    got = R.gathered(given, within).select("comp", "code", "ean", R.foremost("rows", "name").alias("name"), R.foremost("rows", "price").alias("price"), F.array_sort("rows.key").alias("keys"))
    assert {r["comp"]: (r["code"], r["ean"], r["name"], r["price"], r["keys"]) for r in got.collect()} == {c: (*(first(m, f) for f in ("code", "ean", "name", "price")), sorted(r["key"] for r in m)) for c, m in linked.items()}
    assert {r["key"]: r["comp"] for r in R.linked(given, within=within).collect()} == {r["key"]: c for c, m in linked.items() for r in m}


def test_hand_kept_lists_apply_to_packs(spark):
    """Corrected codes, aliases and retracted entities; a row without code and barcode is no part of a list."""
    rows = dirty(7)
    codes = {r[0]: "99" for r in rows[::9]}
    _, want = by_hand(rows, codes=codes)
    old = sorted({e for _, e in want.values()})
    aliases, gone = {old[0]: "m/new", old[3]: old[5]}, {old[1], old[7]}
    listed = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    got = R.resolve(listed(rows, KIND), slug(), codes=listed(codes.items(), "key string, code string"), aliases=listed(aliases.items(), "old string, new string"), retracted=listed([(g,) for g in gone], "entity string"))
    assert {r["key"]: r["entity"] for r in got.collect()} == {k: aliases.get(e, e) for k, (_, e) in want.items() if aliases.get(e, e) not in gone}
    bare = listed([(f"k{k}", "s", "retailer", 1, "m", None, None, "x", None, None) for k in range(50)], KIND)
    assert R.packed(bare).agg(F.max(F.size("__rows"))).first()[0] == 1 and R.packed(bare, rows=False).count() == 1


def writes(monkeypatch):
    """What is written, by name: rows, and how often a plan shuffles."""
    found, real = [], R.written
    monkeypatch.setattr(R, "written", lambda df, name: found.append((name, (out := real(df, name)).count(), df._jdf.queryExecution().executedPlan().toString().count("Exchange hash"))) or out)
    return found


@pytest.mark.parametrize("name", ["resolve_entities", "survivorship"])
def test_rows_are_shuffled_once_and_written_as_packs(spark, tmp_path, monkeypatch, name):
    """repeats are removed and packs made in one shuffle; nothing that is written has more rows than there are packs."""
    twice = "SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_extendedprice - 1 AS l_extendedprice, l_shipdate + INTERVAL 3 DAY AS l_shipdate) FROM lineitem WHERE l_orderkey % 3 = 0"
    folder = tables(tmp_path, lineitem=twice)
    found = writes(monkeypatch)
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in found if x[0] == "packs"] == [("packs", found[0][1], 1)]
    assert Counter(n for n, _, _ in found)["packs"] == 1 and not {"joinable", "labelled"} & {n for n, _, _ in found}
    assert max(rows for _, rows, _ in found) == found[0][1] < 2_600
    assert plan.count("Exchange hash") == (1 if name == "resolve_entities" else 0) and "collect_list" not in plan
    assert same_as_sql(spark, name, folder)


def test_a_tasks_lines_are_bounded(spark, tmp_path, monkeypatch):
    """a shuffle of few partitions gave a task so many rows that sorting them spilled more than all shuffles wrote."""
    folder = tables(tmp_path)
    monkeypatch.setattr(derive, "TASK_LINES", 500)
    assert derive.observations(spark, folder, by_part=True).rdd.getNumPartitions() == 12
    assert same_as_sql(spark, "survivorship", folder)
