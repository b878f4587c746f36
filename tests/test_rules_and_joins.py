"""Similar names against brute force, rules by their automaton, legacy trees, natural keys."""

import random
from difflib import SequenceMatcher

import pytest

from ledgerforge.functions.rules import substring_rules
from ledgerforge.operators import enrich
from ledgerforge.sources import legacy


def names(seed, n, letters, longest):
    draw, out = random.Random(seed), []
    for _ in range(n):
        x = "".join(draw.choice(letters) for _ in range(draw.randrange(longest)))
        if out and draw.random() < 0.6:
            x = list(draw.choice(out))
            for _ in range(draw.randrange(4)):
                at = draw.randrange(len(x) + 1)
                x[at : at + draw.randrange(2)] = draw.choice(letters) * draw.randrange(3)
            x = "".join(x)
        out.append(x)
    return out


@pytest.mark.parametrize("letters,longest,least", [("abcdefgh ", 25, 0.86), ("ab", 12, 0.86), ("abcé", 9, 0.6), ("abcdef", 8, 0.95)])
def test_similar_names_equal_brute_force(spark, letters, longest, least):
    ours, theirs = names(1, 120, letters, longest), names(1, 100, letters, longest) + names(2, 40, letters, longest)
    claims = spark.createDataFrame([(k, x, "b") for k, x in enumerate(ours)], "claim int, name string, brand string")
    dim = spark.createDataFrame([(k, x, "b") for k, x in enumerate(theirs)] + [(999, x, "other") for x in ours[:5]], "id int, name string, brand string")
    got = {r.claim: (r.match, round(r.ratio, 9)) for r in enrich.fuzzy(claims, dim, "brand", least).collect()}
    want = {}
    for k, x in enumerate(ours):
        best = max((round(SequenceMatcher(None, x, y).ratio(), 9), -j) for j, y in enumerate(theirs))
        if best[0] >= least:
            want[k] = (-best[1], best[0])
    assert got == want and want


def test_few_pairs_are_tried(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(4, 9)))
    words = [word() for _ in range(400)]
    some = list(dict.fromkeys(" ".join(draw.choice(words) for _ in range(3)) for _ in range(1500)))
    rows = spark.createDataFrame([(x, "one") for x in some], "name string, brand string")
    assert enrich.similar_names(rows, rows.withColumnRenamed("name", "other"), "brand", 0.86).count() < 0.1 * len(some) ** 2


def test_rules_go_by_brand_and_number(spark):
    rules = [(5, None, "name", "red", "any-red"), (9, "A", "name", "dark red", "a-dark"), (7, "A", "set_name", "base", "a-base"), (1, None, "set_name", "", "never"), (2, None, "name", "zz", "any-zz"), (2, "B", "name", "RED", "b-red")]
    rows = [(1, "A", "Base", "Dark Red"), (2, "A", None, "dark red"), (3, "B", "base", "red zz"), (4, "C", "base", "REDDISH"), (5, None, "x", "zz"), (6, "A", "x", None), (7, "C", "x", "")]
    got = substring_rules(spark.createDataFrame(rows, "id int, brand string, set_name string, name string"), rules, default="plain")
    assert got.columns == ["id", "brand", "set_name", "name", "rule", "result"]
    assert {r.id: (r.rule, r.result) for r in got.collect()} == {1: (7, "a-base"), 2: (9, "a-dark"), 3: (2, "b-red"), 4: (5, "any-red"), 5: (2, "any-zz"), 6: (None, "plain"), 7: (None, "plain")}
    assert substring_rules(spark.createDataFrame(rows, "id int, brand string, set_name string, name string"), []).where("result IS NULL").count() == 7


def test_legacy_trees_lose_no_row(spark, tmp_path):
    (tmp_path / "old" / "sub").mkdir(parents=True)
    (tmp_path / "old" / "a.yaml").write_text('# kept\n---\n- name: Red\n  code: 0012\n  price: 1.50\n  tags: [a, 7]\n- name: "cut\n  code: 1\n-\tname:\tTabs\n \tcode: 5\n- just text\n- code: 9\n- name: On\n  live: true\n')
    (tmp_path / "old" / "sub" / "b.yml").write_text("stray: before\n- name: Blue\n")
    (tmp_path / "old" / "c.txt").write_text("- name: no\n")
    good, bad = legacy.read_legacy(spark, f"file://{tmp_path}/old", ["name"])
    assert sorted((r.file, r.place, dict(r.fields)) for r in good.collect()) == [
        ("a.yaml", 1, {"name": "Red", "code": "0012", "price": "1.50", "tags": "- a\n- \"7\""}), ("a.yaml", 3, {"name": "Tabs", "code": "5"}), ("a.yaml", 6, {"name": "On", "live": "true"}), ("sub/b.yml", 2, {"name": "Blue"}),
    ]
    assert {(r.file, r.place): r.reason.split(":")[0] for r in bad.collect()} == {("a.yaml", 2): "unreadable", ("a.yaml", 4): "no map", ("a.yaml", 5): "without name", ("sub/b.yml", 1): "without name"}
