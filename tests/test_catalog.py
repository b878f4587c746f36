import pytest
from pyspark.sql import functions as F

from ledgerforge.functions import extract
from ledgerforge.operators import catalog, ledger, quality


def test_legacy_pages_and_cards(spark):
    page = spark.createDataFrame([('<meta property="og:title" content="Frogs | Shop"> no. 12345678901 £12<sup>50</sup>',), ("<title>Only - Shop</title> £7",), ("",)], "h string")
    assert [tuple(r.x) for r in page.select(extract.legacy_page(F.col("h")).alias("x")).collect()] == [("12345678901", "Frogs", 12.5), (None, "Only", 7.0), (None, None, None)]
    card = spark.createDataFrame([('<b>Set:</b> Base <i style="background:#AABBCC"> glossy 17 ml jar</i>',)], "h string")
    assert tuple(card.select(extract.card_fields(F.col("h")).alias("x")).first().x)[:2] == ("aabbcc", "Gloss")
    assert tuple(card.select(extract.card_fields(F.col("h")).alias("x")).first().x)[3:] == (17, "pot")


def test_seeds(spark):
    systems = spark.createDataFrame([("wh", "Old Worlds")], "slug string, label string")
    kind = "key string, name string, system string, faction string, contents array<struct<quantity:int>>"
    rows = spark.createDataFrame([("a", "A", "old worlds", "Töads & Co", [(2,), (None,)]), ("b", "B", None, None, None)], kind)
    assert sorted(map(tuple, catalog.seeds(rows, systems).collect())) == [("a", "A", "wh", "toads-co", 3), ("b", "B", None, None, 1)]
    for bad, said in ((rows.unionByName(rows), "given twice"), (rows.withColumn("system", F.lit("?")), "unknown system")):
        with pytest.raises(Exception, match=said):
            catalog.seeds(bad, systems).collect()


def test_suffixes_skip_what_is_taken(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a-2", 4)], "key string, seq int")
    assert sorted(r.key for r in catalog.free_suffixes(rows, "seq").collect()) == ["a", "a-2", "a-3", "a-4"]


def test_fetches_carry_state(spark):
    items = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1"), ("d", "1")], "key string, updated_at string")
    state = spark.createDataFrame([("a", "1", "old", 2), ("b", "1", None, 2), ("c", "1", "v", 0)], "key string, updated_at string, value string, misses int")
    fetched = spark.createDataFrame([("a", True, None), ("b", True, None), ("c", False, None), ("d", True, "new")], "key string, ok boolean, value string")
    assert sorted(map(tuple, ledger.carried(state, fetched, items).collect())) == [("a", "2", "old", 1), ("b", "1", None, 3), ("c", "1", "v", 0), ("d", "1", "new", 0)]


def test_decisions_are_accepted_if_known_and_sure(spark):
    decisions = spark.createDataFrame([("p", "x", 0.9), ("q", "x", 0.7), ("r", "zzz", 1.0), ("s", None, 0.9)], "item string, choice string, confidence double")
    candidates = spark.createDataFrame([("p", "x"), ("q", "x"), ("r", "y")], "item string, choice string")
    assert sorted(r.item for r in quality.accepted(decisions, candidates).collect()) == ["p", "s"]
