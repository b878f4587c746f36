import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerforge.functions import barcode, color, extract, text
from ledgerforge.operators.components import connected_components, least_labels
from ledgerforge.operators.equivalence import equivalents


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("4006381333932", None), ("4006381333931", "4006381333931"), ("4006 3813-33931", "4006381333931"), ("012345678905", "0012345678905"), ("0000000000000", None), ("400638133393²", None), (None, None), ("", None)],
)
def test_normalize_ean(spark, raw, want):
    assert one(spark, barcode.normalize_ean(F.col("raw")), raw=raw) == want


def test_check_digits_agree_with_arithmetic(spark):
    draw = random.Random(1)
    stems = ["".join(draw.choices("0123456789", k=12)) for _ in range(200)]
    got = {r.stem: r.d for r in spark.createDataFrame([(s,) for s in stems], "stem string").select("stem", barcode.check_digit(F.col("stem")).alias("d")).collect()}
    assert all(got[s] == (10 - sum(int(c) * (3 if k % 2 else 1) for k, c in enumerate(s)) % 10) % 10 for s in stems)


def test_slugs_differ_where_letters_do_not_decompose(spark):
    df = spark.createDataFrame([("Ünder Wörld!",), ("Łódź",), ("日本",), (None,)], "s string")
    assert [tuple(r) for r in df.select(text.slug_ascii(F.col("s")), text.slug_marks(F.col("s"))).collect()] == [("under-world", "under-world"), ("odz", "odz"), ("", "unknown"), (None, None)]


def test_names_and_halves(spark):
    assert one(spark, text.name_key(F.col("s")), s="  \"Ｄark  Ink\" ") == "dark ink"
    assert one(spark, text.halves_merged(F.col("s")), s="Red Red") == "Red"
    assert one(spark, text.halves_merged(F.col("s")), s="Red Blue") == "Red Blue"
    assert one(spark, text.without_fence(F.col("s")), s="```json\n{}\n```") == "{}"
    assert one(spark, text.hex_display(F.col("s")), s=" #ABCDEF ") == "#abcdef"
    assert one(spark, text.code_dotted(F.col("s")), s="70950") == "70.950"


# Published CIEDE2000 pairs (L, a, b, L, a, b, distance).
PAIRS = [(50, 2.6772, -79.7751, 50, 0, -82.7485, 2.0425), (50, 2.5, 0, 73, 25, -18, 27.1492), (50, -1.3802, -84.2814, 50, 0, -82.7485, 1.0), (2.0776, 0.0795, -1.135, 0.9033, -0.0636, -0.5514, 0.9082)]


def test_delta_e_of_published_pairs(spark):
    df = spark.createDataFrame([tuple(map(float, p)) for p in PAIRS], "l1 double, a1 double, b1 double, l2 double, a2 double, b2 double, want double")
    ahead, back = (color.with_delta_e(df, *sides).collect() for sides in ((("l1", "a1", "b1"), ("l2", "a2", "b2")), (("l2", "a2", "b2"), ("l1", "a1", "b1"))))
    assert all(abs(r.delta_e - r.want) < 1e-4 for r in ahead)
    assert all(abs(a.delta_e - b.delta_e) < 1e-9 for a, b in zip(ahead, back, strict=True))


def test_equivalents_take_the_best_of_each_other_brand(spark):
    rows = [(1, 1, "a", 10, 10, 10), (2, 2, "b", 11, 10, 10), (3, 3, "b", 10, 10, 10), (4, 4, "c", 255, 0, 0), (5, 5, "a", 10, 10, 10), (6, 6, "c", None, 0, 0), (7, 7, "b", 10, 10, 10)]
    got = {(r.id, r["match"], r["rank"]) for r in equivalents(spark.createDataFrame(rows, "id int, index int, brand string, r int, g int, b int")).collect()}
    assert got == {(1, 3, 1), (5, 3, 1), (2, 1, 1), (3, 1, 1), (7, 1, 1)}


def test_json_ld_graphs_arrays_and_broken_blocks(spark):
    html = '<script type="application/ld+json">{oops</script><script type="application/ld+json">{"@graph":[{"@type":"WebSite","name":"x"},{"@type":["A","Product"],"name":"P","brand":{"name":"B"},"offers":[{"gtin":"1"}]}]}</script>'
    assert tuple(one(spark, extract.ld_product(F.col("h")), h=html)) == ("P", None, "B", "1")
    assert one(spark, extract.embedded_object(F.col("h")), h='var BCData = {"a": "}", "sku": "7"};') == '{"a": "}", "sku": "7"}'


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_least_labels_are_components(edges):
    import numpy as np

    nodes, at = np.unique(np.array(edges, int).reshape(-1), return_inverse=True)
    label = least_labels(at[::2], at[1::2], len(nodes))
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert dict(zip(nodes.tolist(), nodes[label].tolist(), strict=True)) == root


def test_both_ways_to_components_agree(spark):
    draw = random.Random(2)
    edges = spark.createDataFrame([(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 130)], "a long, b long")
    few, many = (sorted(map(tuple, connected_components(edges, one_task_edges=n).collect())) for n in (10**6, 0))
    assert few == many
    assert connected_components(edges.where("a < 0")).count() == 0
