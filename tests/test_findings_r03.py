"""What the third round's findings named: queries against their SQL on tables that show the fault, and steps at their bounds."""

import os
import random
from collections import Counter
from glob import glob

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pyspark.util import PythonEvalType

from ledgerforge.functions import elements, extract, text
from ledgerforge.functions.slices import sliced
from ledgerforge.operators import catalog as C
from ledgerforge.operators import enrich as E
from ledgerforge.operators import resolve as R
from ledgerforge.plans.catalog_queries import ORACLE_SQL, QUERIES
from ledgerforge.sources import frontier, strategies
from ledgerforge.sources import paint_shops as P

SMALL = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def tables(folder, **changed):
    """The small tables in a folder, some replaced by the rows of a SQL query over the small ones."""
    con = duckdb.connect()
    for f in glob(f"{SMALL}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    for f in glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.sql(f"COPY ({changed.get(name, f'SELECT * FROM {name}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def same_as_sql(spark, name, folder):
    con = duckdb.connect()
    for f in glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df, sql = QUERIES[name](spark, folder), con.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    want = Counter(tuple(plain(r[sql.columns.index(c)]) for c in columns) for r in sql.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want
    return sum(want.values())


@pytest.mark.parametrize("name", ["title_h1_extract", "name_merge_strip_chrome"])
def test_titles_cut_within_a_reference(spark, tmp_path, name):
    cut = "SELECT * REPLACE (CASE page_id % 3 WHEN 0 THEN '<title>A &amp;lt; B&amp</title>' WHEN 1 THEN '<h1>x&lt;&copy</h1>' ELSE html END AS html) FROM pages"
    assert same_as_sql(spark, name, tables(tmp_path, pages=cut))


@pytest.mark.parametrize("name", ["ean_normalize", "prefixed_eans"])
def test_barcodes_are_plain_arithmetic(spark, tmp_path, name):
    """No function of an array's elements, which is interpreted; and the number is computed once, before what repeats it."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "AS raw" in plan
    assert same_as_sql(spark, name, tables(tmp_path))


@pytest.mark.parametrize("name", ["components", "entity_ids", "name_fallback", "ambiguous_joins", "resolve_entities", "survivorship"])
def test_barcodes_given_out_again_link_within_a_part(spark, tmp_path, name):
    """Beyond 1,000,003 parts two parts have one barcode, which the SQL keeps apart."""
    again = "SELECT * REPLACE (l_partkey + CASE WHEN l_orderkey % 2 = 0 THEN 1000003 ELSE 0 END AS l_partkey) FROM lineitem"
    same_as_sql(spark, name, tables(tmp_path, lineitem=again))


def test_stars_are_no_edges(spark, monkeypatch):
    """Rows that a code and a barcode group alike give components no edge, or rounds would write all rows again and again."""
    edges = []
    real = R.connected_components
    monkeypatch.setattr(R, "connected_components", lambda e: edges.append(e.where("a <> b").count()) or real(e))
    kind = "key string, kind string, priority int, manufacturer string, code string, ean string"
    rows = [(f"k{k:03d}", "retailer", k % 3, "m", f"c{k % 5}", f"e{k % 5}") for k in range(200)]
    assert {r["comp"] for r in R.labelled(spark.createDataFrame(rows, kind)).collect()} == {f"k{k:03d}" for k in range(5)}
    assert edges == [0]
    chain = [("a", "retailer", 1, "m", "1", None), ("b", "retailer", 1, "m", "1", "x"), ("c", "retailer", 2, "m", None, "x"), ("d", "retailer", 2, "n", None, "x"), ("e", "retailer", 2, "m", "2", "y"), ("f", "retailer", 0, "m", None, "y")]
    got = {r["key"]: r["comp"] for r in R.labelled(spark.createDataFrame(chain, kind)).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "e"}


def test_names_of_several_targets(spark):
    """A group of two names, as forced joins make it, counts the targets that both share once."""
    kind = "key string, comp string, manufacturer string, code string, ean string, name string"
    rows = [("t1", "t1", "m", "1", None, "a"), ("t2", "t1", "m", "1", None, "b"), ("t3", "t3", "m", "3", None, "b"), ("x", "x", "m", None, None, "a"), ("y", "y", "m", None, None, "b"), ("z1", "z", "m", None, None, "a"), ("z2", "z", "m", None, None, "b"), ("w", "w", "n", None, None, "a")]
    got = R.name_candidates(spark.createDataFrame(rows, kind), F.col("name")).collect()
    assert {(r["comp"], r["targets"], r["target"]) for r in got} == {("x", 1, "t1"), ("y", 2, "t1"), ("z", 2, "t1")}


def test_links_carry_no_pages(spark):
    """A page's name is read before its links are rows, which would else each take the whole page along."""
    lines = spark.createDataFrame([("u", '<h1>L</h1><a href="https://e.org/products/p1/"><a href="https://e.org/products/p2/">')], "url string, body string")
    got = P.line_members(lines)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("ArrowEvalPython")
    assert {tuple(r) for r in got.collect()} == {("p1", "L"), ("p2", "L")}


def test_rollup_keeps_no_rows_of_a_group(spark):
    """Groups hold distinct barcodes: a list of all their rows, and one that each row copies, made work grow with a group's square."""
    rows = spark.createDataFrame([(1, "b", 0, 1), (1, "a", 1, 2), (1, "c", 1, 3), (1, "a", 0, 4), (1, "b", 0, 5), (2, "x", 0, 1)], "g int, ean string, rank int, seq long")
    got = C.barcode_rollup(rows, "g")
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, "a", ["b", "c"]), (2, "x", [])]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_claims_and_items_of_one_name_meet_once(spark):
    """300 claims and 300 items of one name are 300 rows, not their 90,000 pairs."""
    claims = spark.createDataFrame([(k, "m", "dark red ml" if k else "other") for k in range(300)], "claim long, block string, name string")
    dim = spark.createDataFrame([(k, "m", "dark red") for k in range(300, 0, -1)], "id long, block string, name string")
    found = E.fuzzy(claims, dim, "block", 0.8)
    assert "min(id" in plan_of(found)
    assert {(r["claim"], r["match"]) for r in found.collect()} == {(k, 1) for k in range(1, 300)}


def test_pairs_are_not_shuffled(spark):
    """a pair comes from the first rule that joins it, so pairs need no grouping; rules that aren't symmetric, and nulls."""
    rows = [(k, k % 3, f"n{k % 4}" if k % 5 else None, f"l{k % 6}", f"l{k % 7}") for k in range(60)]
    df = spark.createDataFrame(rows, "id long, m int, name string, old string, sku string")
    c = F.col
    got = E.pair_candidates(df, {"sku": ([c("m"), c("old")], [c("m"), c("sku")]), "name": ([c("m"), c("name")], [c("m"), c("name")]), "old": ([c("old")], [c("old")])})
    assert "Aggregate" not in plan_of(got)
    want = {}
    for a in rows:
        for b in rows:
            if a[0] < b[0]:
                said = [n for n, yes in (("name", a[1] == b[1] and a[2] == b[2] is not None), ("old", a[3] == b[3]), ("sku", a[1] == b[1] and (a[3] == b[4] or b[3] == a[4]))) if yes]
                if said:
                    want[a[0], b[0]] = said
    assert Counter((r["a"], r["b"], tuple(r["rules"])) for r in got.collect()) == Counter((a, b, tuple(v)) for (a, b), v in want.items())


def test_batches_are_read_in_slices():
    """what is made of a batch isn't in memory at once."""
    texts = ["a" * 5, None, "b" * 7, "", "c" * 30, "d" * 2]
    got = [list(x) for x in sliced(iter([pd.Series(texts), pd.Series([], dtype=object)]), 10)]
    assert got == [["a" * 5, None], ["b" * 7, ""], ["c" * 30], ["d" * 2], []]
    assert {f.evalType for f in (elements.product, P.tile_elements, text._unmarked)} == {PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF}


def test_slices_keep_their_rows(spark):
    page = "<li class='products__item'>" + "x" * 300_000 + "{}</li>"
    rows = spark.createDataFrame([(k, page.format(k)) for k in range(7)], "k int, body string").coalesce(1)
    got = rows.select("k", F.get(P.tile_elements("body"), 0)["parts"].alias("parts")).collect()
    assert {(r["k"], r["parts"][0][300_000:]) for r in got} == {(k, str(k)) for k in range(7)}


def test_marks_go_whatever_their_letter(spark):
    texts = ["", "Caf\u00e9 cre\u0301me", "\u0e01\u0e34 a\u0308\u0323b", "plain", None]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", text._unmarked("t").alias("x")).collect()
    assert [r["x"] for r in sorted(got, key=lambda r: r["k"])] == ["", "Cafe creme", "\u0e01 ab", "plain", None]


def test_a_sheets_rows_stay_where_they_are(spark):
    """columns are found once a sheet, and rows aren't shuffled by sheet, of which there are few."""
    cells = [("s", "current", k, ["Code", "Name"] if k == 1 else [f"c{k}", f"n{k}"]) for k in range(4)] + [("t", "withdrawn", 0, ["name", "code"]), ("t", "withdrawn", 1, ["n", "c"])]
    got = strategies.sheet_rows(spark.createDataFrame(cells, "sheet string, role string, line int, cells array<string>"))
    assert "strategy=broadcast" in plan_of(got)
    assert {(r["role"], r["code"], r["name"], r["barcode"]) for r in got.collect()} == {("current", "c2", "n2", None), ("current", "c3", "n3", None), ("withdrawn", "c", "n", None)}


def test_sitemaps_are_read_once(spark, monkeypatch):
    """rounds join addresses; documents are parsed by one job."""
    calls = []
    real = frontier.sitemap_documents
    monkeypatch.setattr(frontier, "sitemap_documents", lambda c: calls.append(1) or real(c))
    index = lambda *to: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in to) + "</sitemapindex>"
    docs = [(f"deep{k}", index(f"deep{k + 1}", "r")) for k in range(12)] + [("r", index("a", "b", "deep0")), ("a", index("c", "r", "gone")), ("b", index("c")), ("c", "<urlset><url><loc>p</loc></url></urlset>"), ("far", "<urlset><url><loc>q</loc></url></urlset>")]
    urls, seen = frontier.sitemap_frontier(spark.createDataFrame(docs, "url string, content string"), spark.createDataFrame([("r",)], "url string"))
    assert [r["url"] for r in urls.collect()] == ["p"] and len(calls) == 1
    assert {tuple(r) for r in seen.collect()} == {("r", "sitemapindex"), ("a", "sitemapindex"), ("b", "sitemapindex"), ("c", "urlset"), ("gone", "missing"), ("deep12", "missing"), *((f"deep{k}", "sitemapindex") for k in range(12))}


def test_a_pages_product_is_read_once(spark):
    """each field of a page's product repeated the search for it."""
    page = '<script type="application/ld+json">{"@type":"Product","name":"n","brand":{"name":"b"},"offers":[{"gtin":" 12 "}]}</script>'
    df = spark.createDataFrame([(1, page), (2, "none"), (3, None)], "k int, body string")
    got = df.select("k", extract.ld_product(F.col("body")).alias("x")).select("k", "x.*")
    assert plan_of(got).count("regexp_extract_all") == 1
    assert sorted(map(tuple, got.collect())) == [(1, "n", None, "b", "12"), (2, None, None, None, None), (3, None, None, None, None)]


@pytest.mark.parametrize("name", ["fuzzy_join", "pair_candidates", "listed_product_tiles", "numbered_product_pages", "slug_marks", "trade_sheet_rows", "sitemap_tree", "jsonld_extract", "nested_ld_gtins", "page_origins"])
def test_results_stay_those_of_the_sql(spark, tmp_path, name):
    assert same_as_sql(spark, name, tables(tmp_path))


@pytest.mark.parametrize("name", ["ean_primary", "ean_decision", "superseded_survivors"])
def test_marks_of_old_packagings_join_nothing(spark, tmp_path, name):
    """Lines are read once and rows are shuffled by entity once; a key's repeats, at other prices, change no decision."""
    twice = "SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_extendedprice - 1 AS l_extendedprice) FROM lineitem WHERE l_orderkey % 3 = 0"
    folder = tables(tmp_path, lineitem=twice)
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange") == (2 if name == "superseded_survivors" else 1)
    assert same_as_sql(spark, name, folder)


def test_old_packagings_by_keys_or_by_a_condition(spark):
    rows = [("a", "m/2", "1", True), ("b", "m/2", "1", None), ("c", "m/2", "2", None), ("d", "m/2", None, True), ("e", "m/x", "1", True), ("f", "n/2", "3", None), ("g", "n/2", "2", False)]
    rows = spark.createDataFrame(rows, "key string, entity string, code string, f boolean")
    want = {"a": ("2", True), "b": ("2", True), "c": ("2", False), "d": ("2", False), "e": (None, False), "f": ("2", False), "g": ("2", False)}
    for forced in (F.col("f"), rows.where("f").select("key")):
        assert {r["key"]: (r["surviving"], r["superseded"]) for r in R.superseded(rows, forced).collect()} == want


def test_shared_barcodes_decide_once(spark, tmp_path):
    """What is primary and what is further comes from one pass over the decisions, which would else be made twice."""
    folder = tables(tmp_path)
    assert QUERIES["shared_ean"](spark, folder)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert same_as_sql(spark, "shared_ean", folder)
    primary = spark.createDataFrame([("a", "1", ["2", "3"]), ("b", "2", []), ("c", "3", None), ("d", "4", ["4"])], "entity string, ean string, others array<string>")
    assert {r["ean"]: (r["entities"], r["further_in"]) for r in R.shared_eans(primary, "entity").collect()} == {"2": (["a", "b"], ["a"]), "3": (["a", "c"], ["a"])}


def test_lifecycle_hashes_its_groups(spark, tmp_path):
    """A number tells of all rows, so that none is sorted; words, which are few, are apart. Repeated lines change nothing."""
    folder = tables(tmp_path, lineitem="SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 3 = 0")
    plan = QUERIES["lifecycle_status"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" HashAggregate(keys=[comp") + plan.count("-HashAggregate(keys=[comp") == 2
    assert same_as_sql(spark, "lifecycle_status", folder)
    rows = [(None, "curated", 0, "k", False, 0, "limited"), ("a", "curated", 0, "k", True, 0, "limited"), ("b", None, 0, "k", False, 0, None), ("c", "retailer", 2, "k", None, None, None), ("d", "curated", 0, "k", None, None, ""), ("e", "curated", 1, "j", False, 0, "x"), ("e", "curated", 0, "l", False, 0, "y"), ("e", "curated", 0, "k", False, 0, None)]
    rows = spark.createDataFrame(rows, "id string, kind string, priority int, key string, archived boolean, miss_streak int, claimed string")
    assert {r["id"]: r["status"] for r in R.lifecycle(rows, "id").collect()} == {None: "limited", "a": "discontinued", "b": "discontinued", "c": "suspected-discontinued", "d": "current", "e": "y"}


def test_links_to_owners_sort_no_rows_to_join(spark, tmp_path):
    """Rows aren't shuffled to be made unique, links are; a barcode's first row is hashed. Repeated lines give no link twice."""
    folder = tables(tmp_path, lineitem="SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice) FROM lineitem WHERE l_orderkey % 2 = 0")
    plan = QUERIES["link_by_ean_owner"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" not in plan and "ShuffledHashJoin" in plan
    assert same_as_sql(spark, "link_by_ean_owner", folder)


def test_forced_joins_are_solved_apart(spark, monkeypatch):
    """What a list of joins reaches doesn't come to the driver: manufacturers that joins tie are solved in a task, as one loop over all would."""
    rng, rows, joins, aliases = random.Random(5), [], [], {}
    for world in range(12):
        makers, tails = [f"{m}{world}" for m in "mnop"], ["1", "2", "3", "x/y", "z"]
        names = [f"{m}/{t}" for m in makers for t in tails]
        for c in range(14):
            maker = rng.choice(makers)
            for k in range(rng.choice([1, 1, 2])):
                rows.append((f"{world}:{c:02}:{k}", f"{world}:{c:02}:0", rng.randrange(3), maker, rng.choice([None, *tails]), rng.choice([None, *tails])))
        joins += [(rng.choice(rows)[0] if rng.random() < 0.05 else f"{world}:{rng.randrange(14):02}:0", rng.choice(names)) for _ in range(10)] + [("unseen", names[0])]
        aliases |= {old: rng.choice(names) for old in rng.sample(names, 5)}
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    at = {r[0]: r[1] for r in rows}

    def ident(members):
        order = sorted(members, key=lambda r: (r[2], r[0]))
        code = next((r[4] for r in order if r[4] is not None), order[0][5])
        raw = "/".join(v for v in (order[0][3], code) if v is not None)
        return aliases.get(raw, raw)

    entries, again = sorted({(k, aliases.get(t, t)) for k, t in joins if k in at}), True
    while again:
        again = False
        for k, t in entries:
            others = [c for c in groups if c != at[k] and ident(groups[c]) == t]
            if ident(groups[at[k]]) != t and others:
                low, high = sorted((at[k], min(others)))
                groups[low] += groups.pop(high)
                at |= {r[0]: low for r in groups[low]}
                again = True
    df = spark.createDataFrame(rows, "key string, comp string, priority int, manufacturer string, code string, name string")
    with monkeypatch.context() as m:
        m.setattr(type(df), "collect", lambda _: pytest.fail("rows come to the driver"))
        moved, landed = R.forced_fixpoint(df, spark.createDataFrame(joins, "key string, entity string"), F.col("name"), spark.createDataFrame(list(aliases.items()), "old string, new string"))
    assert {tuple(r) for r in moved.collect()} == {(r[1], at[r[0]]) for r in rows if r[1] != at[r[0]]}
    assert {r["comp"] for r in landed.collect()} == {at[k] for k, t in entries if ident(groups[at[k]]) == t}
    assert moved.count() > 30
