import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerforge.plans import publish
from ledgerforge.plans.runner import Contract, run_source
from ledgerforge.sources import evidence, fixtures, robots, strategies, tables, yaml_text


def payload(spark, body):
    return spark.createDataFrame([(json.dumps(body),)], "body string")


def test_evidence_round_trip_keeps_the_last_line(spark, tmp_path):
    (tmp_path / "in" / "s").mkdir(parents=True)
    lines = ['{"key":"s:1","name":"old","ean":"0012345678905","firstSeen":"2024-01-01","lastSeen":"2024-01-01","extractor":"x"}', '{"key":"s:1","name":"new","firstSeen":"2024-01-01","lastSeen":"2024-01-02","extractor":"x","hints":{"a":"b"}}']
    (tmp_path / "in" / "s" / "observations.jsonl").write_text("\n".join(lines))
    got = evidence.read_evidence(spark, str(tmp_path / "in"))
    row = got.first()
    assert (row.name, row.ean, row.source_id, row.missStreak, row.hints) == ("new", None, "s", 0, {"a": "b"})
    evidence.write_evidence(got, str(tmp_path / "out"))
    [part] = (tmp_path / "out" / "source=s").glob("part-*")
    assert part.read_text() == '{"archived":false,"extractor":"x","firstSeen":"2024-01-01","hints":{"a":"b"},"key":"s:1","lastSeen":"2024-01-02","missStreak":0,"name":"new"}\n'


def test_dimension_files_must_be_named_by_id(spark, tmp_path):
    (tmp_path / "shop.json").write_text('{"id": "shop"}')
    rows = evidence.read_dimension(spark, str(tmp_path), "id string")
    assert evidence.require_ids_match(rows).first().id == "shop"
    (tmp_path / "other.json").write_text('{"id": "shop"}')
    with pytest.raises(Exception, match="wrong file"):
        evidence.require_ids_match(evidence.read_dimension(spark, str(tmp_path), "id string")).collect()


def test_markdown_tables(spark, tmp_path):
    (tmp_path / "acme.md").write_text("# x\n|Name|Code|Set|R|G|B|Hex|\n|---|---|---|---|---|---|---|\n|Red|12|Base|1|2|3|![#FF0000](x) `#FF0000`|\n|Bad|13|Base|1|2|3|none|\n|Old||Base (discontinued)|1|2|3|`#00FF00`|\n")
    (tmp_path / "stranger.md").write_text("|Name|Set|R|G|B|Hex|\n|Red|Base|1|2|3|`#FF0000`|\n")
    got = tables.read_paint_tables(spark, str(tmp_path), {"acme": "Acme"}).orderBy("place").collect()
    assert [(r.brand, r.name, r.code, r.set_name, r.r, r.g, r.discontinued) for r in got] == [("Acme", "Red", "12", "Base", 255, 0, False), ("Acme", "Old", None, "Base (discontinued)", 0, 255, True)]


def test_labels(spark):
    rows, labels = spark.createDataFrame([("a",), (None,)], "s string"), spark.createDataFrame([("a", "A")], "slug string, label string")
    assert sorted((r.s or "", r.l) for r in tables.with_labels(rows, labels, "s", "l").collect()) == [("", None), ("a", "A")]
    with pytest.raises(Exception, match="no label"):
        tables.with_labels(spark.createDataFrame([("b",)], "s string"), labels, "s", "l").collect()


def test_platform_payloads(spark):
    go = lambda name, body: strategies.STRATEGIES[name](payload(spark, body), "src").first()
    r = go("shopify", {"products": [{"handle": "h", "title": "T", "vendor": "V", "product_type": "P", "tags": [], "variants": [{"sku": "1", "barcode": "4006381333931", "price": "1,200.50", "available": True}]}]})
    assert (r.key, r.ean, r.price, r.availability, r.hints["vendor"]) == ("src:h", "4006381333931", 1200.5, "in_stock", "V")
    r = go("woo-store-api", [{"id": 7, "name": "A &amp; B", "sku": "", "permalink": "u", "prices": {"price": "1250", "currency_minor_unit": 2}, "is_in_stock": False, "categories": [{"slug": "z"}, {"slug": "a"}]}])
    assert (r.key, r.name, r.sku, r.price, r.availability, r.hints["category"]) == ("src:7", "A & B", None, 12.5, "out_of_stock", "a,z")
    r = go("algolia", {"hits": [{"objectID": "prod-99", "name": "first", "price": 1.0, "gameHierarchy": "Root > Toads"}, {"objectID": "prod-99", "name": "second"}]})
    assert (r.name, r.sku, r.hints["faction"]) == ("first", "99", "Toads")
    r = go("appsync", {"data": {"products": {"products": [{"id": "1", "name": "n", "sku": "s", "inventory": 0, "preorder": True, "seo": ["x"]}]}}})
    assert r.availability == "pre_order"
    r = strategies.STRATEGIES["reaper"](spark.createDataFrame([('x products = [{"sku":"09001","name":"n","price":399,"images":[{"type":"side","order":1,"url":"a"},{"type":"main","order":5,"url":"b"}]}];',)], "body string"), "src").first()
    assert (r.sku, r.price, r.hints["image"]) == ("09001", 3.99, "b")
    r = go("wp-rest-paints", [{"id": 3, "slug": "red-70-950", "title": {"rendered": "<b>Red</b>"}}])
    assert (r.name, r.sku) == ("Red", "70-950")


def test_sitemaps_pages_captures_and_sheets(spark):
    xml = spark.createDataFrame([('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://e.org/p/1 </loc></url><url><loc>https://e.org/blog</loc></url></urlset>',)], "body string")
    assert [r.url for r in strategies.sitemap_urls(xml, "/p/").collect()] == ["https://e.org/p/1"]
    page = spark.createDataFrame([("https://e.org/p/1", '<h1>Name | Shop</h1><div itemtype="https://schema.org/Product"><meta itemprop="gtin13" content="4006381333931"></div>')], "url string, body string")
    r = strategies.structured_pages(page, "s").first()
    assert (r.key, r.name, r.ean, r.hints) == ("s:/p/1", "Name", "4006381333931", {"eanFrom": "microdata"})
    caps = spark.createDataFrame([("http://e.org/a?x", "2020", "200"), ("https://e.org/a", "2021", "200"), ("https://e.org/a", "2022", "404")], "original string, timestamp string, status string")
    assert strategies.latest_captures(caps, "s").first().hints == {"archiveTimestamp": "2021"}
    sheet = spark.createDataFrame([(1, "withdrawn", "c", None, "4006381333931", "0"), (2, "current", "c", "N", None, "£5.00")], "seq int, role string, code string, name string, barcode string, price string")
    r = strategies.trade_sheets(sheet, "s").first()
    assert (r.name, r.ean, r.price, r.hints["status"]) == ("N", "4006381333931", None, "current")
    old = spark.createDataFrame([("https://e.org/a", "2021", "<title>Frogs - Shop</title> 12345678901 £3.50"), ("https://e.org/b", "2021", "")], "original string, timestamp string, body string")
    both = caps.unionByName(spark.createDataFrame([("https://e.org/b", "2021", "200"), ("https://e.org/c", "2021", "200")], "original string, timestamp string, status string"))
    assert [(r.key, r.name, r.sku, r.price) for r in strategies.latest_captures(both, "s", include="^/[ab]", snapshots=old).collect()] == [("s:/a", "Frogs", "12345678901", 3.5)]
    cells = [("x", "current", 1, ["Price list", None, None, None]), ("x", "current", 2, ["Code", " Description ", "Barcode", "Release date"]), ("x", "current", 3, ["c1", "One", "5011921139590", "2023-01-01"]), ("x", "current", 4, ["c2", "Two", "4006381333931", "2030-01-01"]), ("x", "current", 5, [None, "sum", None, None]), ("x", "current", 6, ["c3", "Three", "4006381333931", None])]
    lines = strategies.sheet_rows(spark.createDataFrame(cells, "sheet string, role string, line int, cells array<string>"))
    got = {r.key: (r.name, r.ean) for r in strategies.trade_sheets(lines, "s", prefixes=["50"], run_date="2024-01-01").collect()}
    assert got == {"s:c1": ("One", "5011921139590" if got["s:c1"][1] else None), "s:c3": ("Three", None)}
    slices = spark.createDataFrame([("a", '{"hits":[{},{}],"nbHits":3,"nbPages":1}'), ("b", '{"hits":[{}],"nbHits":2,"nbPages":2}'), ("b", '{"hits":[{}],"nbHits":2,"nbPages":2}')], "slice string, body string")
    assert [(r.slice, r.hits) for r in strategies.capped_slices(slices).collect()] == [("a", 3)]
    body = payload(spark, {"products": [{"handle": h, "title": h, "vendor": v, "variants": [{"sku": "1"}]} for h, v in (("h1", "Acme"), ("h2", "ACME "), ("h3", "Other"), ("h4", "Acme"))]})
    makers, known = spark.createDataFrame([("acme", "ac"), ("other", "ot")], "vendor string, slug string"), spark.createDataFrame([("h4", "4006381333931")], "key string, ean string")
    assert sorted((r.key, r.manufacturer, r.ean) for r in strategies.shopify(body, "s", vendors=["Acme", "ACME "], manufacturers=makers, details=known).collect()) == [("s:h1", "ac", None), ("s:h4", "ac", "4006381333931")]
    found = spark.createDataFrame([("4006381333931", "Acme thing", "", ["ACME"]), ("4006381333931", "else", "", ["ACME"])], "ean string, title string, brand string, names array<string>")
    assert strategies.barcode_lookups(found, "s").count() == 1


def test_captures_data_source(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1.html").write_text("hello")
    spark.dataSource.register(fixtures.Captures)
    assert [tuple(r) for r in spark.read.format("captures").load(str(tmp_path)).collect()] == [("https://example.org/p/1.html", 200, "hello")]
    assert fixtures.backoff(1, 503) == 2 and fixtures.backoff(1, 429, 99) == 30 and fixtures.backoff(3, 503) is None and fixtures.backoff(1, 404) is None


def test_robots(spark):
    rules = robots.parse("User-agent: a\nUser-agent: bot\nDisallow: /x\nAllow: /x/y\n\nUser-agent: *\nDisallow:\nDisallow: /\n")
    assert robots.group_for(rules, "MyBot/1") == [("/x", False), ("/x/y", True)] and robots.group_for(rules, "zzz") == [("/", False)]
    paths = spark.createDataFrame([(1, "/x/1"), (2, "/x/y/2"), (3, "/z")], "id int, path string")
    got = robots.allowed(paths, robots.rules_table(spark, robots.group_for(rules, "bot")), "id")
    assert {r.id: r.allowed for r in got.collect()} == {1: False, 2: True, 3: True}


def test_all_identities_must_be_allowed(spark):
    body = "User-agent: one\nDisallow: /a\nCrawl-delay: 2\n\nUser-agent: two\nCrawl-delay: x\nCrawl-delay: 9\nDisallow: /b\n\nUser-agent: *\nCrawl-delay: 1\nDisallow: /c\n"
    paths = spark.createDataFrame([(1, "/a"), (2, "/b"), (3, "/c"), (4, "/d")], "id int, path string")
    got = robots.allowed_to_all(paths, robots.parse(body), ["One/1.0 (x)", "Two/2"], "id").collect()
    assert {r.id: (r.allowed, r.by) for r in got} == {1: (False, "One/1.0 (x)"), 2: (False, "Two/2"), 3: (True, None), 4: (True, None)}
    delays = robots.crawl_delays(body)
    assert robots.delay_for(delays, ["One/1.0", "Two/2"]) == 9 and robots.delay_for(delays, ["one", "three"]) == 2 and robots.delay_for([], ["one"]) is None
    with pytest.raises(ValueError, match="no site"):
        robots.allowed(paths, spark.range(10_001).selectExpr("'/x' AS pattern", "true AS allow"), "id")


def test_yaml_round_trips(spark, tmp_path):
    value = {"name": "Frogs: big", "n": 1, "x": 1.5, "on": "yes", "code": "0012", "date": "2024-01-02", "t": True, "none": None, "list": [{"a": "b", "c": ["- d", "e # f"]}, "plain text", [1, 2]], "empty": [], "map": {}, "lines": "a\nb", "é": "ü", "hex": "#aabbcc", "k:": "v:"}
    text = "\n".join(yaml_text.emit(value))
    assert yaml_text.parse(text) == {k: v for k, v in value.items() if v is not None}
    assert 'code: "0012"' in text and 'on": "yes"' in text and "none" not in text and yaml_text.parse("# c\n---\na:\n- b\n- c: 1\n  d: 'it''s'\n") == {"a": ["b", {"c": 1, "d": "it's"}]}
    rows = spark.createDataFrame([("p", 2, "b", None), ("p", 1, "a", "x"), ("q", 3, "007", None)], "part string, id int, name string, note string")
    docs = yaml_text.partition_documents(rows, "part", ["id"])
    assert {r["partition"]: r.body for r in docs.collect()}["p"] == "- id: 1\n  name: a\n  note: x\n- id: 2\n  name: b\n"
    yaml_text.write_yaml(docs, str(tmp_path / "y"))
    back = yaml_text.read_yaml(spark, str(tmp_path / "y"), "id int, name string, note string").select("partition", "id", "name", "note")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    state = spark.createDataFrame([(2, {"b": "1", "a": "2"})], "z int, m map<string,string>")
    assert state.select(yaml_text.cursor_body(F.struct("z", "m"))).first()[0] == 'm:\n  a: "2"\n  b: "1"\nz: 2\n'


def test_yaml_keeps_what_texts_look_like():
    odd = {"a": "nan", "b": "Infinity", "c": "0123", "d": "5 # note", "e": "a\nb", "f": "a\nb\n", "g": "x\n\ny\n\n", "h": ["p\nq", {"z": "r\ns\n"}, ["t\nu"], "1_000"], "i": float("inf"), "j": 1.5e10, "k": -3, "l": "+5", "n": " lead\nx", "o": "1e5", "p": "tab\tx\ny", "last": "q\n\n"}
    text = "\n".join(yaml_text.emit(odd)) + "\n"
    assert yaml_text.parse(text) == odd and "e: |-\n  a\n  b\nf: |\n  a\n  b\n" in text
    assert yaml_text.parse("a: 0123\nb: 5 # note\nc: [x, 'y z', 3, {k: v, \"q\": [1, 2]}] # c\ne: |\n  one\n   two\n\n  three\ng: 1.5\nh: 'a: b' # c\ni: # none\nj:\n- x#y\n") == {"a": "0123", "b": 5, "c": ["x", "y z", 3, {"k": "v", "q": [1, 2]}], "e": "one\n two\n\nthree\n", "g": 1.5, "h": "a: b", "i": None, "j": ["x#y"]}
    draw = random.Random(3)
    some = lambda: "".join(draw.choice("ab:#-'\"\n ,[]{}|0157.enyof&*!%@`~\\") for _ in range(draw.randrange(9)))
    for _ in range(3000):
        value = {some(): draw.choice([some(), [some(), {some(): some()}], {some(): [[some()]]}, 5, -2.5, True, []]) for _ in range(3)}
        assert yaml_text.parse("\n".join(yaml_text.emit(value)) + "\n") == value


def test_documents_are_checked_against_a_schema(spark):
    schema = {"type": "object", "required": ["items", "kind"], "additionalProperties": False, "properties": {"kind": {"const": "paint"}, "items": {"type": "array", "minItems": 1, "items": {"type": "object", "properties": {"hex": {"type": ["string", "null"], "pattern": "^#[0-9a-f]{6}$"}, "n": {"type": "integer", "minimum": 1}}}}}}
    docs = spark.createDataFrame([("ok", '{"kind":"paint","items":[{"hex":"#aabbcc","n":1},{"hex":null}]}'), ("bad", '{"kind":"x","items":[{"hex":"red","n":0},{"n":true}],"more":1}'), ("none", "{"), ("gone", '{"items":[]}')], "partition string, body string")
    assert {r["partition"]: list(r.errors) for r in publish.against_schema(docs, schema).collect()} == {
        "bad": ["/kind: not an allowed value", "/items/0/hex: pattern", "/items/0/n: minimum", "/items/1/n: not of type integer", "/more: not allowed"], "none": ["/: no JSON"], "gone": ["/kind: missing", "/items: minItems"],
    }


def test_a_broken_contract_leaves_the_state(spark):
    state = spark.createDataFrame([], "key string, name string, first_seen date, last_seen date, miss_streak int")
    body = payload(spark, {"hits": [{"objectID": "p-1", "name": "n"}]})
    good = run_source(body, "algolia", "s", state, "2024-01-01", Contract(1, 50, {"name": 1.0}), full_sweep=True, last_good=2)
    assert good.ok and [tuple(r)[:2] for r in good.state.collect()] == [("s:p-1", "n")]
    bad = run_source(body, "algolia", "s", state, "2024-01-01", Contract(1, 50, {"ean": 0.5}), full_sweep=True, last_good=3)
    assert not bad.ok and bad.failed == ["ean", "drop"] and bad.state is state
    assert F is not None
