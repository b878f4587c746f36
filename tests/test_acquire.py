"""Walks, runs of sources with their store, fields of pages by origin."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerforge.functions import elements, extract
from ledgerforge.plans import runner
from ledgerforge.plans.runner import Contract, Source, run
from ledgerforge.sources import files, frontier, paint_shops, strategies
from ledgerforge.sources.store import SourceStore
from ledgerforge.sources.strategies import STRATEGIES


def payload(spark, body):
    return spark.createDataFrame([(json.dumps(body), 0)], "body string, place int")


def test_sitemaps_of_sitemaps_end(spark):
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc> {u} </loc></sitemap>" for u in urls) + "</sitemapindex>"
    pages = lambda *urls: '<urlset xmlns="http://x">' + "".join(f"<url><loc>{u}</loc></url>" for u in urls) + "</urlset>"
    rows = [("r", index("a", "b", "gone").encode()), ("a", index("r", "a", "c").encode()), ("b", gzip.compress(pages("p1", "p2").encode())), ("c", gzip.compress(pages("p2", "p3").encode())), ("c", None), ("odd", b"<feed/>"), ("cut", gzip.compress(b"<urlset>" * 9)[:-9]), ("lost", pages("p9").encode())]
    captures = spark.createDataFrame(rows, "url string, content binary")
    urls, seen = frontier.sitemap_frontier(captures, spark.createDataFrame([("r",), ("odd",), ("cut",), ("r",), (None,)], "url string"))
    assert sorted(r.url for r in urls.collect()) == ["p1", "p2", "p3"]
    assert dict(map(tuple, seen.collect())) == {"r": "sitemapindex", "a": "sitemapindex", "b": "urlset", "c": "urlset", "gone": "missing", "odd": "feed", "cut": "broken"}
    assert all(x.count() == 0 for x in frontier.sitemap_frontier(captures, spark.createDataFrame([], "url string")))


def test_listings_are_walked_in_order(spark):
    links = [(f"a{k}", f"a{k + 1}") for k in range(50)] + [("a50", "a10"), ("b0", "b1"), ("b1", "b0"), ("c0", None), ("d0", "nowhere"), ("e0", "e0"), ("b0", "z9")]
    walked = frontier.listing_walk(spark.createDataFrame(links, "url string, next string"), spark.createDataFrame([(x, f"{x}0") for x in "abcdex"], "walk string, url string"))
    got = {}
    for r in walked.collect():
        got.setdefault(r.walk, {})[r.place] = r.url
    assert got == {"a": {k: f"a{k}" for k in range(51)}, "b": {0: "b0", 1: "b1"}, "c": {0: "c0"}, "d": {0: "d0"}, "e": {0: "e0"}}
    items = spark.createDataFrame([("a2", 0, "Red", 1), ("a1", 1, "RED", 2), ("a1", 0, " ", 3), ("a1", 2, "Blue", 4)], "url string, at int, name string, n int")
    assert sorted((r.name, r.n) for r in frontier.names_in_order(walked.where("walk = 'a'"), items).collect()) == [("Blue", 4), ("RED", 2)]


def test_slices_are_split_until_they_fit(spark):
    answer = lambda path, hits, facet, **values: (path, json.dumps({"nbHits": hits, "facets": {facet: values}}))
    rows = [answer([], 100, "x", a=10, b=60, c=30), answer(["b"], 60, "y", p=5, q=40), answer(["b", "q"], 40, "z", m=39), answer(["a"], 10, "y", p=1)]
    got = frontier.plan_slices(spark.createDataFrame(rows, "path array<string>, body string"), ["x", "y", "z"], 20).collect()
    assert sorted(("/".join(r.path), r.hits, r.state) for r in got) == [("a", 10, "fetch"), ("b", 15, "rest"), ("b/p", 5, "fetch"), ("b/q", 1, "rest"), ("b/q/m", 39, "capped"), ("c", 30, "capped")]
    whole = frontier.plan_slices(spark.createDataFrame([([], '{"nbHits": 3}')], "path array<string>, body string"), ["x"], 20)
    assert [(r.path, r.hits, r.state) for r in whole.collect()] == [([], 3, "fetch")]


def sources(spark):
    """A source of every strategy with payloads for one observation."""
    frame = spark.createDataFrame
    makers = frame([("acme", "ac")], "vendor string, slug string")
    shop = {"products": [{"handle": "h", "title": "T", "vendor": "Acme", "product_type": "P", "tags": [], "images": [], "variants": [{"sku": "1", "price": "2", "available": True}]}]}
    woo = [{"id": 7, "name": "A", "sku": "s", "permalink": "u", "prices": {"price": "1250", "currency_minor_unit": 2}, "is_in_stock": True, "categories": [{"slug": "z"}], "images": []}]
    tile = '<li class="products__item"><a href="/en/products/detail/12"><p class="products__item-code">C1</p></a></li>'
    product = '<div itemscope itemtype="https://schema.org/Product"><h1 itemprop="name">N 60 ml</h1><meta itemprop="sku" content="k"></div>'
    return {
        "shopify": (payload(spark, shop), {"manufacturers": makers}), "woo-store-api": (payload(spark, woo), {"manufacturer": "m"}), "algolia": (payload(spark, {"hits": [{"objectID": "p-1", "name": "n"}]}), {}),
        "appsync": (payload(spark, {"data": {"products": {"products": [{"id": "1", "name": "Frogs", "sku": "s", "inventory": 1, "preorder": False, "seo": []}]}}}), {"factions": ["frogs"]}),
        "reaper": (frame([('x products = [{"sku":"09001","name":"n","price":399,"images":[]}];', 0)], "body string, place int"), {}),
        "wp-rest-paints": (payload(spark, [{"id": 3, "slug": "red-70-950", "title": {"rendered": "Red"}, "categories": [5], "featured_media": 9}]), {"terms": frame([(5, "Set")], "id long, name string"), "media": frame([(9, "i.png")], "id long, url string")}),
        "sitemap-structured-data": (frame([("https://e.org/p/1", product)], "url string, body string"), {}), "cdx-archive": (frame([("https://e.org/a", "2021", "200")], "original string, timestamp string, status string"), {}),
        "trade-sheets": (frame([(1, "current", "c", "N", "5011921139590", "1", "2023-01-01")], "seq int, role string, code string, name string, barcode string, price string, release string"), {"prefixes": ["50"]}),
        "barcode-db": (frame([("4006381333931", "Acme thing", "", ["ACME"])], "ean string, title string, brand string, names array<string>"), {}),
        "shopify-paints": (frame([(json.dumps(shop), "c", 0)], "body string, collection string, place int"), {"manufacturers": makers}), "woo-paints": (payload(spark, woo), {"manufacturer": "m"}),
        "sitemap-sd-paints": (frame([("https://e.org/inks/12-x.html", product)], "url string, body string"), {"urls": paint_shops.numbered_urls(frame([("https://e.org/inks/12-x.html?a",), ("https://e.org/inks/12-x.html",), ("https://e.org/blog/x.html",)], "url string")), "manufacturer": "m"}),
        "mr-hobby": (frame([("one", 0, tile)], "label string, place int, body string"), {"manufacturer": "m"}),
        "playwright-wp": (frame([("https://e.org/products/p1", "<h1>N</h1>")], "url string, body string"), {"lines": frame([], "url string, body string"), "systems": frame([], "line string, system string"), "manufacturer": "m"}),
    }


def test_every_strategy_runs(spark, tmp_path):
    store, made = SourceStore(spark, f"file://{tmp_path}/store"), sources(spark)
    assert set(made) == set(STRATEGIES)
    for name, (rows, options) in made.items():
        out = run(store, Source(f"src-{name}", name, options, Contract(1)), rows, "2024-01-01")
        held = store.load(f"src-{name}")
        assert out.ok and out.counters == {"observed": 1, "added": 1, "missed": 0, "held": 1}, name
        assert held.cursor == {"last_run_date": "2024-01-01", "last_good_count": 1 if out.full_sweep else None} and held.evidence.first().archived == (name == "cdx-archive")
        assert out.full_sweep == (name not in ("cdx-archive", "barcode-db", "trade-sheets"))


def test_runs_keep_evidence_and_cursor_together(spark, tmp_path):
    store = SourceStore(spark, f"file://{tmp_path}")
    hits = lambda *ids: payload(spark, {"hits": [{"objectID": f"p-{i}", "name": f"n{i}"} for i in ids]})
    source = Source("s", "algolia", {}, Contract(1, 50, {"name": 1.0}))
    assert run(store, source, hits(1, 2, 3, 4), "2024-01-01").count == 4
    out = run(store, source, hits(1, 2, 5), "2024-01-02")
    assert out.counters == {"observed": 3, "added": 1, "missed": 2, "held": 5} and store.load("s").cursor == {"last_run_date": "2024-01-02", "last_good_count": 3}
    # a broken contract leaves both
    broken = run(store, source, hits(1), "2024-01-03")
    assert not broken.ok and broken.failed == ["drop"] and store.load("s").version == 2 and store.load("s").cursor["last_run_date"] == "2024-01-02"
    # a run that dies before its pointer moves leaves what was
    held = store.load("s")
    (tmp_path / "s" / "v3" / "evidence").mkdir(parents=True)
    (tmp_path / "s" / "v3" / "evidence" / "part-0").write_text("half")
    assert store.load("s").version == 2 and sorted(r.key for r in held.evidence.collect()) == ["s:p-1", "s:p-2", "s:p-3", "s:p-4", "s:p-5"]
    assert run(store, source, hits(1, 2, 3), "2024-01-04").ok and store.load("s").version == 3 and files.children(spark, f"{store.path}/s") == ["CURRENT", "v2", "v3"]
    assert {r.key: r.miss_streak for r in store.load("s").evidence.collect()} == {"s:p-1": 0, "s:p-2": 0, "s:p-3": 0, "s:p-4": 2, "s:p-5": 1}


def test_progress_reaches_the_next_run(spark, tmp_path):
    store = SourceStore(spark, f"file://{tmp_path}")
    rows = payload(spark, [{"id": i, "name": f"n{i}", "sku": "", "permalink": "u", "prices": {"price": "1", "currency_minor_unit": 0}, "is_in_stock": True, "categories": []} for i in (1, 2)])
    known = lambda *pairs: {"details": spark.createDataFrame(list(pairs), "key string, ean string")}
    eans = lambda: {r.key: r.ean for r in store.load("w").evidence.collect()}
    source = Source("w", "woo-store-api")
    run(store, source, rows, "2024-01-01", complete=False, progress=known(("1", "4006381333931"), ("9", "5011921139590")))
    assert eans() == {"w:1": "4006381333931", "w:2": None} and store.load("w").cursor["last_good_count"] is None
    out = run(store, source, rows, "2024-01-02", progress=known(("2", "5011921139590")), keep={"details": spark.createDataFrame([("1",), ("2",)], "key string")})
    assert out.full_sweep and eans() == {"w:1": "4006381333931", "w:2": "5011921139590"}
    assert sorted(r.key for r in store.load("w").progress["details"].collect()) == ["1", "2"]
    assert runner.paint_shops is paint_shops


def test_microdata_by_scopes(spark):
    page = """<span itemprop="name">Home</span><div itemscope itemtype="https://schema.org/Product"><div itemprop="review" itemscope itemtype="https://schema.org/Review"><b itemprop="name">Great</b></div>
      <h1 itemprop="name">Ink <i>red</i></h1><span itemprop="brand" itemscope itemtype="https://schema.org/Brand"><meta itemprop="name" content="Acme"></span><img itemprop="image" src="i.png">
      <div itemprop="offers" itemscope itemtype="https://schema.org/Offer"><meta itemprop="price" content="1.5"><link itemprop="availability" href="https://schema.org/InStock"/></div><script>var x = "<b itemprop='sku'>no</b>";</script></div><p itemprop="sku">outside</p>"""
    rows = spark.createDataFrame([(1, page), (2, None), (3, "<p>no item"), (4, '<div itemtype="http://schema.org/Product" itemscope><p itemprop="brand">Plain<p itemprop="gtin13"> 4006381333931')], "k int, body string")
    got = {r.k: r.x for r in rows.select("k", elements.product("body").alias("x")).collect()}
    assert tuple(got[1]) == ("Ink red", None, None, None, "Acme", "1.5", None, "https://schema.org/InStock", "i.png")
    assert all(v is None for k in (2, 3) for v in got[k]) and (got[4].brand, got[4].gtin) == ("Plain 4006381333931", "4006381333931")


def test_labels_and_volumes(spark):
    rows = spark.createDataFrame([(["Size: big", "Net Amount: 10ml Product Number : X-1"], "x 17,5 ML y"), (["internet: 5ml"], "html 3"), ([], None)], "parts array<string>, name string")
    got = rows.select(elements.labelled(F.col("parts"), "net", "net amount").alias("a"), elements.labelled(F.col("parts"), "product number").alias("b"), extract.millilitres(F.col("name")).alias("c")).collect()
    assert [tuple(r) for r in got] == [("10ml Product Number", "X-1", 17.5), (None, None, None), (None, None, None)]


def test_detail_pages_are_asked_a_few_times(spark):
    tiles = spark.createDataFrame([("10", "u10"), ("9", "u9"), ("8", "u8"), ("7", "u7")], "id string, url string")
    found = spark.createDataFrame([("9",)], "id string")
    missing = spark.createDataFrame([("8", 2), ("7", 2)], "id string, misses int")
    missing = paint_shops.missed(missing, spark.createDataFrame([("8", 404), ("7", 500), ("9", 200), ("10", 200)], "id string, status int"), found)
    assert dict(map(tuple, missing.collect())) == {"8": 3, "7": 2, "10": 1}
    assert [r.id for r in paint_shops.detail_queue(tiles, found, missing).collect()] == ["7", "10"]


def test_pages_without_a_product_are_none(spark):
    rows = spark.createDataFrame([("https://e.org/a", "<h1>About us</h1>"), ("https://e.org/b", '<script>var BCData = {"product_attributes":{"sku":"E1","upc":"4006381333931"}};</script><title>Ink | Shop</title>')], "url string, body string")
    assert [(r.key, r.name, r.sku, r.ean, r.hints) for r in strategies.structured_pages(rows, "s").collect()] == [("s:/b", "Ink", "E1", "4006381333931", {"eanFrom": "embedded"})]
