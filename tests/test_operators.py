import pytest
from pyspark.sql import functions as F

from ledgerforge.operators import enrich, ledger, quality
from ledgerforge.operators import resolve as R
from ledgerforge.plans import publish

OBS = "key string, source string, kind string, priority int, manufacturer string, code string, ean string, name string"


def obs(spark, *rows):
    return spark.createDataFrame(rows, OBS)


def slug():
    return F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-")


def test_resolve_links_by_code_barcode_and_name(spark):
    rows = obs(
        spark,
        ("m:1", "m", "manufacturer", 1, "mk", "99-1", "111", "Frogs"), ("r:1", "r", "retailer", 2, "mk", None, "111", "Ork Frogs"), ("s:1", "s", "retailer", 2, "mk", None, None, "Frogs"),
        ("b:1", "b", "barcode-db", 4, "mk", None, "111", "x"), ("b:2", "b", "barcode-db", 4, "mk", None, "999", "y"), ("o:1", "o", "retailer", 2, "other", None, "111", "Frogs"),
    )
    got = {r.key: r.entity for r in R.resolve(rows, slug()).collect()}
    assert got == {"m:1": "mk/99-1", "r:1": "mk/99-1", "s:1": "mk/99-1", "b:1": "mk/99-1", "o:1": "other/frogs"}
    assert [r.key for r in R.unjoined_barcode_claims(rows).collect()] == ["b:2"]
    assert [(r.ean, r.owner, r.claimants) for r in R.disputed(rows).collect()] == [("111", "mk", ["b:1", "m:1", "o:1", "r:1"])]


def test_an_ambiguous_name_joins_nothing(spark):
    rows = obs(spark, ("a", "a", "retailer", 2, "mk", "1", None, "Box"), ("b", "b", "retailer", 2, "mk", "2", None, "Box"), ("c", "c", "retailer", 2, "mk", None, None, "Box"))
    assert {r.key: r.entity for r in R.resolve(rows, slug()).collect()}["c"] == "mk/box"


def test_forced_joins_chain_follow_aliases_and_outrank_names(spark):
    row = lambda key, n, code, ean, name, kind="retailer": (key, key, kind, n, "mk", code, ean, name)
    rows = obs(
        spark, row("a", 1, None, "501", "Alpha"), row("b", 2, "B1", None, "Beta"), row("z", 3, None, None, "Zeta"), row("y", 2, "Y9", None, "Zeta"),
        row("d", 4, None, "599", "Delta", "barcode-db"), row("e", 4, None, "598", "Eps", "barcode-db"), row("w", 2, "W1", None, "Wu"), row("v", 3, "W2", None, "Vu"), row("n", 3, None, None, "Wu"),
    )
    aliases = spark.createDataFrame([("mk/B1", "mk/new"), ("mk/old", "mk/W1")], "old string, new string")
    # z's target is B1's old id, and d's an alias of W1; a's target is nobody's
    joins = spark.createDataFrame([("d", "mk/old"), ("z", "mk/B1"), ("a", "mk/none"), ("v", "mk/W1"), ("gone", "mk/W1")], "key string, entity string")
    out = R.resolve(rows, slug(), aliases=aliases, joins=joins)
    got = {r.key: r.entity for r in out.collect()}
    assert got == {"a": "mk/alpha", "b": "mk/new", "z": "mk/new", "y": "mk/Y9", "d": "mk/W1", "w": "mk/W1", "v": "mk/W1", "n": "mk/W1"}
    assert [tuple(r) for r in R.unlanded(rows, joins, out, aliases).collect()] == [("a", "mk/none")]
    # m's target arises only from the union of x and c, which comes later in the order of keys
    rows = obs(spark, row("m", 3, None, "701", "Mu"), row("x", 1, None, "702", "Xi"), row("c", 2, "C7", None, "Chi", "retailer"), ("q", "q", "manufacturer", 0, "ot", None, "703", "Qu"))
    joins = spark.createDataFrame([("m", "ot/C7"), ("q", "mk/C7")], "key string, entity string")
    out = R.resolve(rows, slug(), joins=joins)
    assert {r.key: r.entity for r in out.collect()} == {"m": "ot/C7", "q": "ot/C7", "c": "ot/C7", "x": "mk/xi"}
    assert [r.key for r in R.unlanded(rows, joins, out).collect()] == ["q"]
    assert R.unlanded(rows, joins.limit(0), R.resolve(rows, slug(), joins=joins.limit(0))).count() == 0


def test_survivors_keep_empty_texts(spark):
    rows = obs(spark, ("a", "a", "curated", 0, "mk", None, None, ""), ("b", "b", "retailer", 2, "mk", "1", None, "Box")).withColumn("comp", F.lit(1))
    assert tuple(R.survivors(rows, "comp", ["code", "name"]).first()) == (1, "1", "")


def test_confidence_needs_an_authority_or_two_sources(spark):
    rows = obs(
        spark, ("a", "a", "retailer", 2, "m", None, "1", "n"), ("b", "b", "barcode-db", 4, "m", None, "1", "n"), ("c", "c", "retailer", 2, "m", None, "2", "n"), ("d", "d", "barcode-db", 4, "m", None, "3", "n"), ("e", "e", "barcode-db", 4, "m", None, "3", "n")
    ).withColumn("comp", F.lit(1))
    assert {r.ean: r.confidence for r in R.ean_assertions(rows).collect()} == {"1": "confirmed", "2": "provisional", "3": "provisional"}


def test_live_rows_of_the_surviving_code_decide_on_barcodes(spark):
    c, m, r, a, d = ("c", "curated", 0), ("m", "manufacturer", 1), ("r", "retailer", 2), ("a", "archive", 3), ("d", "barcode-db", 4)
    cases = {  # source, code, ean, live, forced; the entity's code is 1
        "mk/1": [(c, "1", "11", False, False), (m, "1", "22", True, False)],  # a stale curated barcode gives way
        "ml/1": [(m, "1", "22", True, False), (r, "2", "33", True, False)],  # a loser of a foreign code: bridged
        "mn/1": [(m, "1", "22", True, False), (m, "2", "11", True, True), (c, "2", "11", False, False)],  # repackaged
        "mo/1": [(c, "1", "11", False, False), (r, "1", "22", True, False), (d, "1", "00", True, False)],  # no live manufacturer
        "mp/1": [(m, "1", "22", True, False), (m, "1", "11", True, False)],  # two of a live manufacturer
        "mq/1": [(r, "1", "11", True, False), (r, "1", "22", True, False), (m, "2", "33", True, True)],  # repackaged and in conflict
        "mr/x": [(m, "1", "22", True, False), (c, "2", "11", False, False)],  # no surviving code
        "ms/1": [(a, "1", "11", True, False), (r, None, "11", True, False)],
    }
    rows = [(f"{e}:{k}", s, kind, n, code, ean, live, e, forced) for e, xs in cases.items() for k, ((s, kind, n), code, ean, live, forced) in enumerate(xs)]
    rows = spark.createDataFrame(rows, "key string, source string, kind string, priority int, code string, ean string, live boolean, entity string, forced boolean")
    marked = R.superseded(rows.drop("forced"), rows.where("forced").select("key"))
    primary = R.corroborated_eans(marked)
    assert {x.entity: (x.ean, x.confidence, x.others, x.decision, x.disputed) for x in primary.collect()} == {
        "mk/1": ("22", "confirmed", ["11"], "authority", []), "ml/1": ("22", "conflicted", [], "conflicted", ["22", "33"]), "mn/1": ("22", "confirmed", ["11"], "repackaged", []),
        "mo/1": ("22", "conflicted", [], "conflicted", ["00", "11", "22"]), "mp/1": ("11", "conflicted", [], "conflicted", ["11", "22"]), "mq/1": ("11", "conflicted", ["33"], "repackaged", ["11", "22"]),
        "mr/x": ("22", "confirmed", ["11"], "authority", []), "ms/1": ("11", "confirmed", [], "single", []),
    }
    assert {x.ean: x.further_in for x in R.shared_eans(primary, "entity").collect()}["11"] == ["mk/1", "mn/1", "mr/x"]
    assert R.survivors(marked, "entity", ["ean"]).where("entity = 'mq/1'").first().ean == "33"
    old = marked.where("entity = 'mn/1' AND kind = 'manufacturer'").withColumn("key", F.when(F.col("superseded"), "0").otherwise("9"))
    assert R.survivors(old, "entity", ["ean"]).first().ean == "22"


def test_lifecycle_goes_by_liveness(spark):
    rows = [
        ("a", "manufacturer", 1, "k", False, 3, None), ("a", "retailer", 2, "k", False, 9, None), ("a", "barcode-db", 4, "k", False, 0, None),  # all missed
        ("b", "retailer", 2, "k", False, 2, None), ("b", "archive", 3, "k", True, 0, None), ("c", "archive", 3, "k", True, 0, None), ("c", "barcode-db", 4, "k", False, 0, None),
        ("d", "curated", 0, "k", False, 9, "limited"), ("e", "curated", 0, "k", False, 0, None), ("f", "curated", 0, "k", False, 0, "delisted"), ("f", "retailer", 2, "k", False, 0, None), ("g", "manufacturer", 1, "k", False, 0, "delisted"),
    ]
    rows = spark.createDataFrame(rows, "id string, kind string, priority int, key string, archived boolean, miss_streak int, claimed string")
    got = {r.id: (r.status, r.availability_unknown) for r in R.lifecycle(rows, "id").collect()}
    assert got == {"a": ("suspected-discontinued", True), "b": ("current", False), "c": ("discontinued", False), "d": ("limited", False), "e": ("current", False), "f": ("delisted", False), "g": ("current", False)}


def test_retracted_targets_are_refused(spark):
    gone, joins = spark.createDataFrame([("m/1",)], "entity string"), spark.createDataFrame([("k", "m/1")], "key string, entity string")
    with pytest.raises(ValueError, match="join targets are retracted"):
        R.require_live_targets(gone, None, joins)
    with pytest.raises(ValueError, match="alias targets are retracted"):
        R.require_live_targets(gone, spark.createDataFrame([("m/0", "m/1")], "old string, new string"))


def test_patches_set_nulls_too(spark):
    base = spark.createDataFrame([(1, "a", "b")], "id int, x string, y string")
    patch = spark.createDataFrame([(1, "x", None)], "id int, field string, value string")
    assert tuple(R.patched(base, patch, "id", ["x", "y"]).first()) == (1, None, "b")
    with pytest.raises(Exception, match="no such field: z"):
        R.patched(base, patch.withColumn("field", F.lit("z")), "id", ["x", "y"]).collect()


def test_upsert_is_idempotent_and_partial_sweeps_miss_nothing(spark):
    day = "key string, name string, first_seen string, last_seen string, miss_streak int"
    state = spark.createDataFrame([("a", "old", "2024-01-02", "2024-01-02", 2), ("b", "b", "2024-01-01", "2024-01-01", 0)], day)
    seen = spark.createDataFrame([("a", "new", "2024-01-03", "2024-01-03", 0)], day)
    once = ledger.upsert(state, seen)
    assert sorted(map(tuple, once.collect())) == [("a", "new", "2024-01-02", "2024-01-03", 0), ("b", "b", "2024-01-01", "2024-01-01", 0)]
    assert sorted(map(tuple, ledger.upsert(once, seen).collect())) == sorted(map(tuple, once.collect()))
    assert {r.key: r.miss_streak for r in ledger.mark_missed(state, seen, full_sweep=True).collect()} == {"a": 2, "b": 1}
    assert ledger.mark_missed(state, seen, full_sweep=False) is state


def test_a_flag_is_raised_once(spark):
    rec = spark.createDataFrame([("p", "s", "d0", 2, False), ("q", "s", "d0", 3, True), ("r", "s", "d0", 4, True)], "path string, source string, last_seen string, miss_streak int, flagged boolean")
    src = spark.createDataFrame([("s", True, "d1")], "source string, succeeded boolean, run_date string")
    got = {r.path: (r.miss_streak, r.flagged, r.event) for r in ledger.liveness(rec, rec.where("path = 'r'"), src).collect()}
    assert got == {"p": (3, True, "flag"), "q": (4, True, None), "r": (0, False, "reactivate")}


def test_reconcile_renames_once_and_keeps_history(spark):
    kind = "key string, url string, name string, status string, first_seen string"
    archive = spark.createDataFrame([("k1", "u1", "one", "current", "2020"), ("k2", "u2", "two", "current", "2020"), ("k9", "u9", "nine", "current", "2020")], kind)
    new = spark.createDataFrame([("k1", "u1", " ", "discontinued", "2024"), ("n2", "u2", "zwei", "current", "2024"), ("n3", "u2", "drei", "current", "2024"), ("x", None, "gone", "current", "2024")], kind)
    none, gone = spark.createDataFrame([], "new string, old string"), spark.createDataFrame([("x",)], "key string")
    got = ledger.reconcile(archive, new, none, gone)
    want = [("k1", "u1", "one", "discontinued", "2020"), ("k9", "u9", "nine", "current", "2020"), ("n2", "u2", "zwei", "current", "2020"), ("n3", "u2", "drei", "current", "2024")]
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, ledger.reconcile(got, new, none, gone).collect())) == want


def test_renames_go_by_the_order_of_keys(spark):
    kind = "key string, url string, name string, status string, first_seen string"
    row = lambda k, u: (k, u, k, "current", "2020")
    archive = spark.createDataFrame([row("t1", "u1"), row("t2", "u2"), row("t3", "u3"), row("t4", "u4"), row("gone", "u5"), row("same", "u6")], kind)
    # a takes t1 by its alias before b can by its URL, so b takes t2 by its alias before c can by its URL; d's target is retracted; e comes twice
    new = spark.createDataFrame([row("a", None), row("b", "u1"), row("c", "u2"), row("d", "u5"), ("e", "u8", "first", "current", "2024"), ("e", "u9", "second", "current", "2024"), row("same", "u4")], kind)
    aliases = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("c", "t1"), ("d", "gone")], "new string, old string")
    got = {r.key: (r.url, r.name) for r in ledger.reconcile(archive, new, aliases, spark.createDataFrame([("gone",)], "key string")).collect()}
    assert got == {"a": ("u1", "a"), "b": ("u1", "b"), "c": ("u2", "c"), "d": ("u5", "d"), "e": ("u8", "first"), "same": ("u4", "same"), "t3": ("u3", "t3"), "t4": ("u4", "t4")}


def test_suffix_joins_refuse_ties(spark):
    claims = spark.createDataFrame([("c1", "x-abcdef"), ("c2", "zzdup12")], "claim string, text string")
    dim = spark.createDataFrame([(1, "bcdef"), (2, "abcdef"), (3, "dup12"), (4, "dup12")], "id int, name string")
    assert [tuple(r) for r in enrich.longest_suffix(claims, dim).collect()] == [("c1", 2)]


def test_fuzzy_takes_the_most_alike(spark):
    claims = spark.createDataFrame([("c", "dark ink", "b"), ("d", "zzz", "b")], "claim string, name string, block string")
    dim = spark.createDataFrame([(1, "dark inkk", "b"), (2, "dark ink gloss", "b"), (3, "dark ink", "other")], "id int, name string, block string")
    assert [(r.claim, r["match"]) for r in enrich.fuzzy(claims, dim, "block").collect()] == [("c", 1)]


def test_guards(spark):
    now = spark.createDataFrame([("1", "a"), ("2", "b")], "ean string, entity string")
    old = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a")], "ean string, entity string")
    assert sorted(map(tuple, quality.snapshot_guard(old, now).collect())) == [("2", "a", "moved"), ("3", "a", "lost")]
    with pytest.raises(ValueError, match="refusing"):
        quality.refuse_to_wipe(now.limit(0), True)


def test_published_documents_match_their_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("p", 2, "b", None), ("p", 1, "a", "x"), ("q", 3, "c", None)], "part string, id int, name string, note string")
    docs = publish.documents(rows, "part", ["id"], "paint", "2024.1.2")
    body = {r["partition"]: r.body for r in docs.collect()}["p"]
    assert '"items":[{"id":1,"name":"a","note":"x"},{"id":2,"name":"b"}]' in body
    back = publish.write_documents(docs, str(tmp_path / "out"))
    key = lambda df: sorted((r["partition"], r["bytes"], r["sha256"]) for r in df.collect())
    assert key(back) == key(docs)
    with pytest.raises(ValueError, match="break rules"):
        publish.write_documents(docs, str(tmp_path / "bad"), {"small": F.col("bytes") < 5})
