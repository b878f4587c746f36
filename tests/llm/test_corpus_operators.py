import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ledgerforge.llm.chat import digests, escape, format_conversations, locate, parse_instruct, unescape
from ledgerforge.llm.classifier import classify, site_posteriors
from ledgerforge.llm.html_text import LAYOUT_SHARE, LEAST_PAGES, LEAST_SHARE, LEAST_TOKENS, Page, classes, extract, named, templates
from ledgerforge.llm.mixing import exponent, mix
from ledgerforge.llm.near_dups import block_links, near_duplicates
from ledgerforge.llm.packing import WordEncoder, first_fit, pack_documents, pack_pieces, token_pieces
from ledgerforge.llm.quality_rules import LINE_LIMIT, NGRAM_LIMITS, measure, quality_rules
from ledgerforge.llm.queries import TOKENIZER
from ledgerforge.llm.secrets import find_secrets, redact, secret_report
from ledgerforge.llm.topk import Block, top_k
from ledgerforge.llm.warc import CaptureIndex, archive_round_trip, lookup, read_archives, surt, write_archives, write_index

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, *texts, source=lambda k: f"s{k % 3}"):
    return spark.createDataFrame([(k, t, "en", source(k), len(t or "")) for k, t in enumerate(texts)], DOCS)


def prose(seed, n, words=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


# packing


def test_words_encode_as_whole_texts_do():
    encode = WordEncoder(TOKENIZER)
    texts = ["It's A.B., ça Éa! é. <|endoftext|>x don't İ H̱ \x1cq\xa0z 12.5 ½ あい ß Σς 'S '.s", "", "  ", "a.́ b,‍ ﬁ.", "x " * 50, "end."]
    want = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == [w.ids for w in want]
    small = WordEncoder(TOKENIZER, cache_words=3)
    assert [small(t) for t in texts * 2] == [encode(t) for t in texts * 2]


def test_first_fit_is_first_fit():
    draw = random.Random(1)
    lengths = np.array([draw.randrange(1, 101) for _ in range(300)])
    bins, offsets = first_fit(lengths, 100)
    room, want = [], {}
    for k in np.argsort(-lengths, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= lengths[k]), len(room))
        room += [100] * (at == len(room))
        want[k] = (at, 100 - room[at])
        room[at] -= lengths[k]
    assert {k: (bins[k], offsets[k]) for k in range(300)} == want


def test_pieces_cover_every_id_once(spark):
    texts = [None, "", "one two", prose(1, 5000), "one two", prose(2, 900)]
    rows = docs(spark, *texts).withColumn("deal", F.lit(1)).unionByName(docs(spark, "again").withColumn("deal", F.lit(2)))
    got = pack_documents(rows, TOKENIZER, group_pieces=3).collect()
    by, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id, r.doc_tokens].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    for (_, tokens), pieces in by.items():
        if len({s for s, _ in pieces}) == len(pieces):
            assert sum(n for _, n in pieces) == tokens and sorted(s for s, _ in pieces)[0] == 0
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in got) == sum(len(WordEncoder(TOKENIZER)(t or "")) // 4 + 1 for t in [*texts, "again"])
    assert pack_documents(rows.limit(0), TOKENIZER).count() == 0 and token_pieces(rows.limit(0), TOKENIZER).count() == 0


def test_pieces_equal_brute_force(spark):
    """Every piece's place, length and checksum, from the tokenizer itself; repeated ids and very long texts among them."""
    draw = random.Random(9)
    chars = ["a", "B", "é", "<", "|", ">", " ", "\n", "x.", "'s", "1", "あ", "\u0301", "İ", "ab cd "]
    texts = [None, "", "x" * 300_000, "word " * 70_000, *("".join(draw.choices(chars, k=draw.randrange(6000))) for _ in range(30))]
    rows = docs(spark, *texts).unionByName(docs(spark, "again", None))
    tokenizer, want = WordEncoder(TOKENIZER).tokenizer, Counter()
    for k, t in [*enumerate(texts), (0, "again"), (1, None)]:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((k, s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pack_documents(rows, TOKENIZER).collect()) == want


# near duplicates


def similar(a, b, n):
    sets = [{tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w := t.encode().lower().split()) >= n else ({tuple(w)} if w else set()) for t in (a, b)]
    return bool(sets[0]) and bool(sets[1]) and 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    draw, texts = random.Random(3), [None, "", "  ", "Single", "single", "two words", "TWO\twords\n"]
    for g in range(12):
        words = prose(g, 120).split()
        for _ in range(draw.choice([1, 2, 9])):
            new = words[:]
            for _ in range(draw.randrange(8)):
                new[draw.randrange(len(new))] = f"x{draw.randrange(99)}"
            texts.append(" ".join(new))
    rows = docs(spark, *texts).withColumn("sig", F.lit("clash")).withColumn("comp", F.lit(1))
    got = {r.doc_id: r for r in near_duplicates(rows, shingle=size).collect()}
    root = list(range(len(texts)))
    for _ in range(3):
        for a in range(len(texts)):
            for b in range(a):
                if similar(texts[a] or "", texts[b] or "", size):
                    root[a] = root[b] = min(root[a], root[b])
    assert [got[k].component_id for k in range(len(texts))] == root
    assert all(got[k].kept == (root[k] == k) for k in got) and got[0].n_shingles == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_the_corpus_equal_brute_force(spark, size):
    """Every link of all 1,000 documents of sf0.01, found by comparing all pairs that share a shingle."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    sets, holders = {}, defaultdict(list)
    for k, x in text.items():
        w = x.encode().lower().split()
        sets[k] = {b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} or ({b" ".join(w)} if w else set())
        for s in sets[k]:
            holders[s].append(k)
    shared = Counter((a, b) for ks in holders.values() for i, a in enumerate(ks) for b in ks[i + 1 :])
    links = [p for p, n in shared.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    root = {k: k for k in text}
    for _ in range(len(links)):
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_duplicates(rows, shingle=size).collect()}
    assert len(links) > 100 and got == {k: (root[k], len(sets[k])) for k in text}


@pytest.mark.parametrize("limit", [2_000, 20, 0])
def test_dense_regions_keep_every_link(spark, monkeypatch, limit):
    """Texts that share half of themselves, some with a near copy: the copies alone are linked, whatever is read deeper or by rare shingles."""
    draw, common = random.Random(4), [f"c{k}" for k in range(60)]
    texts = [" ".join(common + [f"o{draw.randrange(10**9)}" for _ in range(60)]) for _ in range(600)]
    copies = [" ".join(w if k not in (3, 70 + n % 40, 65) else f"n{n}" for k, w in enumerate(t.split())) for n, t in enumerate(texts[:60])]
    monkeypatch.setattr("ledgerforge.llm.near_dups.REGION_PAIRS", limit)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, *texts, *copies), shingle=2).collect()}
    assert got == {k: k if k < 600 else k - 600 for k in range(660)}


def test_near_duplicates_of_repeated_ids(spark):
    """An id with three texts, of which another id has one and a third id a near copy of another."""
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    near = lambda t: t + " more"
    rows = spark.createDataFrame([(5, a), (5, a), (5, b), (5, c), (3, b), (7, near(a)), (8, near(c)), (9, prose(4, 90))], "doc_id long, text string").repartition(3)
    runs = [sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(rows).collect()) for _ in range(2)]
    assert runs[0] == runs[1]
    got = Counter((d, c) for d, c, _ in runs[0])
    assert got[5, 3] == 1 and got[5, 5] == 3 and got[3, 3] == 1 and got[9, 9] == 1 and got[7, 5] + got[8, 5] == 1


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    """Sets so large that a block holds few of them give the same rows."""
    base = [prose(k, 300, 3000) for k in range(3)]
    texts = [" ".join(b.split()[: 300 - j]) for j in range(8) for b in base] + [prose(99, 300, 3000)]
    rows = docs(spark, *texts)
    want = sorted(map(tuple, near_duplicates(rows).collect()))
    monkeypatch.setattr("ledgerforge.llm.near_dups.BLOCK_SHINGLES", 700)
    assert sorted(map(tuple, near_duplicates(rows).collect())) == want and len({r[2] for r in want}) == 4


def test_very_long_texts(spark):
    """Texts of a million characters and more, whole."""
    long = prose(1, 200_000, 50_000)
    rows = docs(spark, long, long.replace("w1 ", "changed ", 40), "short " + prose(2, 20))
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(rows).collect()) == [(0, 0), (1, 0), (2, 2)]
    hidden = "x " * 600_000 + "token=Abc123Xyz" + " y" * 600_000
    [r] = secret_report(docs(spark, hidden)).collect()
    assert r.spans == "assign:1200000:1200015" and redact(docs(spark, hidden)).first().text == hidden.replace("token=Abc123Xyz", "<secret>")
    turns = spark.createDataFrame([(1, k, "assistant", "</s>" * 250_000) for k in range(2)], "conv_id long, turn long, role string, text string")
    assert digests(format_conversations(turns)).first().loss_chars == 2_000_000
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert classify(rows, labels).count() == 3 and mix(rows).where("doc_id = 0").first()["__tokens"] == 200_001


def test_near_duplicates_of_null_ids_and_no_rows(spark):
    rows = docs(spark, prose(1, 50), prose(1, 50)).withColumn("doc_id", F.when(F.col("doc_id") == 0, F.col("doc_id")))
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in near_duplicates(rows).collect()) == [(False, 0, True), (True, None, True)]
    assert near_duplicates(rows.limit(0)).count() == 0


def test_blocks_link_what_is_apart():
    sets = [np.arange(k % 4, 40 + k % 4).astype(np.int64) + 1000 * (k // 4) for k in range(12)]
    links = block_links(sets, np.arange(12), np.ones(12, bool), 80)
    assert len(links) == 9 and all(a // 4 == b // 4 for a, b in links)
    assert all(a >= 8 or b >= 8 for a, b in block_links(sets, np.arange(12), np.arange(12) >= 8, 80))


# chat


def test_escapes_are_reversible_and_hide_control_strings():
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "a", "\n"]) for _ in range(draw.randrange(9)))
        assert unescape(escape(text)) == text and not re.search(r"</?s>|\[/?INST\]", escape(text))
        assert parse_instruct("".join(f"<s>[INST]{escape(x)}[/INST]{escape(text)}</s>" for x in (text, "u"))) == [(text, text), ("u", text)]


def test_rewriting_templates_are_told(spark):
    last_only = lambda turns: "".join(f"{r}:" + (t if k == len(turns) - 1 else "...") + ";" for k, (r, t) in enumerate(turns))
    assert locate([("u", "aaaa"), ("a", "bb")], last_only)[1]
    plain = lambda turns: "".join(f"{r}: {t}\n" for r, t in turns)
    out, rewrites, spans = locate([("u", "\n x"), ("a", "")], plain)
    assert not rewrites and [out[a:b] for _, _, a, b in spans] == ["\n x", ""]


def test_masks_are_of_the_last_output():
    """A template that shortens earlier turns: no text of another turn gets under the loss mask."""
    def shortens(turns):
        return "".join(f"[{r}]{t if k == len(turns) - 1 else t[:3]};" for k, (r, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "one two three"), ("user", "more"), ("assistant", "last")]
    out, rewrites, spans = locate(turns, shortens)
    assert rewrites and out == "[user]hi;[assistant]one;[user]mor;[assistant]last;"
    assert [out[x:y] for _, _, x, y in spans] == ["hi", "", "", ""] and all(0 <= a <= b <= len(out) and 0 <= x <= y <= len(out) for a, b, x, y in spans)
    first_only = lambda turns: f"{len(turns)}|" + "".join(f"{r}:{t};" for r, t in turns)
    out, rewrites, spans = locate(turns, first_only)
    assert rewrites and [x == y for _, _, x, y in spans] == [True] * 4


def test_conversations_round_trip(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "</s>é"), (1, 0, "user", None), (1, 1, "assistant", "</s>é"), (None, 0, None, "x"), (2, None, "assistant", "late")], "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = {r.conv_id: r for r in digests(format_conversations(rows)).collect()}
    whole = "user\n\nassistant\n</s>é\nassistant\n</s>é\n"
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars) == (3, hashlib.sha256(whole.encode()).hexdigest(), 10)
    assert got[1].loss_sha256 == hashlib.sha256("</s>é</s>é".encode()).hexdigest() and got[None].n_turns == 1 and got[2].loss_chars == 4
    assert digests(format_conversations(rows.limit(0))).count() == 0


# classifier


def test_classifier_on_held_out_rows(spark):
    all_, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    test = labels.where("doc_id % 4 = 0").select("doc_id", F.col("quality").alias("y"), F.col("toxic").alias("t"))
    got = classify(all_, labels.where("doc_id % 4 <> 0")).join(test, "doc_id").collect()
    assert sum((r.quality >= 0.5) == (r.y == 1) for r in got) >= 0.93 * len(got)
    clean = [r for r in got if r.y == 1 and r.t == 0]
    assert sum(r.kept for r in clean) >= 0.95 * len(clean)


def test_sites_decide_on_doubtful_documents(spark):
    """The same doubtful text is kept on a site of good documents and not on one of bad ones; a site of one document hardly counts."""
    good, bad = (lambda k: prose(k, 60, 300)), (lambda k: " ".join(f"junk{random.Random(k * 99 + j).randrange(300)}" for j in range(60)))
    doubtful = " ".join(f"{a} {b}" for a, b in zip(good(9001).split()[:30], bad(9001).split()[:30], strict=True))
    rows = [(k, good(k) if k % 2 else bad(k), "en", "good.example" if k % 2 else "bad.example", 0) for k in range(600)]
    rows += [(1000, doubtful, "en", "good.example", 0), (1001, doubtful, "en", "bad.example", 0), (1002, doubtful, "en", "alone.example", 0)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classify(spark.createDataFrame(rows, DOCS), labels).collect()}
    assert got[1000].doc_odds == got[1001].doc_odds == got[1002].doc_odds
    assert got[1000].kept and not got[1001].kept and got[1001].site < got[1002].site < got[1000].site
    assert all(got[k].kept == bool(k % 2) for k in range(600))


def test_posteriors_equal_brute_force(spark):
    """Shares and prior strengths by the method of moments, host by host and path by path."""
    draw = random.Random(8)
    rows = [(h, p, draw.gauss(bias + q, 1)) for h, bias in (("a", 2.0), ("b", -2.0), ("c", 0.0), ("", 1.0)) for p, q, n in (("x", 0.5, 60), ("y", -0.5, 7), ("z", 0.0, 1)) for _ in range(n)]
    got = {(r.host, r.path): (r.site, r.mean) for r in site_posteriors(spark.createDataFrame(rows, "host string, path string, odds double"), "odds").collect()}
    share = [(h, p, 1 / (1 + np.exp(-x))) for h, p, x in rows]
    mean, total = np.mean([x for *_, x in share]), len(share)

    def strength(groups):
        sizes, sums = np.array([len(g) for g in groups]), np.array([sum(g) for g in groups])
        between = (sum(n * (s / n - mean) ** 2 for n, s in zip(sizes, sums, strict=True)) - (len(groups) - 1) * mean * (1 - mean)) / (total - sum(sizes**2) / total)
        return min(max(mean * (1 - mean) / between - 1, 1), 1e4) if between > 0 else 1e4

    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, x in share:
        hosts[h].append(x)
        paths[h, p].append(x)
    upper, lower = strength(list(hosts.values())), strength(list(paths.values()))
    assert 1 < upper < 1e4 and set(got) == set(paths)
    for (h, p), xs in paths.items():
        above = (sum(hosts[h]) + upper * mean) / (len(hosts[h]) + upper)
        assert got[h, p] == pytest.approx(((sum(xs) + lower * above) / (len(xs) + lower), mean))


def test_classifier_of_odd_rows(spark):
    rows = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], DOCS)
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert classify(rows, labels).count() == 3 and classify(rows.limit(0), labels.limit(0)).count() == 0


# archives


def test_archives_and_their_index(spark, tmp_path):
    big, odd = "<p>" + "ä" * 100, "a\r\n\r\nWARC/1.1\r\n\r\n" * 20
    pages = spark.createDataFrame([(3, "http://b.org/x", big), (1, "https://www.a.org:80/y?q=1", big), (2, None, None), (4, "http://a.org/\r\nz", "small"), (5, "http://a.org/z", "small"), (None, "http://c.org", big), (6, "http://a.org/y?q=1", odd), (6, "http://a.org/y?q=1", odd)], "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in archive_round_trip(pages).collect()}
    size = len(big.encode())
    assert got == {(3, size): ("revisit", 1), (1, size): ("response", None), (2, 0): ("response", None), (4, 5): ("response", None), (5, 5): ("response", None), (None, size): ("revisit", 1), (6, len(odd)): ("response", None)}
    write_archives(pages, str(tmp_path / "w"))
    write_index(read_archives(spark, str(tmp_path / "w")), str(tmp_path / "i"), block_rows=2)
    for rows in (0, 100):
        index = CaptureIndex(spark, str(tmp_path / "i"), directory_rows=rows)
        found = index.captures("http://a.org/y?q=1")
        assert sorted(c["page_id"] for c in found) == [1, 6, 6] and {index.payload(c) for c in found} == {big.encode(), odd.encode()}
        assert index.captures("http://nowhere.org/") == [] and [c["page_id"] for c in index.captures("http://c.org")] == [None]
        asked = spark.createDataFrame([("http://www.a.org/y?q=1",), ("http://a.org/y?q=1",), ("http://zzz.org",), (None,)], "url string")
        assert sorted(r.page_id for r in lookup(spark, str(tmp_path / "i"), asked, directory_rows=rows).collect()) == [1, 2, 6, 6]
    assert surt("https://www.a.b.org/x") == "org,b,a)/x"
    empty = pages.limit(0)
    assert archive_round_trip(empty).count() == 0
    write_archives(empty, str(tmp_path / "e"))
    write_index(read_archives(spark, str(tmp_path / "e")), str(tmp_path / "ei"))
    assert CaptureIndex(spark, str(tmp_path / "ei")).captures("http://a.org/") == [] and lookup(spark, str(tmp_path / "ei"), asked).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    """Large records apart from small ones, so many to a file that it can't pass its bound but by a single record; long URLs of one key."""
    sizes = [*[50] * 40, *[70_000] * 6, 3_000_000]
    pages = spark.createDataFrame([(k, "http://a.org/" + "p" * (3000 if k % 2 else 5), f"{k}" + "y" * n) for k, n in enumerate(sizes)], "page_id long, url string, html string").repartition(1)
    write_archives(pages, str(tmp_path / "w"), file_bytes=2 << 20)
    files = sorted(f.stat().st_size for f in (tmp_path / "w").glob("part-*"))
    assert len(files) == 6 and files[-1] > 3_000_000 > 2 << 20 > files[-2] > 70_000
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in archive_round_trip(pages, file_bytes=2 << 20).collect()}
    assert got == {r.page_id: (len(r.html), hashlib.sha256(r.html.encode()).hexdigest()) for r in pages.collect()}


def test_lookups_read_the_files_they_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerforge.llm.warc.FILE_BLOCKS", 1)
    pages = spark.createDataFrame([(k, f"http://h{k % 50:02}.org/{k}", f"page {k}") for k in range(400)], "page_id long, url string, html string")
    write_archives(pages, str(tmp_path / "w"))
    write_index(read_archives(spark, str(tmp_path / "w")), str(tmp_path / "i"), block_rows=10)
    few = lookup(spark, str(tmp_path / "i"), pages.where("page_id IN (3, 203)").select("url"))
    assert sorted(r.page_id for r in few.collect()) == [3, 203]
    assert len(few.inputFiles()) < 10 < len(list((tmp_path / "i" / "blocks").glob("part-*")))
    assert lookup(spark, str(tmp_path / "i"), pages.limit(0).select("url")).count() == 0


# mixing


def test_exponents_reach_their_targets(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens long")
    a, _ = exponent(totals, target_entropy=0.8, max_epochs=1e9, budget=1000.0)
    p = np.array([1000, 100, 10.0]) ** a
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() / np.log(3) - 0.8) < 1e-3
    a, budget = exponent(totals, target_entropy=1.0, max_epochs=2.0, budget=None)
    assert (1000 / 10) ** (1 - a) <= 2.0 + 1e-6 and budget >= 1110
    assert exponent(totals.limit(0), target_entropy=0.8, max_epochs=2.0, budget=None) == (1.0, 0.0)


def test_mixing_keeps_all_and_meets_its_budget(spark):
    texts = [prose(k, 5 + k % 9) for k in range(400)]
    rows = docs(spark, *texts, source=lambda k: None if k % 20 == 1 else ("big" if k % 20 else "tiny")).withColumn("__key", F.lit(1))
    got = mix(rows, target_entropy=0.95).collect()
    assert {r.doc_id for r in got} == set(range(400))
    per = defaultdict(Counter)
    for r in got:
        per[r.source][r.doc_id] += 1
    assert max(per["big"].values()) == 1 and all(max(c.values()) - min(c.values()) <= 1 for c in per.values()) and min(per["tiny"].values()) >= 2
    total = sum(len(t.split()) + 1 for t in texts)
    small = mix(rows, target_entropy=0.0, budget=total / 2).collect()
    assert 0 <= total / 2 - sum(r["__tokens"] for r in small) <= 3 * 15
    assert mix(rows.limit(0)).count() == 0


def spark_hash(*values):
    """xxhash64 as the engine has it: each value's bytes seeded by the hash so far, nulls left out."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q" if v.bit_length() > 31 or isinstance(v, Long) else "<i", v), h)
    return h - (h >> 63 << 64)


class Long(int):
    pass


def mixed_by_brute_force(rows, target, most):
    """(doc_id, source, text) rows without a budget: how often each row is there."""
    key = lambda s: "" if s is None else f"={s}"
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
    totals = Counter()
    for _, s, t in rows:
        totals[key(s)] += size(t)
    high, low = max(totals.values()), min(totals.values())

    def entropy(a):
        p = np.array(list(totals.values()), float) ** a
        p /= p.sum()
        return -(p * np.log(p)).sum()

    a, b = 0.0, 1.0
    if entropy(1.0) >= target * np.log(len(totals)) - 1e-12:
        a = 1.0
    else:
        for _ in range(60):
            a, b = ((a + b) / 2, b) if entropy((a + b) / 2) >= target * np.log(len(totals)) else (a, (a + b) / 2)
    if (high / low) ** (1 - a) > most:
        a = 1 - np.log(most) / np.log(high / low) + 16.0**-6 / 2  # the exponent is told to 16^-6, and from above here
    copies = Counter()
    for s, total in totals.items():
        passes = (high / total) ** (1 - a)
        full = int(passes + 1e-9)
        rest = max(0, int((passes - full) * total + 1e-6))
        order = []
        for n, (i, source, t) in enumerate(rows):
            if key(source) == s:
                copies[n] += full
                place = spark_hash(11, None if i is None else Long(i), t)
                block = (place >> 20) % 4096
                order.append((spark_hash(11, s, block, full), block, place, size(t), n))
        order.sort()
        used = 0
        for at, (k, block, place, n_tokens, n) in enumerate(order):
            peers = [o for o in order if o[:3] == (k, block, place)]
            if at == order.index(peers[0]):
                used += sum(p[3] for p in peers)
                if used > rest:
                    break
                for p in peers:
                    copies[p[4]] += 1
    return copies


@pytest.mark.parametrize(("target", "most"), [(0.87, 4.0), (0.99, 2.5), (0.5, 4.0)])
def test_mixing_equals_brute_force(spark, target, most):
    rows = [(k if k % 50 else None, None if k % 97 == 1 else ("big" if k % 20 else ("mid" if k % 3 else "tiny")), None if k % 60 == 7 else prose(k, 5 + k % 30)) for k in range(700)]
    rows += rows[:5]
    got = Counter((r.doc_id, r.source, r.text) for r in mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), target_entropy=target, max_epochs=most).collect())
    want = Counter()
    for n, k in mixed_by_brute_force(rows, target, most).items():
        want[rows[n]] += k
    assert got == want


def test_columns_of_any_name_stay(spark):
    """Every name that the code uses for itself, dotted names and maps among the columns of docs."""
    names = ["__epoch", "__place", "__tokens", "__of", "__hash", "__block", "__source", "__full", "__last", "__cut", "__least", "__id", "__spans", "__group", "a.b", "Set", "row", "hash", "`q"]
    rows = docs(spark, prose(1, 30) + " token=Abc123Xyz", prose(2, 30), None).withColumns({n: F.lit(f"kept {n}") for n in names if "." not in n and "`" not in n})
    rows = rows.select("*", F.lit("kept a.b").alias("a.b"), F.lit("kept `q").alias("`q"), F.create_map(F.lit("k"), F.lit("v")).alias("m"))
    for out in (mix(rows), redact(rows), pipeline.near_dups(spark, rows.unionByName(rows), ""), pipeline.mixing(spark, rows, "")):
        got = out.collect()
        assert {r.doc_id for r in got} == {0, 1, 2} and all(r[n] == f"kept {n}" for r in got for n in names) and all(r["m"] == {"k": "v"} for r in got)
    pieces = spark.createDataFrame([(5, 1, "x", 9, "g"), (7, 2, "y", 9, "g")], "length long, deal long, doc string, offset long, __group string")
    assert sorted((r.length, r.doc, r["__group"], r.offset) for r in pack_pieces(pieces, capacity=20).collect()) == [(5, "x", "g", 7), (7, "y", "g", 0)]


# secrets


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def spans_of(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets_equal_brute_force(spark):
    draw = random.Random(8)
    parts = ["password:token", " = abcdefgh", "SECRET='x1y2z3w4'", "AKIA" + "B" * 16, "AKIAshort", "0123456789abcdef" * 2, "é😀 ", "\n", "api_key: ", "xyz123456", "token", "=", "plain words "]
    texts = [None, "", *("".join(draw.choices(parts, k=draw.randrange(1, 14))) for _ in range(150)), "token=abcdef " * 300]
    got = {r.doc_id: r for r in secret_report(docs(spark, *texts).withColumn("hash", F.lit(1)).withColumn("row", F.lit(1))).collect()}
    for k, t in enumerate(texts):
        want = spans_of(t or "")
        assert got[k].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (got[k].n_assign, got[k].n_access, got[k].n_hex) == tuple(want.count(f"{kind}:") for kind in ("assign", "access", "hex"))
    assert secret_report(docs(spark, *texts).limit(0)).count() == 0


def test_owners_part_examples_from_secrets(spark):
    own, example, key = "token=" + "a1" * 12 + "Q", "token=EXAMPLE9", "ghp_" + "Z9" * 12
    rows = docs(spark, f"é {own} {example} {key}", example, f"x {example}", None)
    assert {x["kind"] for r in find_secrets(rows).collect() for x in r.spans} == {"assign", "key", "hex"}
    texts = [r.text for r in redact(rows).orderBy("doc_id").collect()]
    assert texts == [f"é <secret> {example} <secret>", example, f"x {example}", None]
    assert redact(rows).columns == rows.columns


def test_owners_and_repositories_are_counted_apart(spark):
    """Planted copies: the verdict follows the number of owners and, from two owners on, of repositories; hot strings go the same way."""
    secret = {n: f"token={n}Secret99" for n in ("one", "few", "many", "wide")}
    rows = [("one", f"o{k % 1}", f"r{k}") for k in range(40)] + [("few", f"o{k % 2}", f"r{k % 2}") for k in range(4)] + [("many", f"o{k}", "r") for k in range(3)] + [("wide", f"o{k % 2}", f"r{k}") for k in range(6)]
    rows = spark.createDataFrame([(k, f"{secret[n]} ghp_{n}{'Z9' * 12}", repo, owner, 0) for k, (n, owner, repo) in enumerate(rows)], DOCS)
    for hot in (10_000, 5, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr("ledgerforge.llm.secrets.HOT_SPANS", hot)
            found = {r.spans[0].owners * 100 + r.spans[0].repositories: (r.spans[0].live, len(r.spans)) for r in find_secrets(rows).collect()}
        assert found == {140: (True, 2), 202: (True, 2), 303: (False, 1), 206: (False, 1)}
    assert sum(r.text.startswith("<secret> <secret>") for r in redact(rows).collect()) == 44


def test_private_keys_are_known_by_their_bodies(spark):
    pem = lambda body, end="\n": f"-----BEGIN RSA PRIVATE KEY-----{end}{body}{end}-----END RSA PRIVATE KEY-----"
    own = [f"{k}a+/B" * 12 + f"\n{k}Qx-y==" for k in range(4)]
    cut = "-----BEGIN PRIVATE KEY-----\n" + "C3dE" * 16 + "\nshort1=="
    copied = "Z9yX" * 16
    texts = [*(f"é {pem(b)} tail-{k}" for k, b in enumerate(own)), f"x {cut}\nThe prose that follows stays", f"y {pem(copied)}", f"{pem(copied, chr(13) + chr(10))} z", f"{pem(copied)} w", f"{cut}{pem('Q' * 32)}"]
    rows = docs(spark, *texts).withColumn("source", F.concat(F.lit("s"), F.col("doc_id").cast("string")))
    got = [r.text for r in redact(rows).orderBy("doc_id").collect()]
    assert got == [*(f"é <secret> tail-{k}" for k in range(4)), "x <secret>\nThe prose that follows stays", *texts[5:8], "<secret><secret>"]
    found = {r.doc_id: r.spans for r in find_secrets(rows).collect()}
    of = [[(x["start"], x["end"]) for x in found[k] if x["kind"] == "key"] for k in sorted(found)]
    assert of[0] == [(2, 2 + len(pem(own[0])))] and of[5:8] == [[], [], []]


# top k


@pytest.mark.parametrize("low", [-40, 0, 5])
def test_blocks_find_the_best(low):
    draw = np.random.default_rng(low + 50)
    values, ids = draw.integers(low, low + 60, (200, 9)), draw.permutation(1000)[:200].astype(np.int64)
    values[:20] = values[0]
    block = Block(ids, values)
    asked = values[:70]
    for (_, rows, scores), q, own in zip(block.best(asked, ids[:70], 7), asked, ids[:70], strict=True):
        want = sorted((-int(v @ q), int(i)) for v, i in zip(values, ids, strict=True) if i != own)[:7]
        assert sorted(zip((-scores).tolist(), rows.tolist(), strict=True)) == want


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [0.5, 1.0]), (20, [0.5, 1.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [-1.0]), (None, [1.0, 1.0]), (5, [0.26, -0.26]), (40, [])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)), k=2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 20, 5120), (0, 2, 40, 0), (20, 1, 0, 5120), (20, 2, 40, 0), (40, 1, 0, 0), (40, 2, 4, 0)]
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    twice = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.5]), (2, [0.25, 1.0])]
    got = top_k(spark.createDataFrame(twice, "vec_id long, embedding array<float>"), k=1).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 1, 4096), (0, 1, 2, 4096)]  # each row by itself
    with pytest.raises(Exception, match="no long can hold"):
        top_k(spark.createDataFrame([(0, [1e9, 1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()


# quality rules


def test_quality_measures_equal_brute_force(spark):
    draw = random.Random(4)
    texts = [None, "", "a b c d e\na b c d e\n \n \n", "é! #x " * 12, *("".join(draw.choice(["a ", "b ", "c\n", "d\t", "#$ ", "é "]) for _ in range(draw.randrange(60))) for _ in range(60)), prose(1, 300)]
    got = {r.doc_id: r for r in quality_rules(docs(spark, *texts).withColumn("kept", F.lit(1))).collect()}
    for k, t in enumerate(t or "" for t in texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        count, seen, again = Counter(grams), set(), 0
        inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), again, len(inside))
        assert r.base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words)) and not (r.kept and r.base_failed)
    assert got[len(texts) - 1].kept and measure("x " * 5)[-1] is False and quality_rules(docs(spark, "a").limit(0)).count() == 0


def test_repetition_decides_where_the_base_rule_keeps(spark):
    """Characters in repeated n-grams and lines by brute force, and texts that only these reject."""
    draw = random.Random(6)
    phrase = " ".join(f"the same four {'words' * 3} u{k}" for k in range(30))  # a phrase of four with another word each time
    stutter = " ".join(f"w{k} " * 5 for k in range(12))
    lines = "\n".join([prose(k, 12, 4000) for k in range(8)] + [f"{'x' * 80} y"] * 8)
    clean = prose(2, 400, 4000)
    texts = [phrase, stutter, lines, clean, *(" ".join(draw.choice(["aa", "b", "cé"]) + draw.choice([" ", "\n", "  "]) for _ in range(draw.randrange(40))) for _ in range(80))]
    got = {r.doc_id: r for r in quality_rules(docs(spark, *texts)).collect()}
    for k, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        want = []
        for n in NGRAM_LIMITS:
            count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
            inside = {j for i in range(len(words) - n + 1) if count[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
            want.append(sum(len(words[j]) for j in inside))
        seen, again = set(), 0
        for line in t.split("\n"):
            again += len(line) if line in seen else 0
            if line.strip(" \t\n\r\x0b\x0c"):
                seen.add(line)
        assert (list(got[k].dup_ngram_chars), got[k].dup_line_chars) == (want, again)
        beyond = any(d > share * got[k].word_chars for d, share in zip(want, NGRAM_LIMITS.values(), strict=True)) or again > LINE_LIMIT * len(t)
        assert got[k].kept == (not got[k].base_failed and not beyond)
    assert [(got[k].base_failed, got[k].kept) for k in range(4)] == [(False, False)] * 3 + [(False, True)]
    assert quality_rules(docs(spark, "word " * 300_000)).first().n_words == 300_000


# web pages


PAGE = '<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar"><nav><a>Menu</a></nav><div class="cookie-notice">Accept</div><article><h1>Head &amp; {k}</h1><p>One<b> two</b>\n three<br>four<p>Five &lt;six&gt;<div class="share-buttons">Share</div><form>Name</form><p>Same line everywhere</p><ul><li>a<li>b</ul><section id="comments"><p>Nice!</p></section></article><aside>Ads</aside><footer>&copy; Foot</footer></body></html>'


def test_articles_without_the_rest():
    assert Page(PAGE.format(k=1)).text().split("\n") == ["Head & 1", "One two three four", "Five <six>", "Same line everywhere", "a", "b"]
    assert Page("just &am text").text() == "just &am text" and Page("").text() == "" and Page("<p>cut <foo").text() == "cut"
    assert Page("<div><nav>x</nav><p>body</div>").text() == "body"


@pytest.mark.parametrize("size", [1, 9, 10, 24])
def test_articles_are_whole_on_hosts_of_any_size(spark, size):
    """Reference lists, abstracts with few texts and a sentence on all pages stay; what is named otherwise goes."""
    links = lambda k, what: "".join(f'<li><a href="/{what}{k}/{j}">{what} {k} {j}</a></li>' for j in range(4))
    body = lambda k: f'<h1>Title {k}</h1><div class="abstract">{"In brief: one." if k % 2 else "In brief: two."}</div><p>{prose(k, 60, 60)}</p><p>This sentence is on all pages.</p><p>{prose(900 + k, 30, 60)}</p><ul class="references">{links(k, "source")}</ul>'
    other = '<div class="share-buttons">Share this</div><nav class="toc"><a href="#a">On this page</a></nav>'
    page = lambda k: f'<html><head><title>t</title></head><body><nav><a href="/">Home</a><a href="/b">About</a></nav><article>{body(k)}{other}<ul class="related-posts">{links(k, "more")}</ul></article><footer><p>Imprint</p><p>Terms</p></footer></body></html>'
    rows = [(k, f"http://h{size}.org/{k}", page(k)) for k in range(size)] + [(100, "http://common.org/", PAGE.format(k=1)), (101, None, None), (102, "::", "")]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    for k in range(size):
        want = [f"Title {k}", "In brief: one." if k % 2 else "In brief: two.", prose(k, 60, 60), "This sentence is on all pages.", prose(900 + k, 30, 60), *(f"source {k} {j}" for j in range(4))]
        assert got[k].text.split("\n") == want and got[k].n_chars == len(got[k].text)
    assert got[100].text == Page(PAGE.format(k=1)).text() and got[101].text == "" and got[102].n_chars == 0


def test_boxes_and_frames_of_a_template_go(spark):
    """Without names: a notice's box within the article, and lines before and after its text, are the site's; one line on all pages isn't."""
    box = '<div class="k9"><p>We use things</p><p>Read more about them</p></div>'
    page = lambda k: f"<html><body><article><p>Line one</p><p>Line two</p><p>{prose(k, 40)}</p>{box}<p>The same here</p><p>{prose(700 + k, 40)}</p><p>Line three</p><p>Line four</p></article></body></html>"
    plain = lambda k: f"<html><body><article><h1>All pages say so</h1><p>{prose(k, 40)}</p><p>One</p><p>Two</p><p>Three</p><p>Four</p></article></body></html>"
    rows = [(k, "http://one.org/", page(k)) for k in range(15)] + [(100 + k, "http://two.org/", plain(k).replace("<h1>All pages say so</h1>", "")) for k in range(15)]
    got = {r.page_id: r.text.split("\n") for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == [prose(k, 40), "The same here", prose(700 + k, 40)] for k in range(15))
    assert all(got[100 + k] == [prose(k, 40), "One", "Two", "Three", "Four"] for k in range(15))


def test_layouts_have_templates_of_their_own(spark):
    page = lambda before, own, after: "<html><body><article>" + "".join(f"<p>{x}</p>" for x in (*before, *own, *after)) + "</article></body></html>"
    own = lambda k: [f"story {k} part {j} " + prose(100 * k + j, 20, 20) for j in range(3)]
    notice = {name: [f"{name} line {j}" for j in range(5)] for name in "abcd"}
    rows = [(k, "http://one.org/x", page(notice["a"][:2], own(k), notice["a"][2:]) if k % 5 < 3 else page(notice["b"][:1], own(k), notice["b"][1:])) for k in range(30)]
    rows += [(100 + k, "http://copies.org", page([], notice["c"], [f"last {k}"]) if k < 12 else page([], own(k), [])) for k in range(30)]  # an article copied
    rows += [(200 + k, "http://mixed.org", page([], own(k), notice["d"][k % 5 :] + notice["d"][: k % 5]) if k < 20 else page([], own(k), [])) for k in range(30)]  # in no order
    got = {r.page_id: r.text.split("\n") for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == own(k) for k in range(30))
    assert all(got[100 + k] == (notice["c"] + [f"last {k}"] if k < 12 else own(k)) for k in range(30))
    assert all(set(got[200 + k]) == {*own(k), *notice["d"]} for k in range(20))


def test_names_of_articles_are_no_names_of_sites():
    kept = "ad-hoc share-price notice-period related-work has-sidebar menu-card comment_on banner-image pre-footer-notes".split()
    assert not any(map(named, kept)) and all(map(named, "ad ad-300x250 adBanner cookie-notice site-footer share-buttons post-comments related-posts nav-primary sidebar".split()))
    body = '<p class="ad-hoc">one</p><p class="share-price">two</p><h2 id="notice-period">three</h2><div id="related-work">four</div><p>x <math><mi>y</mi></math> <object>z</object></p><h2 id="comments">five</h2>'
    assert Page(f"<article>{body}</article>").text().split("\n") == ["one", "two", "three", "four", "x y z", "five"]
    assert Page("<main><header>Site <a>x</a></header><p>body</p></main>").text() == "body"
    assert Page("<main><header><h1>Head</h1>by me</header><p>body</p></main>").text() == "Head\nby me\nbody"


def unnamed(source):
    """A page without any name that tells what its parts are."""
    for tag, name in (("nav", "k1"), ("article", "k2"), ("footer", "k3")):
        source = source.replace(f"<{tag}>", f'<div class="{name}">').replace(f"</{tag}>", "</div>")
    return source.replace('class="ad"', 'class="k4"')


def test_templates_tell_the_article_without_names(spark):
    """The slots alone part articles from menus, adverts and footers: no name and no tag of the page says which is which."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    host = lambda r: re.match("https?://([^/]*)", r.url)[1]
    size = Counter(map(host, pages))
    some = [r for r in pages if size[host(r)] >= LEAST_PAGES and sum(map(ord, host(r))) % 3 == 0]
    assert len(some) > 300
    rows = spark.createDataFrame([(r.page_id, r.url, unnamed(r.html)) for r in some], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(rows).collect()}
    assert all(got[r.page_id] == Page(r.html).text() != Page(unnamed(r.html)).text() for r in some)


def test_classes_equal_brute_force(spark):
    pages = [r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    host = lambda r: re.match("https?://([^/]*)", r.url)[1]
    largest = [h for h, _ in Counter(map(host, pages)).most_common(3)]
    some = [r for r in pages if host(r) in largest]
    rows = spark.createDataFrame([(r.page_id, r.url, r.html) for r in some], "page_id long, url string, html string")
    got = {(r.host, frozenset(x & (2**64 - 1) for x in r.tokens), r.shared) for r in classes(rows).collect()}
    want = set()
    for h in largest:
        own = [r for r in some if host(r) == h]
        vectors = defaultdict(dict)
        for r in own:
            for token, n in Counter(Page(r.html).tokens()).items():
                vectors[token][r.page_id] = n
        by = defaultdict(set)
        for token, v in vectors.items():
            by[tuple(sorted(v.items()))].add(token)
        want |= {(h, frozenset(ts), len(v) >= LEAST_SHARE * len(own)) for v, ts in by.items() if len(v) >= max(LEAST_PAGES, LAYOUT_SHARE * len(own)) and len(ts) >= LEAST_TOKENS}
    assert got == want and got and templates(rows.limit(0)).count() == extract(rows.limit(0)).count() == 0


def test_slots_of_odd_sites(spark):
    """Layouts of their own containers, parts beside each other, site slots within the article, and a heading outside it."""
    menu = '<div class="q1"><a href="/">Home</a> <a href="/b">About us</a></div>'
    own = lambda k, j: f"<p>story {k} part {j} {prose(100 * k + j, 30, 30)}</p>"
    one = lambda k: f'<div class="a1">{menu}<h1>Title {k}</h1><div class="q2"><i>by author {k}</i></div><div class="q3">{own(k, 0)}<div class="q4">Follow us today</div>{own(k, 1)}</div><div class="q5">Terms apply</div></div>'
    two = lambda k: f'<div class="a2">{menu}<div class="r3">{own(k, 0)}</div><div class="q6"><a href="x{k}">more {k}</a></div><div class="r4">{own(k, 1)}</div><div class="q7">tail</div></div>'
    html = lambda k, f: f"<html><head><title>t</title></head><body>{f(k)}</body></html>"
    rows = [(k, "http://s.org/", html(k, one if k % 3 else two)) for k in range(60)] + [(99, None, html(99, one)), (98, "http://s.org/", None), (97, "http://s.org/", "<p>bare " + "x" * 50_000)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("template", F.lit(1))).collect()}
    text = lambda k, j: re.sub("<[^>]+>", "", own(k, j))
    assert all(got[k] == "\n".join([f"Title {k}", f"by author {k}", text(k, 0), text(k, 1)] if k % 3 else [text(k, 0), text(k, 1)]) for k in range(60))
    assert got[98] == "" and got[97] == "bare " + "x" * 50_000 and "Home" in got[99]
