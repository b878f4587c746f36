import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import mixed_by_brute_force

import corpus_pipeline as pipeline
from ledgerforge.llm.packing import WordEncoder
from ledgerforge.llm.quality_rules import measure
from ledgerforge.llm.queries import TOKENIZER
from ledgerforge.llm.secrets import KINDS


def test_stages_on_planted_rows(spark):
    good = " ".join(f"word{k}" for k in range(80))
    near = good.replace("word79", "other")
    rows = [(1, good, "en", "a", 1), (2, near, "en", "a", 2), (3, "bad " * 40, "en", "a", 3), (4, None, None, None, None), (5, f"{' '.join(f'x{k}' for k in range(60))} token=Abc123Xyz", "en", "b", 5), (1, good, "en", "a", 1), (None, " ".join(f"z{k}" for k in range(40)), "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("id", F.lit(1))
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == columns
        seen[name] = Counter(r.doc_id for r in docs.collect())
    assert seen["quality"] == {1: 2, 2: 1, 5: 1, None: 1} and seen["near_dups"] == seen["secrets"] == {1: 1, 5: 1, None: 1}
    assert set(seen["mixing"]) == {1, 5, None} and "token=Abc123Xyz" not in docs.where("doc_id = 5").first().text


def components(texts, size):
    """The smallest id that each text reaches, by comparing all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for k, x in texts.items():
        w = x.encode().lower().split()
        sets[k] = {b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} or ({b" ".join(w)} if w else set())
        for s in sets[k]:
            holders[s].append(k)
    shared = Counter((a, b) for ks in holders.values() for i, a in enumerate(ks) for b in ks[i + 1 :])
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    root, before = {k: k for k in texts}, None
    while root != before:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def spans(text):
    """(start, rank, end, secret) of all candidates of a text."""
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        for m in re.finditer(pattern.replace(r"\z", r"\Z"), text, re.ASCII):
            held = re.sub(r"-----(?:BEGIN|END) [A-Z ]*-----|\s+|\\[nr]", "", m[group]) if kind == "key" and m[group].startswith("-----BEGIN ") else m[group]
            if len(m[group]) >= least:
                yield m.start(), rank, m.end(), held


def redacted(rows):
    """(doc_id, source, lang, text) rows with what few owners hold replaced."""
    owners, repositories = defaultdict(set), defaultdict(set)
    for _, source, lang, text in rows:
        for *_, held in spans(text or ""):
            owners[held].add(source)
            repositories[held].add((source, lang))
    out = []
    for k, source, lang, text in rows:
        new, at = [], 0
        for start, _, end, held in sorted(spans(text or "")):
            copied = len(owners[held]) >= 3 or (len(owners[held]) > 1 and len(repositories[held]) >= 6)
            if not copied and end > at:
                new.append((text[at : max(start, at)] + "<secret>"))
                at = end
        out.append((k, source, None if text is None else "".join(new) + text[at:]))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_run_equals_brute_force(spark, sf):
    """All rows of the run but for their places in sequences, and these places by themselves."""
    path = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.source, r.lang, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    docs = [d for d in docs if measure(d[3] or "")[-1]]
    root = components({d[0]: d[3] or "" for d in docs}, 5)
    docs = redacted([d for d in docs if root[d[0]] == d[0]])
    tokenizer, want = WordEncoder(TOKENIZER).tokenizer, Counter()
    for n, copies in mixed_by_brute_force(docs, 0.87, 4.0).items():
        ids = np.array([*tokenizer.encode(docs[n][2] or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 2048):
            want[docs[n][0], s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)] += copies
    rows = pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        ends = [0, *(a + n for a, n in sorted(pieces))]
        assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 2048
    assert sum(r.length for r in rows) > 0.9 * 2048 * len(places) or len(rows) < 400


def test_stages_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
