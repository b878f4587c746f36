"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.llm.chat import digests, format_conversations
from ledgerforge.llm.classifier import classify
from ledgerforge.llm.clustering import yinyang
from ledgerforge.llm.common import table
from ledgerforge.llm.hard_negatives import hard_negatives
from ledgerforge.llm.html_text import extract
from ledgerforge.llm.mixing import mix
from ledgerforge.llm.near_dups import near_duplicates
from ledgerforge.llm.packing import pack_documents
from ledgerforge.llm.quality_rules import LINE_LIMIT, NGRAM_LIMITS, quality_rules
from ledgerforge.llm.secrets import secret_report
from ledgerforge.llm.simhash import simhash_duplicates
from ledgerforge.llm.topk import top_k
from ledgerforge.llm.warc import archive_round_trip

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", ["doc_id", "text"]), TOKENIZER)


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]), shingle=2)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", body), (-1, 1, "assistant", body)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return digests(format_conversations(rows.unionByName(more)))


def op4_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"]), table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_round_trip(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))
    return mixed.select("doc_id", "source", F.col("__tokens").alias("tokens"), F.col("__epoch").alias("epoch"), F.col("__place").alias("place"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"]))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yinyang(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def _ngram_sql(n: int) -> str:
    """Sub-queries: of each document the words within n words found twice (`at<n>`), and how many they are with their characters (`cover<n>`)."""
    return f"""win{n} AS (SELECT row, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT row, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM d WHERE len(w) >= {n})),
twice{n} AS (SELECT row, g FROM win{n} GROUP BY ALL HAVING count(*) > 1),
at{n} AS (SELECT DISTINCT row, unnest(generate_series(i, i + {n - 1})) AS i FROM win{n} JOIN twice{n} USING (row, g)),
cover{n} AS (SELECT at{n}.row, count(*) AS words, sum(length(d.w[i])) AS chars FROM at{n} JOIN d USING (row) GROUP BY ALL)"""


QUERIES = {f.__name__: f for f in (op1_packing, op2_near_dups, op3_chat, op4_classifier, op5_warc, op6_mixing, op7_secrets, op8_topk, op9_quality_rules, op10_html, op11_hard_negatives, op12_clusters, op13_simhash)}
ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM q)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM r
"""
ORACLE_SQL["op8_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
ORACLE_SQL["op3_chat"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, len(replace(text, '\\', '\\\\')) + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]')) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + len(role) + 20) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
# Whole sets, compared wherever two documents share a shingle, and what each reaches.
ORACLE_SQL["op2_near_dups"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, a.n AS na, b.n AS nb FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)), y AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a), m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m.b, doc_id)) AS component_id, doc_id <= coalesce(m.b, doc_id) AS kept FROM s LEFT JOIN m ON m.a = doc_id
"""
ORACLE_SQL["op9_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
{", ".join(_ngram_sql(n) for n in NGRAM_LIMITS)},
lines AS (SELECT row, x, count(*) AS n FROM (SELECT row, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY ALL),
again AS (SELECT row, sum(n - 1) AS lines, sum((n - 1) * length(x)) AS chars FROM lines GROUP BY row),
m AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(again.lines, 0) AS n_dup_lines,
  coalesce(cover5.words, 0) AS n_repeat_words, coalesce(again.chars, 0) AS dup_line_chars, length(t) AS size, [{", ".join(f"coalesce(cover{n}.chars, 0)" for n in NGRAM_LIMITS)}] AS dup
  FROM d LEFT JOIN again USING (row) {" ".join(f"LEFT JOIN cover{n} USING (row)" for n in NGRAM_LIMITS)}),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  CAST(dup_line_chars AS BIGINT) AS dup_line_chars, list_transform(dup, lambda x: CAST(x AS BIGINT)) AS dup_ngram_chars,
  NOT base_failed AND {" AND ".join(f"dup[{k}] <= {share} * word_chars" for k, share in enumerate(NGRAM_LIMITS.values(), 1))} AND dup_line_chars <= {LINE_LIMIT} * size AS kept
FROM b
"""
ORACLE_SQL["op11_hard_negatives"] = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, coalesce(CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT), 0) AS score
  FROM v a, v c WHERE a.vec_id % 50 = 0 AND a.row <> c.row),
p AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place FROM s WHERE same AND vec_id <> anchor_id),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.row, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.row = p.row AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def _kmeans_sql(k: int, rounds: int, seed: int, scale: int, dims: int) -> str:
    """Full scans: a<r> has each vector's nearest centroid of c<r>, c<r + 1> the floored means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT v.row, c.no, CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance FROM v, c{r} c),
a{r} AS MATERIALIZED (SELECT row, min(distance) AS distance, arg_min(no, (distance, no)) AS no FROM d{r} GROUP BY row)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT a.no, u.i, sum(u.x) AS s, count(*) AS n FROM a{r} a JOIN u USING (row) GROUP BY ALL),
f{r} AS (SELECT no, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM m{r} GROUP BY no),
c{r + 1} AS MATERIALIZED (SELECT c.no, coalesce(f.e, c.e) AS e FROM c{r} c LEFT JOIN f{r} f USING (no))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS MATERIALIZED (SELECT row, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS INTEGER) AS no, e FROM (SELECT sha256('{seed}:' || vec_id) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k})),
{", ".join(steps)},
w AS (SELECT no, sum(distance) AS part FROM a{rounds} GROUP BY no)
SELECT v.vec_id, a.no AS cluster, a.distance, CAST(w.part AS BIGINT) AS cluster_inertia, CAST((SELECT sum(part) FROM w) AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (row) JOIN w USING (no) JOIN c{rounds} c USING (no)
"""


ORACLE_SQL["op12_clusters"] = _kmeans_sql(8, 10, 3, 1024, 64)
