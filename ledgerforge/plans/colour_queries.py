"""Queries on colours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.color import with_delta_e, with_lab
from ledgerforge.operators.equivalence import bidirectional, equivalents
from ledgerforge.plans.derive import PAINTS_SQL, paints
from ledgerforge.plans.registry import query


def _linear(c: str) -> str:
    return f"CASE WHEN {c} / 255.0 <= 0.04045 THEN {c} / 255.0 / 12.92 ELSE pow(({c} / 255.0 + 0.055) / 1.055, 2.4) END"


_F = "CASE WHEN {t} > 216.0/24389 THEN cbrt({t}) ELSE (24389.0/27 * {t} + 16) / 116 END"
LAB_SQL = f"""lin AS (SELECT *, {_linear("CAST(r AS DOUBLE)")} AS lr, {_linear("CAST(g AS DOUBLE)")} AS lg, {_linear("CAST(b AS DOUBLE)")} AS lb FROM paint),
xyz AS (SELECT *, (0.4124564 * lr + 0.3575761 * lg + 0.1804375 * lb) / 0.95047 AS tx, 0.2126729 * lr + 0.7151522 * lg + 0.0721750 * lb AS ty, (0.0193339 * lr + 0.1191920 * lg + 0.9503041 * lb) / 1.08883 AS tz FROM lin),
fff AS (SELECT *, {_F.format(t="tx")} AS fx, {_F.format(t="ty")} AS fy, {_F.format(t="tz")} AS fz FROM xyz),
lab AS (SELECT *, 116 * fy - 16 AS L, 500 * (fx - fy) AS A, 200 * (fy - fz) AS Bq FROM fff)"""


def delta_sql(pairs: str) -> str:
    """Chained sub-queries from `pairs` (l1, a1, b1, l2, a2, b2, ...) to `de` (..., delta_e)."""
    return f"""d1 AS (SELECT *, (sqrt(a1*a1+b1*b1) + sqrt(a2*a2+b2*b2)) / 2 AS cb FROM {pairs}),
d2 AS (SELECT *, 1 + 0.5 * (1 - sqrt(pow(cb, 7) / (pow(cb, 7) + pow(25.0, 7)))) AS gg FROM d1),
d3 AS (SELECT *, sqrt(a1*gg*a1*gg + b1*b1) AS c1, sqrt(a2*gg*a2*gg + b2*b2) AS c2,
  CASE WHEN a1*gg = 0 AND b1 = 0 THEN 0 WHEN atan2(b1, a1*gg) < 0 THEN degrees(atan2(b1, a1*gg)) + 360 ELSE degrees(atan2(b1, a1*gg)) END AS h1,
  CASE WHEN a2*gg = 0 AND b2 = 0 THEN 0 WHEN atan2(b2, a2*gg) < 0 THEN degrees(atan2(b2, a2*gg)) + 360 ELSE degrees(atan2(b2, a2*gg)) END AS h2 FROM d2),
d4 AS (SELECT *, CASE WHEN c1*c2 = 0 THEN 0 WHEN h2-h1 > 180 THEN h2-h1-360 WHEN h2-h1 < -180 THEN h2-h1+360 ELSE h2-h1 END AS dh,
  CASE WHEN c1*c2 = 0 THEN h1+h2 WHEN abs(h1-h2) <= 180 THEN (h1+h2)/2 WHEN h1+h2 < 360 THEN (h1+h2+360)/2 ELSE (h1+h2-360)/2 END AS hm, (c1+c2)/2 AS cm, (l1+l2)/2 AS lm FROM d3),
d5 AS (SELECT *, 1 - 0.17*cos(radians(hm-30)) + 0.24*cos(radians(2*hm)) + 0.32*cos(radians(3*hm+6)) - 0.20*cos(radians(4*hm-63)) AS tt,
  1 + 0.015*pow(lm-50, 2)/sqrt(20+pow(lm-50, 2)) AS sl, 1 + 0.045*cm AS sc, 2*sqrt(pow(cm, 7)/(pow(cm, 7)+pow(25.0, 7))) AS rc, 30*exp(-pow((hm-275)/25, 2)) AS th FROM d4),
de AS (SELECT *, sqrt(greatest(0, pow((l2-l1)/sl, 2) + pow((c2-c1)/sc, 2) + pow(2*sqrt(c1*c2)*sin(radians(dh/2))/(1+0.015*cm*tt), 2)
  - sin(radians(2*th))*rc*((c2-c1)/sc)*(2*sqrt(c1*c2)*sin(radians(dh/2))/(1+0.015*cm*tt)))) AS delta_e FROM d5)"""


EQUIV_SQL = f"""WITH {PAINTS_SQL}, {LAB_SQL},
live AS (SELECT id, brand, L, A, Bq FROM lab WHERE NOT discontinued),
pr AS (SELECT s.id, s.brand, t.id AS match, t.brand AS other, s.L AS l1, s.A AS a1, s.Bq AS b1, t.L AS l2, t.A AS a2, t.Bq AS b2 FROM live s JOIN live t ON s.brand <> t.brand AND abs(s.L - t.L) <= 17.471),
{delta_sql("pr")},
nb AS (SELECT id, other, match, delta_e, row_number() OVER (PARTITION BY id, other ORDER BY round(delta_e, 9), match) AS k FROM de WHERE delta_e <= 10),
top AS (SELECT id, match, delta_e, row_number() OVER (PARTITION BY id ORDER BY round(delta_e, 9), match) AS rank FROM nb WHERE k = 1)"""


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paints(spark, sf_dir).where("NOT discontinued")


@query(EQUIV_SQL + " SELECT id, CAST(rank AS INTEGER) AS rank, match, CAST(floor(delta_e * 1000 + 1e-6) AS BIGINT) AS milli, CASE WHEN delta_e <= 5 THEN 'close' ELSE 'substitute' END AS tier FROM top WHERE rank <= 5")
def equiv_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = equivalents(_live(spark, sf_dir))
    return found.select("id", "rank", "match", F.floor(F.col("delta_e") * 1000 + 1e-6).alias("milli"), "tier")


@query(EQUIV_SQL + """, e AS (SELECT id, match, delta_e FROM top WHERE rank <= 5), both_ AS (SELECT * FROM e UNION ALL SELECT match, id, delta_e FROM e),
m AS (SELECT id, match, min(delta_e) AS d FROM both_ WHERE id <> match GROUP BY ALL)
SELECT id, count(*) AS n, list_sort(list(match)) AS matches, CAST(floor(min(d) * 1000 + 1e-6) AS BIGINT) AS nearest_milli FROM m GROUP BY id""")
def equiv_bidirectional(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bidirectional(equivalents(_live(spark, sf_dir)))
    return both.select("id", "n", F.array_sort("equivalents.match").alias("matches"), F.floor(F.col("nearest") * 1000 + 1e-6).alias("nearest_milli"))


@query(f"WITH {PAINTS_SQL}, {LAB_SQL} SELECT id, CAST(floor(L * 1000 + 1e-6) AS BIGINT) AS l_milli, CAST(floor(A * 1000 + 1e-6) AS BIGINT) AS a_milli, CAST(floor(Bq * 1000 + 1e-6) AS BIGINT) AS b_milli FROM lab")
def lab_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    milli = lambda c: F.floor(F.col(c) * 1000 + 1e-6)
    return with_lab(paints(spark, sf_dir)).select("id", milli("lab_l").alias("l_milli"), milli("lab_a").alias("a_milli"), milli("lab_b").alias("b_milli"))


@query(f"WITH {PAINTS_SQL}, {LAB_SQL}, pr AS (SELECT s.id, s.L AS l1, s.A AS a1, s.Bq AS b1, t.L AS l2, t.A AS a2, t.Bq AS b2 FROM lab s JOIN lab t ON t.id = s.id + 1), {delta_sql('pr')} SELECT id, CAST(floor(delta_e * 1000 + 1e-6) AS BIGINT) AS milli FROM de")
def delta_e_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = with_lab(paints(spark, sf_dir))
    one = lab.select("id", F.col("lab_l").alias("l1"), F.col("lab_a").alias("a1"), F.col("lab_b").alias("b1"))
    two = lab.select((F.col("id") - 1).alias("id"), F.col("lab_l").alias("l2"), F.col("lab_a").alias("a2"), F.col("lab_b").alias("b2"))
    return with_delta_e(one.join(two, "id"), ("l1", "a1", "b1"), ("l2", "a2", "b2")).select("id", F.floor(F.col("delta_e") * 1000 + 1e-6).alias("milli"))
