"""Registered queries against their SQL, on the smallest tables."""

import os
from collections import Counter
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerforge.plans.catalog_queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
SOME = ["sitemap_tree", "listing_names", "facet_plan", "page_origins", "archived_evidence", "decision_replay", "bucketed_ledger", "source_runs", "page_walks", "type_rules", "yaml_round_trip", "migration_again", "shopify_paint_collections", "woo_paint_categories", "numbered_product_pages", "listed_product_tiles", "browser_product_lines", "nested_ld_gtins", "decisions_applied", "verdict_counters", "equiv_top5", "lab_convert", "ean_normalize", "slug_marks", "gs1_prefix_attribution", "jsonld_extract", "components", "survivorship", "ean_primary", "ean_decision", "lifecycle_status", "category_fallback", "forced_join", "unresolved_forced_joins", "left_out_reports", "reconcile", "liveness_flags", "detail_queue_budget", "windows_session"]


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", SOME)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in glob(f"{SMALL}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df, sql = QUERIES[name](spark, SMALL), con.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    want = Counter(tuple(plain(r[sql.columns.index(c)]) for c in columns) for r in sql.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
