"""All registered catalog queries and their SQL."""

from ledgerforge.plans import catalog_sets, colour_queries, payload_queries, resolve_queries, run_queries, small_queries, source_queries, text_queries, walk_queries
from ledgerforge.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "catalog_sets", "colour_queries", "payload_queries", "resolve_queries", "run_queries", "small_queries", "source_queries", "text_queries", "walk_queries"]
