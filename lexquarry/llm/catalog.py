"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from lexquarry.llm import encoding_queries, leakage_queries, mixing_queries, neardup_queries, pii_queries, scan_queries, text_queries

MODULES = (text_queries, scan_queries, encoding_queries, neardup_queries, leakage_queries, mixing_queries, pii_queries)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
