"""All queries of the core and their SQL."""

from __future__ import annotations

from lexquarry.plans import linked, record_plans, text_plans

MODULES = (text_plans, record_plans, linked)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
