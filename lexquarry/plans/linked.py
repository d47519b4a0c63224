"""Queries of the nested-record and orphan-reference operators over their whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.functions.keys import order_key
from lexquarry.operators import nested, orphans
from lexquarry.session import spread, table


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "raw_records").select("record_id", "payload"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nested object of every record with its path and its parent's path."""
    return nested.declared(nested.nodes(_raw(spark, sf_dir))).select("record_id", "node_path", "parent_path")


def _p4_table(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return nested.child_table(nested.nodes(_raw(spark, sf_dir)), kind)

    query.__doc__ = f"The flat child table of kind {kind}."
    return query


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the records."""
    return nested.record_table(_raw(spark, sf_dir))


def p4_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged schema of the records: field patterns with the kinds of their values."""
    return nested.schema(nested.records(_raw(spark, sf_dir)))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, order_key, loaded_at): all references of the three tables to orders."""
    articles, orders, sources = (table(spark, sf_dir, t) for t in ("code_articles", "dole_orders", "sources"))
    parts = [
        articles.select(F.lit("code_articles").alias("tab"), "rec_id", F.explode("metadata.implementing_orders").alias("printed"), "loaded_at"),
        orders.select(F.lit("dole_orders").alias("tab"), "rec_id", F.explode("metadata.supersedes").alias("printed"), "loaded_at"),
        sources.select(F.lit("sources").alias("tab"), "rec_id", F.col("superseded_by").alias("printed"), "loaded_at"),
    ]
    return reduce(DataFrame.unionByName, parts).select("tab", "rec_id", order_key(F.col("printed")).alias("order_key"), "loaded_at")


def _order_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "dole_orders").withColumn("order_key", order_key(F.col("order_number")))
    return orphans.lives(orders, "order_key", "is_deleted", "loaded_at", "rec_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference to an order that is missing, deleted, or loaded later."""
    return orphans.orphans(references(spark, sf_dir), _order_lives(spark, sf_dir))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month of loading and reason."""
    return orphans.report(p6_found(spark, sf_dir))


QUERIES = {
    "p4_found": p4_found,
    "p4_records": p4_records,
    "p4_schema": p4_schema,
    **{f"p4_{kind}s": _p4_table(kind) for kind in nested.COLUMNS},
    "p6_found": p6_found,
    "p6_report": p6_report,
}

_KEY_SQL = r"""CASE WHEN regexp_matches({s}, '{p}') THEN
  'DO-' || regexp_extract({s}, '{p}', 1)
  || CASE WHEN regexp_extract({s}, '{p}', 2) <> '' THEN '-' || regexp_extract({s}, '{p}', 2) ELSE '' END
  || '-' || right(regexp_extract({s}, '{p}', 3), 2) END"""
_PRINTED = r"^D(?:\.?O\.?|EPARTMENT ORDER)[ -]*(?:NO\.?)?[ -]*0*([0-9]+)(?:[ -]*([A-Z]))?(?:[ -]+|, *SERIES OF +| *\()([0-9]{{2,4}})\)?$".replace("{{", "{").replace("}}", "}")


def _key_sql(column: str) -> str:
    clean = f"upper(trim(regexp_replace(translate({column}, '‐‑‒–—―−﹘﹣－', '----------'), '[\\s\\x{{A0}}\\x{{202F}}]+', ' ', 'g')))".replace("{{", "{").replace("}}", "}")
    return _KEY_SQL.format(s=clean, p=_PRINTED)


P6_SQL = f"""
WITH refs AS (
  SELECT 'code_articles' AS tab, rec_id, unnest(metadata.implementing_orders) AS printed, loaded_at FROM code_articles
  UNION ALL SELECT 'dole_orders', rec_id, unnest(metadata.supersedes), loaded_at FROM dole_orders
  UNION ALL SELECT 'sources', rec_id, superseded_by, loaded_at FROM sources
), keyed AS (SELECT tab, rec_id, {_key_sql('printed')} AS order_key, loaded_at FROM refs WHERE printed IS NOT NULL),
lives AS (
  SELECT {_key_sql('order_number')} AS order_key, min(loaded_at) AS born, arg_max(is_deleted, (loaded_at, rec_id)) AS gone
  FROM dole_orders GROUP BY 1
), judged AS (
  SELECT DISTINCT k.tab, k.rec_id, k.order_key,
    CASE WHEN l.order_key IS NULL THEN 'missing' WHEN l.gone THEN 'deleted' WHEN l.born > k.loaded_at THEN 'late' END AS reason,
    strftime(k.loaded_at, '%Y-%m') AS load_month
  FROM keyed k LEFT JOIN lives l USING (order_key) WHERE k.order_key IS NOT NULL
), found AS (SELECT * FROM judged WHERE reason IS NOT NULL)
"""

def _opened(x: str) -> str:
    """What JSON text in a string holds; other values as they are."""
    return f"CASE json_type({x}) WHEN 'VARCHAR' THEN CASE WHEN json_valid(ltrim({x}->>'$', chr(65279) || ' ')) THEN CAST(ltrim({x}->>'$', chr(65279) || ' ') AS JSON) END ELSE {x} END"


def _listed(x: str) -> str:
    """The elements of an array, or of a lone object."""
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) WHEN 'OBJECT' THEN [{x}] END"


P4_SQL = f"""
WITH RECURSIVE root AS (
  SELECT record_id, CASE WHEN json_valid(p) THEN CAST(p AS JSON) END AS j FROM (SELECT record_id, ltrim(payload, chr(65279)) AS p FROM raw_records)
), many AS (SELECT record_id, json_type(j) = 'ARRAY' AS many, CASE json_type(j) WHEN 'ARRAY' THEN CAST(j AS JSON[]) WHEN 'OBJECT' THEN [j] END AS items FROM root),
recs AS (SELECT record_id, CASE WHEN many THEN '$[' || (i - 1) || ']' ELSE '$' END AS record_path, items[i] AS rec FROM (SELECT *, unnest(range(1, len(items) + 1)) AS i FROM many) WHERE json_type(items[i]) = 'OBJECT'),
meta AS (SELECT *, {_opened("(rec->'$.metadata')")} AS m FROM recs),
legal AS (SELECT *, {_opened("(m->'$.legal_status')")} AS l FROM meta),
fields AS (
  SELECT record_id, record_path, unnest([{{'kind': 'section', 'field': 'sections', 'x': rec->'$.sections'}}, {{'kind': 'subsection', 'field': 'subsections', 'x': rec->'$.subsections'}},
    {{'kind': 'amendment', 'field': 'metadata.amendments', 'x': m->'$.amendments'}}, {{'kind': 'footnote', 'field': 'metadata.footnotes', 'x': m->'$.footnotes'}},
    {{'kind': 'heading_footnote', 'field': 'metadata.heading_footnotes', 'x': m->'$.heading_footnotes'}}, {{'kind': 'status_change', 'field': 'metadata.legal_status.changes', 'x': l->'$.changes'}}]) AS f FROM legal
), opened AS (SELECT record_id, record_path, f.kind AS kind, record_path || '.' || f.field AS spot, record_path AS parent_path, {_opened('f.x')} AS x FROM fields WHERE f.x IS NOT NULL),
n AS (
  SELECT record_id, record_path, kind, 1 AS level, spot || '[' || (i - 1) || ']' AS node_path, parent_path, CAST(i - 1 AS INT) AS ord, ls[i] AS node
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, {_listed('x')} AS ls FROM opened)) WHERE json_type(ls[i]) = 'OBJECT'
  UNION ALL
  SELECT record_id, record_path, 'subsection', level + 1, node_path || '.subsections[' || (i - 1) || ']', node_path, CAST(i - 1 AS INT), ls[i]
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, {_listed('x')} AS ls FROM (SELECT * EXCLUDE (node), {_opened("(node->'$.subsections')")} AS x FROM n WHERE kind IN ('section', 'subsection')))) WHERE json_type(ls[i]) = 'OBJECT'
)"""

def _child_sql(kind: str) -> str:
    types = {"string": "node->>'$.{f}'", "date": "TRY_CAST(node->>'$.{f}' AS DATE)", "int": "TRY_CAST(node->>'$.{f}' AS INT)"}
    columns = ", ".join(f"{types[t].format(f=f)} AS {c}" for c, (f, t) in nested.COLUMNS[kind].items())
    return f"{P4_SQL} SELECT record_id, record_path, node_path, parent_path, ord, level, {columns} FROM n WHERE kind = '{kind}'"


ORACLE = {
    "p4_found": P4_SQL + " SELECT record_id, node_path, parent_path FROM n",
    "p4_records": P4_SQL + """ SELECT record_id, record_path,
          CASE WHEN (rec->>'$.article_number') IS NOT NULL THEN 'article' WHEN (rec->>'$.order_number') IS NOT NULL THEN 'order' ELSE 'unknown' END AS record_kind,
          rec->>'$.order_number' AS order_number, TRY_CAST(rec->>'$.article_number' AS INT) AS article_number, rec->>'$.title' AS title, rec->>'$.book' AS book, rec->>'$.title_name' AS title_name,
          rec->>'$.content' AS content, rec->>'$.metadata.legal_status.status' AS legal_status FROM recs""",
    **{f"p4_{kind}s": _child_sql(kind) for kind in nested.COLUMNS},
    "p6_found": P6_SQL + "SELECT tab, rec_id, order_key, reason, load_month FROM found",
    "p6_report": P6_SQL + "SELECT tab, load_month, reason, count(*) AS n_rows, count(DISTINCT order_key) AS n_orders FROM found GROUP BY 1, 2, 3",
}
