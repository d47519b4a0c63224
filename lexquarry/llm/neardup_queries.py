"""Queries of the near-duplicate operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import neardup
from lexquarry.llm.text_queries import texts
from lexquarry.session import spread


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(texts(spark, sf_dir, "order_sections").unionByName(texts(spark, sf_dir, "code_articles")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of one table whose shares of common three-word sequences reach 0.75."""
    return neardup.similar_pairs(_contents(spark, sf_dir))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of each record that has a near-duplicate, and the first record with the same text."""
    return neardup.groups(_contents(spark, sf_dir))


QUERIES = {"p7_found": p7_found, "p7_groups": p7_groups}

ORACLE = {
    "p7_found": r"""
        WITH t AS (
          SELECT 'order_sections' AS tab, rec_id, content FROM order_sections
          UNION ALL SELECT 'code_articles', rec_id, content FROM code_articles
        ), w AS (
          SELECT tab, rec_id, list_filter(string_split_regex(lower(content), '[ \t\n\r\f]+'), lambda x: x <> '') AS ws FROM t WHERE content IS NOT NULL
        ), s AS (
          SELECT DISTINCT tab, rec_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w WHERE len(ws) >= 40
        ), n AS (SELECT tab, rec_id, count(*) AS n FROM s GROUP BY 1, 2),
        c AS (
          SELECT a.tab, a.rec_id AS id_a, b.rec_id AS id_b, count(*) AS k FROM s a JOIN s b ON a.tab = b.tab AND a.g = b.g AND a.rec_id < b.rec_id GROUP BY 1, 2, 3
        )
        SELECT c.tab, id_a, id_b FROM c JOIN n x ON x.tab = c.tab AND x.rec_id = id_a JOIN n y ON y.tab = c.tab AND y.rec_id = id_b
        WHERE k >= 0.75 * (x.n + y.n - k)""",
}
ORACLE["p7_groups"] = f"""
    WITH RECURSIVE p AS ({ORACLE['p7_found']}), e AS (SELECT tab, id_a AS x, id_b AS y FROM p UNION ALL SELECT tab, id_b, id_a FROM p),
    w AS (SELECT tab, x, y FROM e UNION SELECT w.tab, w.x, e.y FROM w JOIN e ON e.tab = w.tab AND e.x = w.y),
    c AS (
      SELECT 'order_sections' AS tab, rec_id, min(rec_id) OVER (PARTITION BY content) AS copy_of FROM order_sections
      UNION ALL SELECT 'code_articles', rec_id, min(rec_id) OVER (PARTITION BY content) FROM code_articles
    ), g AS (SELECT tab, x AS rec_id, least(x, min(y)) AS class_id FROM w GROUP BY tab, x)
    SELECT tab, rec_id, class_id, copy_of FROM g JOIN c USING (tab, rec_id)"""
