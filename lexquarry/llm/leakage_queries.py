"""Queries of the evaluation-leak operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import leakage
from lexquarry.session import spread, table


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak with its field, kind and length."""
    return leakage.leaks(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least twelve consecutive words of an item."""
    return p8_leaks(spark, sf_dir).where("kind <> 'paraphrase'").select("doc_id", "item_id").distinct()


QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks}

ORACLE = {
    "p8_found": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        i AS (
          SELECT item_id, regexp_extract_all(lower(x), '[\p{L}\p{N}]+') AS w
          FROM (SELECT item_id, unnest([question, expected_answer]) AS x FROM eval_items)
        ),
        dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM d WHERE len(w) >= 12),
        ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM i WHERE len(w) >= 12)
        SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
}
