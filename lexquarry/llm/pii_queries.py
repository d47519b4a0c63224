"""Queries of the personal-information operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import pii
from lexquarry.session import spread, table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal information in every document."""
    return pii.personal_spans(_documents(spark, sf_dir))


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with typed placeholders instead."""
    return pii.redacted(_documents(spark, sf_dir))


QUERIES = {"p10_found": p10_found, "p10_redacted": p10_redacted}
ORACLE: dict[str, str] = {}
