"""Queries of the wrong-decoding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.llm import encoding
from lexquarry.session import spread, table


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, tab).select(F.lit(tab).alias("tab"), "rec_id", F.lit(field).alias("field"), F.col(field).alias("text"))
        for tab, field in (("order_sections", "content"), ("dole_orders", "title"))
    ]
    return spread(parts[0].unionByName(parts[1]))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with characters that result from a wrong decoding."""
    return encoding.garbled(_fields(spark, sf_dir)).select("tab", "rec_id", "field")


def p5_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those records with their text restored where it can be."""
    return encoding.restored(_fields(spark, sf_dir))


QUERIES = {"p5_found": p5_found, "p5_restored": p5_restored}
ORACLE: dict[str, str] = {}
