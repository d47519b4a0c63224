"""Queries of the scan-repair operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.llm import scans
from lexquarry.session import spread, table


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "scan_pages").select(
        F.lit("scan_pages").alias("tab"), F.col("page_id").alias("rec_id"), F.col("order_number").alias("doc"), "scan_no", "page_no", F.col("raw_text").alias("text")
    )
    sections = table(spark, sf_dir, "order_sections").where("ocr_text").select(
        F.lit("order_sections").alias("tab"), "rec_id", F.col("order_number").alias("doc"), F.lit(None).cast("int").alias("scan_no"), F.lit(None).cast("int").alias("page_no"), F.col("content").alias("text")
    )
    return spread(pages.unionByName(sections))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with furniture, stray marks, broken or misread words, by kind."""
    return scans.noise(_scanned(spark, sf_dir))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired paragraphs of every scanned text."""
    return scans.paragraphs(_scanned(spark, sf_dir))


QUERIES = {"p2_found": p2_found, "p2_paragraphs": p2_paragraphs}
ORACLE: dict[str, str] = {}
