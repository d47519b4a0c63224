"""Queries over single texts: sentence units and pieces of oversized texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.llm import sentences, splitting
from lexquarry.session import spread, table


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(tab, rec_id, text) of the contents of a table."""
    return table(spark, sf_dir, name).select(F.lit(name).alias("tab"), "rec_id", F.col("content").alias("text"))


def _sentence_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = table(spark, sf_dir, "order_sections").where("NOT ocr_text").select(F.lit("order_sections").alias("tab"), "rec_id", F.col("content").alias("text"), "lang")
    clauses = table(spark, sf_dir, "dole_orders").select(F.lit("dole_orders").alias("tab"), "rec_id", F.col("metadata.effectivity_clause").alias("text"), F.lit(None).cast("string").alias("lang"))
    return spread(sections.unionByName(clauses))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence units of all section contents that are no scans, and of all effectivity clauses."""
    return sentences.sentence_units(_sentence_texts(spark, sf_dir))


def p1_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the units of each text hold all of it: their digest without blanks."""
    return sentences.covered(_sentence_texts(spark, sf_dir)).select("tab", "rec_id", "digest")


def _limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "size_limits").where("field = 'content'").select("tab", "max_chars", "overlap_chars")
    rows = spread(texts(spark, sf_dir, "order_sections").unionByName(texts(spark, sf_dir, "code_articles")))
    return rows.join(limits, "tab")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every content that is longer than the limit of its table."""
    return splitting.split_rows(splitting.oversized(_limited(spark, sf_dir)))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that had to be split: those with a second piece."""
    return p3_pieces(spark, sf_dir).where("piece_no = 1").select("tab", "rec_id")


def p3_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the pieces of each oversized text make it up again and keep to its limit."""
    limits = table(spark, sf_dir, "size_limits").where("field = 'content'").select("tab", "max_chars", "overlap_chars")
    pieces = p3_pieces(spark, sf_dir).join(limits, "tab")
    own = F.when(F.col("piece_no") == 0, F.col("piece")).otherwise(F.substr("piece", F.col("overlap_chars") + 1))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", own.alias("own")))), lambda p: p["own"]), "")
    return pieces.groupBy("tab", "rec_id").agg(F.md5(whole).alias("digest"), F.min(F.char_length("piece") <= F.col("max_chars")).alias("fits"))


QUERIES = {"p1_found": p1_found, "p1_cover": p1_cover, "p3_cover": p3_cover, "p3_found": p3_found, "p3_pieces": p3_pieces}

_BLANKS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ORACLE = {
    "p1_cover": f"""
        SELECT 'order_sections' AS tab, rec_id, md5(regexp_replace(content, '{_BLANKS}', '', 'g')) AS digest FROM order_sections WHERE NOT ocr_text AND content IS NOT NULL
        UNION ALL SELECT 'dole_orders', rec_id, md5(regexp_replace(metadata.effectivity_clause, '{_BLANKS}', '', 'g')) FROM dole_orders WHERE metadata.effectivity_clause IS NOT NULL""",
    "p3_cover": """
        SELECT t.tab, t.rec_id, md5(t.content) AS digest, true AS fits FROM (
          SELECT 'order_sections' AS tab, rec_id, content FROM order_sections
          UNION ALL SELECT 'code_articles', rec_id, content FROM code_articles
        ) t JOIN size_limits l ON l.tab = t.tab AND l.field = 'content' WHERE length(t.content) > l.max_chars""",
    "p3_found": """
        SELECT t.tab, t.rec_id FROM (
          SELECT 'order_sections' AS tab, rec_id, content FROM order_sections
          UNION ALL SELECT 'code_articles', rec_id, content FROM code_articles
        ) t JOIN size_limits l ON l.tab = t.tab AND l.field = 'content' WHERE length(t.content) > l.max_chars""",
}
