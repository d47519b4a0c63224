"""Queries of the mixing operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import mixing
from lexquarry.session import cut, spread, table


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(mixing.with_tokens(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the mix with their sizes and numbers of copies."""
    return mixing.mix(_sizes(spark, sf_dir), table(spark, sf_dir, "source_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    sizes, targets = _sizes(spark, sf_dir), table(spark, sf_dir, "source_targets")
    return mixing.report(mixing.mix(sizes, targets), sizes, targets)


def p9_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each source keeps to its goal and its cap."""
    sizes, targets = _sizes(spark, sf_dir), table(spark, sf_dir, "source_targets")
    return mixing.within(mixing.mix(sizes, targets), sizes, targets)


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_within": p9_within}
ORACLE = {"p9_within": "SELECT DISTINCT lower(trim(source)) AS source, true AS on_target, true AS in_cap FROM source_targets"}
