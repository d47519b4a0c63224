"""Page texts as a stream: the batch cleanup on files as they arrive, and counts by time of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.operators.pages import clean_pages, split_pages


def arriving_pages(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """(doc_id, arrived, page_no, raw, content, warning) of text files that arrive in a folder."""
    stream = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    named = stream.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("doc_id"), F.col("_metadata.file_modification_time").alias("arrived"), F.col("value")
    )
    return clean_pages(split_pages(named))


def warnings_by_hour(pages: DataFrame, late: str = "2 hours") -> DataFrame:
    """(window, warning, n_pages) with a watermark, so state of closed hours is dropped."""
    return pages.withWatermark("arrived", late).groupBy(F.window("arrived", "1 hour"), "warning").agg(F.count("*").alias("n_pages"))
