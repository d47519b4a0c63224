"""The source manifest: its rules, and lookups by content hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HASH = "^[0-9a-f]{64}$"
ORDER_ID = "^DO-[0-9]+(-[A-Z])?-[0-9]{2}$"
PLAIN_ID = "^[A-Za-z0-9_-]+$"


def _url(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://")


def problems(entries: DataFrame) -> DataFrame:
    """(id, problem): every broken rule of every entry; duplicates are counted with a partial aggregate."""
    rules = {
        "bad_id": ~F.col("id").rlike(PLAIN_ID),
        "bad_order_id": (F.col("kind") == "dole_order") & ~F.col("id").rlike(ORDER_ID),
        "bad_source_url": ~F.coalesce(_url(F.col("source_url")), F.lit(False)),
        "bad_download_url": ~_url(F.col("download_url")),
        "bad_published_date": F.col("published_date").isNotNull() & F.try_to_date("published_date", "yyyy-MM-dd").isNull(),
        "bad_superseded_by": ~F.col("superseded_by").rlike(ORDER_ID),
        "first_page_without_ocr": F.col("ocr_first_page").isNotNull() & ~F.coalesce("ocr", F.lit(False)),
        "bad_hash": ~F.col("sha256").rlike(HASH),
    }
    broken = F.filter(F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]), lambda x: x.isNotNull())
    single = entries.select("id", F.explode(broken).alias("problem"))
    twice = entries.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate_id").alias("problem"))
    shared = entries.where(F.col("sha256").rlike(HASH)).groupBy("sha256").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate_hash").alias("problem"))
    return reduce(DataFrame.unionByName, [single, twice, shared]).distinct()


def verified(docs: DataFrame, entries: DataFrame, key: str = "id") -> DataFrame:
    """Adds ``outcome`` to docs (key, sha256): verified, mismatch, unpinned or unknown."""
    pins = entries.groupBy(key).agg(F.max("sha256").alias("pin"), F.lit(True).alias("known"))
    outcome = F.when(F.col("known").isNull(), "unknown").when(F.col("pin").isNull(), "unpinned").when(F.col("pin") == F.col("sha256"), "verified").otherwise("mismatch")
    return docs.join(pins, key, "left").withColumn("outcome", outcome).drop("known", "pin")


def pinned(entries: DataFrame, hashes: DataFrame, key: str = "id") -> DataFrame:
    """Entries with missing hashes filled from hashes (key, found); existing pins never change."""
    return entries.join(hashes.select(key, "found"), key, "left").withColumn("sha256", F.coalesce("sha256", "found")).drop("found")


def by_hash(docs: DataFrame, entries: DataFrame, ids: tuple[str, ...] = ("id", "kind")) -> DataFrame:
    """Documents (with sha256) with ``entry_id`` and ``entry_kind`` of the entry that pins their hash; null if none does.

    Of entries with one hash the least id counts; malformed hashes pin nothing.
    """
    pins = entries.where(F.col("sha256").rlike(HASH)).groupBy("sha256").agg(F.min(F.struct(*ids)).alias("_e"))
    return docs.join(pins, "sha256", "left").withColumn("entry_id", F.col("_e.id")).withColumn("entry_kind", F.col("_e.kind")).drop("_e")


def chosen(entries: DataFrame, only: list[str] | None = None, scanned: bool | None = None) -> DataFrame:
    """The entries with the given ids (all, if none is given), and only scanned or only other ones."""
    if only:
        entries = entries.where(F.col("id").isin(only))
    return entries if scanned is None else entries.where(F.coalesce("ocr", F.lit(False)) == scanned)
