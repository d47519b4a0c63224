"""References to records that do not exist, are deleted, or arrive later.

References and parents are both partitioned by the key and sorted on it; one linear merge of the
two sorted streams (Spark's sort-merge join) gives each reference the life of its parent: when the
key first arrived, and whether its latest delivery is a deletion. Parents are first reduced to one
row per key, with a partial aggregate before the shuffle.

A key that holds a large part of all references would land in one task. Keys with at least
``1/hot_share`` of the references (and ``least`` rows) are spread over ``spread`` salts on the reference side, and
only their parent rows are repeated; there are at most ``hot_share`` such keys, so the list of them
has a proven bound and may be broadcast.

Defined results: references that are null or no order number give no row; a reference repeated
within one row gives one row; a null arrival time of either side never makes a reference late;
of deliveries at the same time the one with the larger surrogate id is the latest; without
references the result is empty; without parents every reference is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ("tab", "rec_id", "order_key")


def lives(parents: DataFrame, key: str, deleted: str, loaded: str, tie: str) -> DataFrame:
    """(order_key, born, gone): one row per parent key with its first arrival and its last state."""
    return (
        parents.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("order_key"))
        .agg(
            F.min(loaded).alias("born"),
            F.max_by(F.coalesce(F.col(deleted), F.lit(False)), F.struct(F.col(loaded), F.col(tie))).alias("gone"),
        )
    )


def orphans(refs: DataFrame, parents: DataFrame, hot_share: int = 256, spread: int = 32, least: int = 1000) -> DataFrame:
    """(tab, rec_id, order_key, reason, load_month) from refs (tab, rec_id, order_key, loaded_at) and :func:`lives`."""
    refs = refs.where(F.col("order_key").isNotNull()).select(*KEYS, "loaded_at")
    counts = refs.groupBy("order_key").count()
    total = counts.agg(F.sum("count").alias("total"))
    hot = (
        counts.join(F.broadcast(total)).where(F.col("count") * hot_share >= F.greatest(F.col("total"), F.lit(hot_share * least)))
        .select("order_key", F.lit(True).alias("hot"))
    )
    hot = F.broadcast(hot)
    salted = refs.join(hot, "order_key", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("tab", "rec_id"), F.lit(spread)).cast("int")).otherwise(0)
    )
    repeated = parents.join(hot, "order_key", "left").withColumn(
        "salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0))))
    ).drop("hot")
    merged = salted.join(repeated.hint("merge"), ["order_key", "salt"], "left")
    reason = (
        F.when(F.col("gone").isNull(), "missing").when(F.col("gone"), "deleted")
        .when(F.col("born") > F.col("loaded_at"), "late")
    )
    # Repeats within a row lie in one task already: the distinct below needs no further row exchange for them.
    return (
        merged.withColumn("reason", reason).where("reason IS NOT NULL")
        .withColumn("load_month", F.date_format("loaded_at", "yyyy-MM"))
        .select(*KEYS, "reason", "load_month").distinct()
    )


def report(found: DataFrame) -> DataFrame:
    """(tab, load_month, reason, n_rows, n_orders): orphans per table and month of loading."""
    return found.groupBy("tab", "load_month", "reason").agg(
        F.count("*").alias("n_rows"), F.count_distinct("order_key").alias("n_orders")
    )
