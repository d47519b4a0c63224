"""Reconcile a hand-reviewed status table with parsed articles; any problem stops the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: Fixed value: words by which a footnote may tell of a change of status.
STATUS_WORDS = (
    r"(?i)supersed|repeal|inoperative|obsolete|unconstitutional|abolish|no longer|now being undertaken|been transferred|modified by|expired|"
    r"been replaced|replaced by|has affected|expanded by|qualified by|deemed|now refers|shall refer|absorb"
)


def spread(changes: DataFrame) -> DataFrame:
    """Changes of article ranges as one row per article: an interval join without a range condition."""
    return changes.withColumn("article_number", F.explode(F.sequence("first", "last")))


def problems(articles: DataFrame, notes: DataFrame, changes: DataFrame, unaffected: DataFrame) -> DataFrame:
    """(kind, article_number, footnote) of everything that does not fit.

    ``articles`` (article_number), ``notes`` (article_number, footnote, note_text) with heading notes,
    ``changes`` (first, last, footnote, …), ``unaffected`` (footnote, reason).
    """
    one = spread(changes)
    of = lambda df, kind, article="article_number": df.select(F.lit(kind).alias("kind"), F.col(article).cast("int").alias("article_number") if article else F.lit(None).cast("int").alias("article_number"), "footnote")
    seen = notes.select("footnote").distinct()
    status_like = notes.where(F.col("note_text").rlike(STATUS_WORDS)).select("article_number", "footnote").distinct()
    parts = [
        of(one.join(articles.select("article_number"), "article_number", "left_anti"), "no_such_article"),
        of(one.join(articles.select("article_number"), "article_number", "left_semi").join(notes, ["article_number", "footnote"], "left_anti"), "footnote_not_on_article"),
        of(changes.select("footnote").intersect(unaffected.select("footnote")), "listed_twice", None),
        of(unaffected.select("footnote").join(seen, "footnote", "left_anti"), "never_seen", None),
        of(status_like.join(changes, "footnote", "left_anti").join(unaffected, "footnote", "left_anti"), "not_reviewed"),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def roll_up(articles: DataFrame, changes: DataFrame) -> DataFrame:
    """(article_number, status, changes): changes in the order of the file; without a part they are of the whole article."""
    one = spread(changes).groupBy("article_number").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("file_ord", "effect", "part", "by", "footnote"))), lambda c: F.struct(c["effect"], c["part"], c["by"], c["footnote"])).alias("changes")
    )
    status = F.when(F.col("changes").isNull(), "no_change_noted").when(F.exists("changes", lambda c: c["part"].isNull()), "superseded").otherwise("partly_superseded")
    return articles.select("article_number").join(one, "article_number", "left").withColumn("status", status).select("article_number", "status", "changes")


def reconciled(articles: DataFrame, notes: DataFrame, changes: DataFrame, unaffected: DataFrame) -> DataFrame:
    """The roll-up, or an error that lists the first problems."""
    found = problems(articles, notes, changes, unaffected)
    if sample := found.take(20):
        raise ValueError("the status table does not fit: " + "; ".join(f"{r.kind} article {r.article_number} footnote {r.footnote}" for r in sample))
    return roll_up(articles, changes)


def applied(articles: DataFrame, changes: DataFrame, source_sha256: str) -> DataFrame:
    """(article_number, sha256, status, changes) of articles (article_number, sha256): the roll-up, but only
    for articles of the file that was reviewed; the status of others stays null."""
    same = F.col("sha256") == F.lit(source_sha256)
    rolled = roll_up(articles.where(same).select("article_number").distinct(), changes)
    kept = articles.select("article_number", "sha256").distinct()
    return kept.join(rolled.withColumn("sha256", F.lit(source_sha256)), ["article_number", "sha256"], "left")
