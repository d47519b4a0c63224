"""Pages of documents: cleanup, quality warnings, running headers and footers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexquarry.functions.text import clean, page_warning, squeeze

#: Pages that must share a line, its longest length in bytes, lines at each edge.
PAGES_SHARING, LINE_BYTES, EDGE_LINES = 3, 100, 2


def split_pages(docs: DataFrame, text: str = "value") -> DataFrame:
    """(…, page_no, raw): the pages of whole texts, which form feeds separate."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.posexplode(F.split(text, "\f", -1)).alias("i", "raw")).withColumn("page_no", F.col("i") + 1).drop("i")


def clean_pages(pages: DataFrame) -> DataFrame:
    """Adds ``content`` and ``warning`` to pages with ``raw``."""
    return pages.withColumn("content", clean(F.col("raw"))).withColumn("warning", page_warning(F.col("content")))


def edge_lines(content: Column) -> Column:
    """The distinct lines at both edges of a page, blank and long lines left out first."""
    lines = F.filter(F.transform(F.split(content, "\n", -1), squeeze), lambda x: (x != "") & (F.octet_length(x) <= LINE_BYTES))
    last = F.slice(lines, F.greatest(F.size(lines) - EDGE_LINES + 1, F.lit(1)), F.lit(EDGE_LINES))
    return F.array_distinct(F.concat(F.slice(lines, 1, EDGE_LINES), last))


def running_lines(pages: DataFrame, doc: list[str]) -> DataFrame:
    """(doc…, line, n): lines at the edges of at least three pages and half of all pages of a document."""
    total = pages.groupBy(*doc).agg(F.count("*").alias("n_pages"))
    lines = pages.select(*doc, F.explode(edge_lines(F.col("content"))).alias("line")).groupBy(*doc, "line").agg(F.count("*").alias("n"))
    return lines.join(total, doc).where((F.col("n") >= PAGES_SHARING) & (F.col("n") * 2 >= F.col("n_pages"))).select(*doc, "line", "n")


def without_running_lines(pages: DataFrame, running: DataFrame, doc: list[str], page: str = "page_no") -> DataFrame:
    """(doc…, page, content): pages without running lines; each stays where it occurs first.

    ``keep first`` is decided on the first page only, so pages are independent of each other.
    """
    first = Window.partitionBy(*doc)
    known = running.groupBy(*doc).agg(F.collect_set("line").alias("running"))
    marked = pages.withColumn("is_first", F.col(page) == F.min(page).over(first)).join(known, doc, "left")
    lines = F.split("content", "\n", -1)
    names = F.transform(lines, squeeze)

    def keep(line: Column, i: Column) -> Column:
        name = squeeze(line)
        again = F.array_contains(F.slice(names, F.lit(1), i), name)
        return F.col("running").isNull() | ~F.array_contains("running", name) | (F.col("is_first") & ~again)

    return marked.withColumn("content", F.array_join(F.filter(lines, keep), "\n")).drop("running", "is_first")
