"""Legal-style texts rendered from typed tables, to be parsed back; independent of the parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexquarry.session import deal, table

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _month(c: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(c))


def printed(day: Column, style: Column) -> Column:
    """A date in one of three printed styles."""
    return (
        F.when(style == 0, F.format_string("%s %d, %d", _month(day), F.dayofmonth(day), F.year(day)))
        .when(style == 1, F.format_string("%dth day of %s, %d", F.dayofmonth(day), _month(day), F.year(day)))
        .otherwise(F.format_string("%d %s %d", F.dayofmonth(day), F.upper(F.left(_month(day), F.lit(3))), F.year(day)))
    )


def clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, clause, published, signed): effectivity clauses of nine kinds from ``orders``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    kind, n = F.col("o_orderkey") % 9, (F.col("o_orderkey") % 89 + 1).cast("int")
    clause = (
        F.when(kind == 0, F.format_string("This Order shall take effect %d days after its publication in a newspaper.", n))
        .when(kind == 1, F.lit("This Order shall take effect fifteen (15) calendar days following publication."))
        .when(kind == 2, F.lit("These Rules shall be effective immediately upon signing."))
        .when(kind == 3, F.concat(F.lit("This Order shall take effect on "), printed(F.date_add("d", n), F.lit(0)), F.lit(".")))
        .when(kind == 4, F.format_string("This Order shall take effect %d working days after publication.", n))
        .when(kind == 5, F.lit("This Order shall take effect upon publication."))
        .when(kind == 6, F.lit("This Order shall take effect sixty days from approval."))
        .when(kind == 7, F.lit("This Order shall take effect thirty days after filing with the registry."))
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), clause.alias("clause"), F.when(F.col("o_orderkey") % 11 > 0, F.col("d")).alias("published"), F.date_sub("d", 7).alias("signed"))


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): whole orders from ``orders`` and ``lineitem``.

    Items that share a line number become repeated sections of different length; a cross reference
    in each body stands at a line start; documents whose key is divisible by three are grouped.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    item = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_quantity").cast("int").alias("q"),
    )
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def section(x: Column) -> Column:
        body = F.concat(F.lit("The employer shall keep lot "), x["p"], F.lit(" and"), F.repeat(F.lit(" more"), x["q"]), F.lit(".\nSection 9 of the same order applies."))
        return F.concat(F.lit("Section "), x["n"], F.lit(". Lot "), x["s"], F.lit(". — "), body)

    head = F.concat(F.lit("DEPARTMENT ORDER NO. "), F.col("o_orderkey") % 900 + 1, F.lit(", Series of "), F.year("d"), F.lit("\nRULES ON LOTS\n\n"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("RULE I\n")).otherwise(""))
    tail = F.concat(F.lit("\n\nDone in the City, this "), printed(F.col("d"), F.lit(1)), F.lit("."))
    text = F.concat(head, F.array_join(F.transform("items", section), "\n\n"), tail)
    return o.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


def whole_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, file_name, text, published): orders with a cover, citations, an enumeration, a repeal, a clause and a signature block.

    Every tenth order has no sections; every fourth has a letter in its number.
    """
    k = F.col("o_orderkey")
    o = deal(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d")), "o_orderkey")
    letter = F.when(k % 4 == 0, F.concat(F.lit("-"), F.element_at(F.array(*map(F.lit, "ABC")), (k % 3 + 1).cast("int")))).otherwise("")
    cover = F.concat(
        F.lit("Republic\n\nDEPARTMENT ORDER NO. "), k % 900 + 1, letter, F.lit("-"), F.right(F.year("d").cast("string"), F.lit(2)), F.lit("\nSeries of "), F.year("d"),
        F.lit("\n\nRULES ON THE LOADING OF\nLOT "), F.col("o_custkey"),
        F.lit("\n\nPursuant to R.A. No. "), k % 9000 + 1000, F.lit(" and Presidential Decree No. "), k % 899 + 1, F.lit(", as amended by B.P. Blg. 7, these rules on wages are issued.\n\n"),
    )
    sections = F.concat(
        F.lit("Section 1. Coverage. — It covers minimum wages, wages and more wages.\n(a) first "), k, F.lit("\n(1) one\n(2) two\n(b) second\n\nSection 2. Repeal. — Department Order No. "), k % 50 + 1, F.lit(", Series of "),
        k % 20 + 2000, F.lit(" is hereby superseded.\n\nThe board keeps D.O. No. 77-99 as amended.\n\nSection 3. Effectivity. — Under Sec. 5 of the Code, this Order shall take effect "), k % 89 + 1, F.lit(" days after its publication."),
    )
    plain = F.lit("Nothing is listed here. This Order shall take effect immediately upon signing.")
    tail = F.concat(F.lit("\n\nDone in the City, this "), printed(F.col("d"), F.lit(1)), F.lit(".\n\nANA B. REYES\nSecretary of Lot "), F.col("o_custkey"))
    return o.select(
        k.alias("doc_id"), F.lit("DO-1-01.pdf").alias("file_name"), F.concat(cover, F.when(k % 10 == 9, plain).otherwise(sections), tail).alias("text"),
        F.when(k % 11 > 0, F.date_add("d", 10)).alias("published"),
    )


#: Customers per rendered code, and per page of it.
CODE_SIZE, PAGE_SIZE = 40, 5


def noted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, content): pages of codes of forty customers each, with a note to the title and one to each article."""
    at = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.floor(at / CODE_SIZE).alias("doc_id"), (at % CODE_SIZE).alias("i"))
    c = c.withColumn("page_no", F.floor(F.col("i") / PAGE_SIZE) + 1)
    article = F.concat(F.lit("Art. "), F.col("i") + 1, F.lit(". ["), F.col("c_custkey") % 500 + 1, F.lit("] Duty of "), "c_custkey", F.lit(". — The employer shall pay under Article 99."), F.col("i") + 2)
    note = F.concat(F.col("i") + 2, F.when(F.col("c_custkey") % 3 == 0, F.lit(" As inserted by R.A. No. ")).otherwise(F.lit(" As amended by R.A. No. ")), F.col("c_custkey") % 9000 + 1000, F.lit(", March 1, 2001. See D.O. No. 05, Series of 2003."))
    ordered = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", x.alias("x")))), lambda y: y["x"]), "\n")
    page = c.groupBy("doc_id", "page_no").agg(ordered(article).alias("a"), ordered(note).alias("n"))
    first = F.col("page_no") == 1
    return page.select("doc_id", F.col("page_no").cast("int").alias("page_no"), F.concat(
        F.when(first, F.lit("BOOK ONE\nTITLE II – WORK.1\n")).otherwise(""), "a", F.lit("\n"), F.when(first, F.lit("1 Of the title.\n")).otherwise(""), "n",
    ).alias("content"))


def statute_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): one code per market segment and fifty customer keys; nations are titles or chapters of books by region, customers articles."""
    roman = F.array(*map(F.lit, ["ONE", "TWO", "THREE", "FOUR", "FIVE"]))
    c = table(spark, sf_dir, "customer").withColumn("doc", F.concat("c_mktsegment", F.lit("-"), F.floor(F.col("c_custkey") / 50)))
    n = table(spark, sf_dir, "nation")
    rows = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    article = F.concat(F.lit("Art. "), F.col("c_custkey") % 999 + 1, F.lit(". ["), F.col("c_custkey") % 500 + 1, F.lit("] Duty of "), F.col("c_custkey"), F.lit(" — The employer shall pay.\nArticle 4 of this Code shall apply."))
    arts = rows.groupBy("doc", "n_regionkey", "n_nationkey", "n_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", article.alias("a")))), lambda x: x["a"]), "\n").alias("arts"))
    head = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("TITLE "), F.col("n_nationkey") + 1, F.lit(" – "), "n_name")).otherwise(F.concat(F.lit("CHAPTER "), F.col("n_nationkey") + 1, F.lit("\n"), "n_name"))
    nation = arts.groupBy("doc", "n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat(head, F.lit("\n"), "arts").alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    book = F.concat(F.lit("BOOK "), F.element_at(roman, F.col("n_regionkey") + 1), F.lit("\nNAME OF THE BOOK\n"), "t")
    return nation.groupBy(F.col("doc").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_regionkey", book.alias("b")))), lambda x: x["b"]), "\n").alias("text"))
