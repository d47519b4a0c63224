"""Queries of the text, date and reference functions, and of the block and statute operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.functions import dates, refs, text
from lexquarry.operators import blocks, lists, orders, pages, statute
from lexquarry.plans import corpus
from lexquarry.session import spread, table


def effective_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective dates of rendered clauses."""
    c = corpus.clauses(spark, sf_dir)
    return c.select("doc_id", dates.effective_date(F.col("clause"), F.col("published"), F.col("signed")).alias("effective_date"), dates.offset_days(F.col("clause")).alias("offset_days"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates read back from three printed styles."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    shown = F.concat(F.lit("Given this "), corpus.printed(F.col("d"), F.col("o_orderkey") % 3), F.lit(" and again 1 January 2099."))
    return o.select(F.col("o_orderkey").alias("doc_id"), dates.first_date(shown).alias("found"))


def order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids read back from headers in both forms and from file names."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    k, letter = F.col("o_orderkey") % 999 + 1, F.when(F.col("o_orderkey") % 4 == 0, F.lit("-A")).otherwise("")
    head = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("DEPARTMENT ORDER NO. "), k, letter, F.lit("-"), F.right(F.col("y").cast("string"), F.lit(2)), F.lit("\nsee D.O. No. 1, Series of 2001")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Department Order No. "), k, letter, F.lit(", Series of "), "y", F.lit("\namends D.O. No. 7-99")))
        .otherwise("An order without a number")
    )
    name = F.concat(F.lit("DO-"), k, letter, F.lit("-"), "y", F.lit(".pdf"))
    return o.select(F.col("o_orderkey").alias("doc_id"), refs.order_number(head, name).alias("order_number"))


def _sections(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return spread(table(spark, sf_dir, "order_sections").select("rec_id", "content", *more))


def related_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts, decrees and the code cited in every section."""
    s = _sections(spark, sf_dir)
    return s.select("rec_id", F.array_join(refs.laws(F.col("content")), "|").alias("laws"))


def topic_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every section."""
    s = _sections(spark, sf_dir, "title")
    return s.select("rec_id", F.array_join(refs.tags(F.col("content"), F.col("title")), "|").alias("tags"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the cleaned text of every section."""
    return _sections(spark, sf_dir).select("rec_id", F.md5(text.clean(F.col("content"))).alias("digest"))


def repair_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles after the fixed repairs of garbled sequences."""
    return table(spark, sf_dir, "dole_orders").select("rec_id", text.ungarble(F.col("title")).alias("title"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "scan_pages").select("order_number", "scan_no", "page_no", "page_id", F.col("raw_text").alias("content"))


def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with no or little text."""
    return table(spark, sf_dir, "scan_pages").select("page_id", text.page_warning(F.col("raw_text")).alias("warning"))


def capital_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in capitals on each scanned page."""
    line = blocks.lines_of(table(spark, sf_dir, "scan_pages").select("page_id", "raw_text"), "raw_text")
    return line.groupBy("page_id").agg(
        F.sum(text.mostly_capitals(F.col("line")).cast("int")).alias("n_mostly"), F.sum(text.capital_heading(F.col("line")).cast("int")).alias("n_heading")
    )


def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running headers and footers of every scan."""
    return pages.running_lines(_pages(spark, sf_dir), ["order_number", "scan_no"])


def without_running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every scanned page without them."""
    p = _pages(spark, sf_dir)
    doc = ["order_number", "scan_no"]
    return pages.without_running_lines(p, pages.running_lines(p, doc), doc).select("page_id", F.md5("content").alias("digest"))


def split_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of blocks and distinct labels of rendered orders."""
    b = blocks.blocks(corpus.order_texts(spark, sf_dir))
    return b.where("kind = 'Section'").groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.count_distinct("label").alias("n_labels"), F.min("title").alias("first_title"))


def dedupe_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept section of each number of rendered orders, with its group."""
    s = blocks.sections(corpus.order_texts(spark, sf_dir)).where("kind = 'Section'")
    return s.select("doc_id", "section_number", "title")


def signed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signing dates of rendered orders."""
    return corpus.order_texts(spark, sf_dir).select("doc_id", orders.signed_date_of(F.col("text")).alias("signed_date"))


def statute_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of rendered codes in their context."""
    a = statute.articles(corpus.statute_text(spark, sf_dir))
    return a.select("doc_id", "ord", "article_number", "former_article_number", "book", "title_name", "chapter").drop("ord")


def nested_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of every enumeration in the sections."""
    s = _sections(spark, sf_dir).select("rec_id", F.explode(lists.items_of(F.col("content"))).alias("i"))
    return s.select("rec_id", "i.node", "i.parent", "i.level", "i.label", "i.path")


def article_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross references of articles, read from rendered text."""
    a = table(spark, sf_dir, "code_articles").select("rec_id", "article_number", F.sequence(F.col("article_number") + 1, F.col("article_number") + F.col("rec_id").cast("int") % 5 + 1).alias("s"))
    body = F.concat(
        F.lit("See Articles "), F.col("s")[0], F.lit(" to "), F.element_at("s", -1), F.lit(" of this Code, Article "), F.col("article_number"), F.lit(", and Article 900 of the Civil Code. Art. 7 and 3 apply."),
    )
    return a.select("rec_id", F.array_join(refs.related_articles(body, F.col("article_number")).cast("array<string>"), ",").alias("related"))


def footnote_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws and dates read from the first sentence of every amending footnote."""
    a = table(spark, sf_dir, "code_articles").select("rec_id", F.explode("metadata.footnotes").alias("f")).where(statute.amends(F.col("f.note_text")))
    lead = a.select("rec_id", F.col("f.note_number").alias("note_number"), orders.first_sentence_of(F.col("f.note_text")).alias("note"))
    return lead.select("rec_id", "note_number", F.array_join(refs.cited_laws(F.col("note")), "|").alias("laws"), F.when(F.size(refs.cited_laws(F.col("note"))) == 1, dates.first_date(F.col("note"))).alias("law_date"))


def _noted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = statute.footnotes(corpus.noted_pages(spark, sf_dir))
    return found.where("note_number IS NULL").select("doc_id", "text"), found.where("note_number IS NOT NULL").select("doc_id", "note_number", "note_text")


def statute_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footnotes of rendered codes."""
    return _noted(spark, sf_dir)[1]


def statute_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole article records of rendered codes, one per number, with what their footnotes say."""
    r = statute.records(*_noted(spark, sf_dir))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return r.select(
        "doc_id", "article_number", "former_article_number", "title_name", "heading", "content", "original", text("related_articles").alias("related"), text("implementing_orders").alias("orders"),
        F.array_join(F.transform("footnotes", lambda n: n["note_number"].cast("string")), ",").alias("notes"),
        F.array_join(F.transform("heading_footnotes", lambda n: F.concat(n["heading"], F.lit("="), n["note_text"])), ",").alias("heading_notes"),
        F.array_join(F.transform("amendments", lambda a: F.concat_ws("@", a["law"], a["law_date"].cast("string"))), ",").alias("amendments"),
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records of rendered orders."""
    found = orders.order_records(corpus.whole_orders(spark, sf_dir))[0]
    text = lambda c: F.array_join(c, "|").alias(c)
    return found.select("doc_id", "order_number", "title", "issuing_authority", "signed_date", "published_date", "effective_date", "effectivity_clause", text("supersedes"), text("related_laws"), text("tags"))


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of rendered orders with their enumerations; orders without any have one of the whole text."""
    found = orders.order_records(corpus.whole_orders(spark, sf_dir))[1]
    return found.select("doc_id", "section_number", "title", "content", F.array_join(F.transform("subsections", lambda i: i["path"]), "|").alias("items"))


QUERIES = {f.__name__: f for f in (
    statute_records, statute_notes, order_records, order_parts, effective_date, parse_dates, order_numbers, related_laws, topic_tags, clean_text, repair_sequences, page_quality, capital_lines, running_lines, without_running_lines,
    split_sections, dedupe_sections, signed_dates, statute_scan, nested_items, article_references, footnote_amendments,
)}

_CLAUSES = "SELECT o_orderkey AS doc_id, o_orderkey % 9 AS kind, CAST(o_orderkey % 89 + 1 AS INT) AS n, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS p, CAST(o_orderdate AS DATE) AS d FROM orders"
_TAG_SQL = ", ".join(
    "CASE WHEN len(regexp_extract_all(content, '(?i)\\b(?:{p})\\b')) >= 3 OR coalesce(regexp_matches(title, '(?i)\\b(?:{p})\\b'), false) THEN '{t}' END".format(p=p, t=t) for t, p in refs.TAGS
)
_REPAIRED = "{c}"
for _bad, _good in text.GARBLED:
    _REPAIRED = f"replace({_REPAIRED}, '{_bad}', '{_good}')"
_SQUEEZED = r"trim(regexp_replace({c}, '[\s\x{{85}}\x{{A0}}\x{{2028}}\x{{2029}}\x{{3000}}]+', ' ', 'g'))"
_RUNNING = rf"""
    WITH l AS (
      SELECT order_number, scan_no, page_id, list_filter(list_transform(string_split(raw_text, chr(10)), lambda x: {_SQUEEZED.format(c='x')}), lambda x: x <> '' AND strlen(x) <= 100) AS ls FROM scan_pages
    ), e AS (SELECT DISTINCT order_number, scan_no, page_id, unnest(list_concat(ls[1:2], ls[greatest(len(ls) - 1, 1):len(ls)])) AS line FROM l),
    t AS (SELECT order_number, scan_no, count(*) AS n_pages FROM scan_pages GROUP BY 1, 2),
    r AS (SELECT order_number, scan_no, line, count(*) AS n FROM e GROUP BY 1, 2, 3)"""

_WHOLE = "SELECT o_orderkey AS k, o_custkey, CAST(o_orderkey % 89 + 1 AS INT) AS n, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) + 10 END AS p FROM orders"
_PRINTED_NUMBER = "(k % 900 + 1) || CASE WHEN k % 4 = 0 THEN '-' || ['A', 'B', 'C'][k % 3 + 1] ELSE '' END || '-' || right(CAST(year(d) AS VARCHAR), 2)"
_ORDER_NUMBER = f"'DO-' || {_PRINTED_NUMBER}"
_OLD = "('DO-' || (k % 50 + 1) || '-' || lpad(CAST(k % 20 AS VARCHAR), 2, '0'))"
_COVER = (
    f"'Republic' || chr(10) || chr(10) || 'DEPARTMENT ORDER NO. ' || {_PRINTED_NUMBER} || chr(10) || 'Series of ' || year(d) || chr(10) || chr(10) || 'RULES ON THE LOADING OF' || chr(10) || 'LOT ' || o_custkey || chr(10) || chr(10)"
    " || 'Pursuant to R.A. No. ' || (k % 9000 + 1000) || ' and Presidential Decree No. ' || (k % 899 + 1) || ', as amended by B.P. Blg. 7, these rules on wages are issued.' || chr(10) || chr(10)"
)

ORACLE = {
    "effective_date": f"""
        SELECT doc_id, CAST(CASE kind WHEN 0 THEN p + n WHEN 1 THEN p + 15 WHEN 2 THEN d - 7 WHEN 3 THEN d + n WHEN 5 THEN p WHEN 6 THEN d - 7 + 60 END AS DATE) AS effective_date,
          CAST(CASE kind WHEN 0 THEN n WHEN 1 THEN 15 WHEN 6 THEN 60 WHEN 7 THEN 30 END AS INT) AS offset_days FROM ({_CLAUSES})""",
    "parse_dates": "SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS found FROM orders",
    "order_numbers": """
        SELECT o_orderkey AS doc_id, 'DO-' || (o_orderkey % 999 + 1) || CASE WHEN o_orderkey % 4 = 0 THEN '-A' ELSE '' END || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS order_number FROM orders""",
    "related_laws": r"""
        SELECT rec_id, array_to_string(list_transform(list_filter(list_transform(l, lambda x, i: CASE WHEN list_position(l, x) = i THEN x END), lambda x: x IS NOT NULL), lambda x: x), '|') AS laws FROM (
          SELECT rec_id, list_concat(
            list_transform(regexp_extract_all(content, '(?i)\b(?:republic\s+act|r\.?\s*a\.?)\s*(?:no\.?\s*)?([0-9]{3,5})\b', 1), lambda n: 'RA ' || n),
            list_transform(regexp_extract_all(content, '(?i)\b(?:presidential\s+decree|p\.?\s*d\.?)\s*(?:no\.?\s*)?([0-9]{1,4})\b', 1), lambda n: 'PD ' || n),
            CASE WHEN contains(lower(content), 'labor code') THEN ['PD 442 (Labor Code)'] ELSE [] END) AS l FROM order_sections)""",
    "topic_tags": f"SELECT rec_id, array_to_string(list_filter([{_TAG_SQL}], lambda t: t IS NOT NULL), '|') AS tags FROM order_sections",
    "repair_sequences": f"SELECT rec_id, {_REPAIRED.format(c='title')} AS title FROM dole_orders",
    "page_quality": r"""
        SELECT page_id, CASE WHEN n = 0 THEN 'empty_page' WHEN n < 50 THEN 'low_char_count' END AS warning
        FROM (SELECT page_id, length(regexp_replace(regexp_replace(raw_text, '^[\s\x{85}\x{A0}\x{2028}\x{2029}\x{3000}]+', ''), '[\s\x{85}\x{A0}\x{2028}\x{2029}\x{3000}]+$', '')) AS n FROM scan_pages)""",
    "running_lines": _RUNNING + " SELECT r.order_number, r.scan_no, line, n FROM r JOIN t ON r.order_number IS NOT DISTINCT FROM t.order_number AND r.scan_no = t.scan_no WHERE n >= 3 AND n * 2 >= n_pages",
    "split_sections": """
        SELECT l_orderkey AS doc_id, count(*) AS n_blocks, count(DISTINCT l_linenumber) AS n_labels, min('Lot ' || l_suppkey) AS first_title FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
    "dedupe_sections": """
        WITH x AS (
          SELECT l_orderkey AS doc_id, l_linenumber AS n, l_suppkey AS s, length('The employer shall keep lot ' || l_partkey) + 5 * CAST(l_quantity AS INT) AS size,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS ord
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        ), last AS (SELECT doc_id, max(ord) AS last FROM x GROUP BY 1),
        y AS (
          SELECT x.*, row_number() OVER (PARTITION BY x.doc_id, n ORDER BY size + CASE WHEN ord = last THEN tail ELSE 0 END DESC, ord) AS k
          FROM x JOIN last USING (doc_id) JOIN (SELECT o_orderkey AS doc_id, length('xxDone in the City, this ' || day(o_orderdate) || 'th day of ' || monthname(o_orderdate) || ', 2000.') AS tail FROM orders) USING (doc_id)
        )
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Rule I, ' ELSE '' END || 'Section ' || n AS section_number, 'Lot ' || s AS title FROM y WHERE k = 1""",
    "signed_dates": "SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS signed_date FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
    "statute_scan": """
        WITH x AS (SELECT *, c_mktsegment || '-' || (c_custkey // 50) AS doc FROM customer JOIN nation ON c_nationkey = n_nationkey),
        h AS (
          SELECT *, (SELECT max(m.n_nationkey) FROM x m WHERE m.doc = x.doc AND m.n_regionkey = x.n_regionkey AND m.n_nationkey <= x.n_nationkey AND m.n_nationkey % 2 = 0) AS t FROM x
        )
        SELECT doc AS doc_id, CAST(c_custkey % 999 + 1 AS INT) AS article_number, CAST(c_custkey % 500 + 1 AS INT) AS former_article_number,
          ['Book I: Pre-Employment', 'Book II: Human Resources Development', 'Book III: Conditions of Employment', 'Book IV: Health, Safety and Social Welfare Benefits', 'Book V: Labor Relations'][n_regionkey + 1] AS book,
          CASE WHEN t IS NULL THEN 'General Provisions' ELSE 'Title ' || (t + 1) || ': ' || (SELECT n_name FROM nation WHERE n_nationkey = t) END AS title_name,
          CASE WHEN n_nationkey % 2 = 1 THEN 'Chapter ' || (n_nationkey + 1) || ': ' || n_name END AS chapter FROM h""",
    "article_references": """
        SELECT rec_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(range(article_number + 1, article_number + 2 + rec_id % 5), [7, 3]), lambda x: x <> article_number))), ',') AS related FROM code_articles""",
    "footnote_amendments": r"""
        SELECT rec_id, f.note_number AS note_number, 'RA ' || regexp_extract(f.note_text, '^As amended by RA ([0-9]+)', 1) AS laws,
          CAST(try_strptime(regexp_extract(f.note_text, '^As amended by RA [0-9]+, ([A-Za-z]+ [0-9]+, [0-9]{4})', 1), '%B %-d, %Y') AS DATE) AS law_date
        FROM (SELECT rec_id, unnest(metadata.footnotes) AS f FROM code_articles) WHERE f.note_text LIKE 'As amended by RA %'""",
    "statute_notes": """
        SELECT c_custkey // 40 AS doc_id, CAST(c_custkey % 40 + 2 AS INT) AS note_number,
          'As ' || CASE WHEN c_custkey % 3 = 0 THEN 'inserted' ELSE 'amended' END || ' by R.A. No. ' || (c_custkey % 9000 + 1000) || ', March 1, 2001. See D.O. No. 05, Series of 2003.' AS note_text FROM customer
        UNION ALL SELECT DISTINCT c_custkey // 40, 1, 'Of the title.' FROM customer""",
    "statute_records": """
        SELECT c_custkey // 40 AS doc_id, CAST(c_custkey % 40 + 1 AS INT) AS article_number, CAST(c_custkey % 500 + 1 AS INT) AS former_article_number, 'Title II: WORK.' AS title_name,
          'Duty of ' || c_custkey AS heading, 'The employer shall pay under Article 99.' AS content, c_custkey % 3 <> 0 AS original, '99' AS related, 'DO-5-03' AS orders,
          CAST(c_custkey % 40 + 2 AS VARCHAR) AS notes, 'Title II: WORK.=Of the title.' AS heading_notes, 'RA ' || (c_custkey % 9000 + 1000) || '@2001-03-01' AS amendments FROM customer""",
    "order_records": f"""
        SELECT k AS doc_id, {_ORDER_NUMBER} AS order_number, 'RULES ON THE LOADING OF LOT ' || o_custkey AS title, 'ANA B. REYES, Secretary of Lot ' || o_custkey AS issuing_authority, d AS signed_date,
          p AS published_date, CAST(CASE WHEN k % 10 = 9 THEN d ELSE p + n END AS DATE) AS effective_date,
          CASE WHEN k % 10 = 9 THEN 'This Order shall take effect immediately upon signing.' ELSE 'Under Sec. 5 of the Code, this Order shall take effect ' || n || ' days after its publication.' END AS effectivity_clause,
          CASE WHEN k % 10 = 9 OR {_OLD} = {_ORDER_NUMBER} THEN '' ELSE {_OLD} END AS supersedes, 'RA ' || (k % 9000 + 1000) || '|PD ' || (k % 899 + 1) AS related_laws, CASE WHEN k % 10 = 9 THEN '' ELSE 'wages' END AS tags
        FROM ({_WHOLE})""",
    "order_parts": f"""
        SELECT k AS doc_id, 'Section 1' AS section_number, 'Coverage' AS title, 'It covers minimum wages, wages and more wages.' || chr(10) || '(a) first ' || k || chr(10) || '(1) one' || chr(10) || '(2) two' || chr(10) || '(b) second' AS content, 'a|a/1|a/2|b' AS items
        FROM ({_WHOLE}) WHERE k % 10 <> 9
        UNION ALL SELECT k, 'Section 2', 'Repeal', 'Department Order No. ' || (k % 50 + 1) || ', Series of ' || (k % 20 + 2000) || ' is hereby superseded.' || chr(10) || 'The board keeps D.O. No. 77-99 as amended.', '' FROM ({_WHOLE}) WHERE k % 10 <> 9
        UNION ALL SELECT k, 'Section 3', 'Effectivity', 'Under Sec. 5 of the Code, this Order shall take effect ' || n || ' days after its publication.', '' FROM ({_WHOLE}) WHERE k % 10 <> 9
        UNION ALL SELECT k, 'Full Text', NULL, {_COVER} || 'Nothing is listed here. This Order shall take effect immediately upon signing.' || chr(10) || chr(10), '' FROM ({_WHOLE}) WHERE k % 10 = 9""",
    "clean_text": rf"""
        WITH a AS (SELECT rec_id, regexp_replace({_REPAIRED.format(c="regexp_replace(content, '" + chr(92) + "r" + chr(92) + "n?', chr(10), 'g')")}, '[\x00-\x08\x0b-\x1f\x7f-\x{{9f}}]', '', 'g') AS t FROM order_sections),
        l AS (SELECT rec_id, string_split(t, chr(10)) AS ls FROM a),
        b AS (SELECT rec_id, list_transform(ls, lambda x: trim(regexp_replace(x, '^[ \t]+|[ \t]+$', '', 'g'))) AS bs, ls FROM l),
        k AS (
          SELECT rec_id, array_to_string(list_filter(ls, lambda x, i:
            NOT regexp_full_match(lower(regexp_replace(translate(bs[i], '–—', '--'), '[ \t]+', '', 'g')), 'page[0-9]{{1,3}}(of[0-9]{{1,3}})?|-[0-9]{{1,3}}-|[0-9]{{1,3}}/[0-9]{{1,3}}')
            AND NOT (regexp_full_match(bs[i], '[0-9]{{1,3}}') AND coalesce(CASE WHEN i > 1 THEN bs[i - 1] END, '') = '' AND coalesce(bs[i + 1], '') = '')), chr(10)) AS t FROM b),
        d AS (SELECT rec_id, regexp_replace(t, '(?m)^[^\n]*?\.[ \t]?\.[ \t]?\.[ \t]?\.[ \t]*[0-9]{{1,3}}[ \t]*$\n?', '', 'g') AS t FROM k),
        h AS (SELECT rec_id, regexp_replace(regexp_replace(regexp_replace(t, '([a-zà-öø-ÿ])-\n[ \t]*([a-zà-öø-ÿ])', '\1\2', 'g'), '(?m)[ \t]+$', '', 'g'), '([^\s])[ \t]{{2,}}', '\1 ', 'g') AS t FROM d)
        SELECT rec_id, md5(regexp_replace(regexp_replace(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\s\x{{85}}\x{{A0}}\x{{2028}}\x{{2029}}\x{{3000}}]+', ''), '[\s\x{{85}}\x{{A0}}\x{{2028}}\x{{2029}}\x{{3000}}]+$', '')) AS digest FROM h""",
    "capital_lines": r"""
        WITH l AS (SELECT page_id, unnest(string_split(raw_text, chr(10))) AS line FROM scan_pages),
        c AS (SELECT page_id, line, len(regexp_extract_all(line, '\p{Lu}')) AS u, len(regexp_extract_all(line, '\p{L}')) AS a FROM l)
        SELECT page_id, sum(CAST(a > 0 AND u * 10 >= a * 7 AS INT)) AS n_mostly, sum(CAST(strlen(line) <= 80 AND a > 0 AND u * 10 >= a * 8 AS INT)) AS n_heading FROM c GROUP BY 1""",
    "without_running_lines": _RUNNING + rf"""
        , known AS (SELECT r.order_number, r.scan_no, list(line) AS running FROM r JOIN t ON r.order_number IS NOT DISTINCT FROM t.order_number AND r.scan_no = t.scan_no WHERE n >= 3 AND n * 2 >= n_pages GROUP BY 1, 2),
        p AS (
          SELECT s.page_id, s.order_number, s.scan_no, s.page_no = min(s.page_no) OVER (PARTITION BY s.order_number, s.scan_no) AS is_first, string_split(raw_text, chr(10)) AS ls,
            list_transform(string_split(raw_text, chr(10)), lambda x: {_SQUEEZED.format(c='x')}) AS names FROM scan_pages s)
        SELECT page_id, md5(array_to_string(list_filter(ls, lambda x, i: running IS NULL OR NOT list_contains(running, names[i]) OR (is_first AND NOT list_contains(names[1:i - 1], names[i]))), chr(10))) AS digest
        FROM p LEFT JOIN known k ON k.order_number IS NOT DISTINCT FROM p.order_number AND k.scan_no = p.scan_no""",
}
