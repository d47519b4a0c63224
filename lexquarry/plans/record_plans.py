"""Queries of the status, manifest, cross-link and schema-rule operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexquarry.functions.keys import order_key
from lexquarry.functions.text import upper_median
from lexquarry.operators import manifest, nested, orders, rules, status
from lexquarry.operators.blocks import lines_of
from lexquarry.plans.linked import P4_SQL, _key_sql
from lexquarry.session import table


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of articles from the part keys: overlapping, some without a part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("file_ord"), (F.col("p_partkey") % 380 + 1).cast("int").alias("first"), (F.col("p_partkey") % 380 + 1 + F.col("p_size") % 9).cast("int").alias("last"),
        F.col("p_size").alias("footnote"), F.lit("modified").alias("effect"), F.col("p_brand").alias("by"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("part"),
    )


def status_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article and every reviewed change whose range holds it."""
    a = table(spark, sf_dir, "code_articles").select("rec_id", "article_number")
    return a.join(status.spread(_changes(spark, sf_dir)), "article_number").select("rec_id", "article_number", "file_ord", "footnote")


def status_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of every article number."""
    a = table(spark, sf_dir, "code_articles").select("article_number").distinct()
    r = status.roll_up(a, _changes(spark, sf_dir))
    return r.select("article_number", "status", F.coalesce(F.size("changes"), F.lit(0)).alias("n_changes"))


def resolved_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes with the text of the footnote they name; names of missing notes vanish."""
    a = table(spark, sf_dir, "code_articles")
    refs = a.select("rec_id", F.posexplode("metadata.legal_status.changes").alias("seq", "c"))
    notes = a.select("rec_id", F.explode("metadata.footnotes").alias("f"))
    return refs.join(notes, (refs.rec_id == notes.rec_id) & (F.col("c.footnote") == F.col("f.note_number"))).select(refs.rec_id, "seq", F.col("c.effect").alias("effect"), F.col("f.note_text").alias("note_text"))


def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of the source manifest."""
    return manifest.problems(table(spark, sf_dir, "sources"))


def manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the hash of each delivered order compares with the manifest's."""
    docs = table(spark, sf_dir, "dole_orders").select("rec_id", F.col("order_number").alias("id"), F.col("provenance.source_sha256").alias("sha256"))
    return manifest.verified(docs, table(spark, sf_dir, "sources")).select("rec_id", "id", "outcome")


def manifest_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest with missing hashes filled from the delivered orders."""
    found = table(spark, sf_dir, "dole_orders").groupBy(F.col("order_number").alias("id")).agg(F.max("provenance.source_sha256").alias("found"))
    return manifest.pinned(table(spark, sf_dir, "sources"), found).select("rec_id", "id", "sha256")


def text_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content hashes of all sections, and how many sections share them."""
    s = table(spark, sf_dir, "order_sections").select(F.sha2("content", 256).alias("sha256"))
    return s.groupBy("sha256").agg(F.count("*").alias("n"))


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles and the orders that implement them, by order number."""
    a = table(spark, sf_dir, "code_articles").select("rec_id", F.explode("metadata.implementing_orders").alias("printed")).select("rec_id", order_key(F.col("printed")).alias("order_key")).where("order_key IS NOT NULL").distinct()
    o = table(spark, sf_dir, "dole_orders").groupBy(order_key(F.col("order_number")).alias("order_key")).agg(F.count("*").alias("n_deliveries"))
    return a.join(o, "order_key").select("rec_id", "order_key", "n_deliveries")


def superseded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supersession edges between orders, first mention of each, by the latest delivery of an order."""
    o = table(spark, sf_dir, "dole_orders").select(order_key(F.col("order_number")).alias("order_key"), F.explode("metadata.supersedes").alias("printed"))
    return o.select("order_key", order_key(F.col("printed")).alias("superseded")).where("superseded IS NOT NULL AND superseded <> order_key").groupBy("order_key", "superseded").agg(F.count("*").alias("n"))


def line_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper median width of the lines of each scan that say something about its type size."""
    line = lines_of(table(spark, sf_dir, "scan_pages").select("order_number", "scan_no", "raw_text"), "raw_text")
    widths = line.select("order_number", "scan_no", F.char_length(F.trim("line")).alias("n")).where("n >= 20")
    return widths.groupBy("order_number", "scan_no").agg(upper_median(F.collect_list("n")).alias("width"))


#: The order schema of the test records, in the validator's own terms.
ORDER_SCHEMA = {
    "type": "object", "required": ["order_number", "title", "sections", "metadata"],
    "properties": {
        "order_number": {"type": "string", "pattern": "^DO-[0-9]+(-[A-Z])?-[0-9]{2}$"}, "title": {"type": "string"}, "source_url": {"type": "string", "format": "uri"},
        "sections": {"type": "array", "items": {"$ref": "#/definitions/section"}}, "metadata": {"type": "object"},
    },
    "definitions": {"section": {"type": "object", "required": ["section_number", "content"], "properties": {"section_number": {"type": "string"}, "content": {"type": "string"}}}},
}


def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of the order schema in the delivered records."""
    recs = nested.records(table(spark, sf_dir, "raw_records"))
    return rules.errors(recs.where(rules.schema_kind(F.col("record")) == "order"), ORDER_SCHEMA, ["record_id", "record_path"])


def schema_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each violation of the order schema occurs."""
    return rules.counts(schema_errors(spark, sf_dir))


def manifest_problem_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many entries of the manifest break each rule."""
    return rules.counts(manifest_problems(spark, sf_dir), "problem")


def manifest_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest entry that pins the hash of each delivered order."""
    docs = table(spark, sf_dir, "dole_orders").select("rec_id", F.col("provenance.source_sha256").alias("sha256"))
    return manifest.by_hash(docs, table(spark, sf_dir, "sources")).select("rec_id", "entry_id", "entry_kind")


def identity_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered orders whose entry in the manifest, by id, is of another kind, and those without a title or number."""
    entries = table(spark, sf_dir, "sources").groupBy(order_key(F.col("id")).alias("order_key")).agg(F.min(F.struct("kind", "id")).alias("e"))
    docs = table(spark, sf_dir, "dole_orders").select(F.col("rec_id").alias("doc_id"), F.col("title").alias("text"), "order_number", order_key(F.col("order_number")).alias("order_key"))
    joined = docs.join(entries, "order_key", "left").select("doc_id", "text", "order_number", F.col("e.id").alias("entry_id"), F.col("e.kind").alias("entry_kind"))
    return orders.problems(joined)


def status_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of the articles of one reviewed file; those of other files have none."""
    a = table(spark, sf_dir, "code_articles").select("article_number", F.col("provenance.source_sha256").alias("sha256"))
    reviewed = a.agg(F.min("sha256").alias("s")).first().s
    return status.applied(a, _changes(spark, sf_dir), reviewed or "").select("article_number", "sha256", "status", F.coalesce(F.size("changes"), F.lit(0)).alias("n_changes"))


def status_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that does not fit between reviewed changes, footnotes and articles."""
    a = table(spark, sf_dir, "code_articles")
    notes = a.select("article_number", F.explode("metadata.footnotes").alias("f")).select("article_number", F.col("f.note_number").alias("footnote"), F.col("f.note_text").alias("note_text"))
    free = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 400).cast("int").alias("footnote"), F.col("s_name").alias("reason")).distinct()
    return status.problems(a, notes, _changes(spark, sf_dir), free)


def supersession_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order that an order replaces, directly or through others."""
    return orders.supersession(superseded_orders(spark, sf_dir)).select("order_key", "superseded")


QUERIES = {f.__name__: f for f in (
    status_interval_join, status_roll_up, resolved_notes, manifest_problems, manifest_lookup, manifest_pins, text_hashes, order_links, superseded_orders, line_widths, schema_errors,
    schema_error_counts, manifest_problem_counts, manifest_by_hash, identity_problems, status_applied, status_problems, supersession_chain,
)}

_CHANGES_SQL = "SELECT CAST(p_partkey AS INT) AS file_ord, p_partkey % 380 + 1 AS first, p_partkey % 380 + 1 + p_size % 9 AS last, p_size AS footnote, p_partkey % 3 > 0 AS has_part FROM part"
ORACLE = {
    "status_interval_join": f"SELECT rec_id, article_number, file_ord, footnote FROM code_articles JOIN ({_CHANGES_SQL}) ON article_number BETWEEN first AND last",
    "status_roll_up": f"""
        SELECT a.article_number, CASE WHEN count(c.file_ord) = 0 THEN 'no_change_noted' WHEN bool_or(NOT has_part) THEN 'superseded' ELSE 'partly_superseded' END AS status, CAST(count(c.file_ord) AS INT) AS n_changes
        FROM (SELECT DISTINCT article_number FROM code_articles) a LEFT JOIN ({_CHANGES_SQL}) c ON a.article_number BETWEEN first AND last GROUP BY 1""",
    "resolved_notes": """
        WITH n AS (SELECT rec_id, unnest(metadata.footnotes) AS f FROM code_articles),
        c AS (SELECT rec_id, unnest(metadata.legal_status.changes) AS c, generate_subscripts(metadata.legal_status.changes, 1) - 1 AS seq FROM code_articles)
        SELECT c.rec_id, CAST(seq AS INT) AS seq, c.c.effect AS effect, f.note_text AS note_text FROM c JOIN n ON n.rec_id = c.rec_id AND f.note_number = c.c.footnote""",
    "manifest_problems": r"""
        SELECT DISTINCT id, problem FROM (
          SELECT id, unnest(list_filter([
            CASE WHEN NOT regexp_matches(id, '^[A-Za-z0-9_-]+$') THEN 'bad_id' END,
            CASE WHEN kind = 'dole_order' AND NOT regexp_matches(id, '^DO-[0-9]+(-[A-Z])?-[0-9]{2}$') THEN 'bad_order_id' END,
            CASE WHEN NOT coalesce(regexp_matches(source_url, '^https?://'), false) THEN 'bad_source_url' END,
            CASE WHEN NOT regexp_matches(download_url, '^https?://') THEN 'bad_download_url' END,
            CASE WHEN published_date IS NOT NULL AND (NOT regexp_matches(published_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') OR try_strptime(published_date, '%Y-%m-%d') IS NULL) THEN 'bad_published_date' END,
            CASE WHEN NOT regexp_matches(superseded_by, '^DO-[0-9]+(-[A-Z])?-[0-9]{2}$') THEN 'bad_superseded_by' END,
            CASE WHEN ocr_first_page IS NOT NULL AND NOT coalesce(ocr, false) THEN 'first_page_without_ocr' END,
            CASE WHEN NOT regexp_matches(sha256, '^[0-9a-f]{64}$') THEN 'bad_hash' END], lambda x: x IS NOT NULL)) AS problem FROM sources
          UNION ALL SELECT id, 'duplicate_id' FROM sources GROUP BY id HAVING count(*) > 1
          UNION ALL SELECT min(id), 'duplicate_hash' FROM sources WHERE regexp_matches(sha256, '^[0-9a-f]{64}$') GROUP BY sha256 HAVING count(*) > 1)""",
    "manifest_lookup": """
        WITH p AS (SELECT id, max(sha256) AS pin FROM sources GROUP BY 1)
        SELECT rec_id, order_number AS id, CASE WHEN p.id IS NULL THEN 'unknown' WHEN pin IS NULL THEN 'unpinned' WHEN pin = provenance.source_sha256 THEN 'verified' ELSE 'mismatch' END AS outcome
        FROM dole_orders LEFT JOIN p ON p.id = order_number""",
    "manifest_pins": "SELECT rec_id, s.id, coalesce(s.sha256, f.found) AS sha256 FROM sources s LEFT JOIN (SELECT order_number AS id, max(provenance.source_sha256) AS found FROM dole_orders GROUP BY 1) f ON f.id = s.id",
    "text_hashes": "SELECT sha256(content) AS sha256, count(*) AS n FROM order_sections GROUP BY 1",
    "order_links": f"""
        WITH a AS (SELECT DISTINCT rec_id, {_key_sql('printed')} AS order_key FROM (SELECT rec_id, unnest(metadata.implementing_orders) AS printed FROM code_articles) WHERE printed IS NOT NULL),
        o AS (SELECT {_key_sql('order_number')} AS order_key, count(*) AS n_deliveries FROM dole_orders GROUP BY 1)
        SELECT rec_id, order_key, n_deliveries FROM a JOIN o USING (order_key) WHERE order_key IS NOT NULL""",
    "superseded_orders": f"""
        WITH x AS (SELECT {_key_sql('order_number')} AS order_key, {_key_sql('printed')} AS superseded FROM (SELECT order_number, unnest(metadata.supersedes) AS printed FROM dole_orders) WHERE printed IS NOT NULL)
        SELECT order_key, superseded, count(*) AS n FROM x WHERE superseded IS NOT NULL AND superseded <> order_key GROUP BY 1, 2""",
    "line_widths": r"""
        WITH l AS (SELECT order_number, scan_no, length(trim(line)) AS n FROM (SELECT order_number, scan_no, unnest(string_split(raw_text, chr(10))) AS line FROM scan_pages)),
        s AS (SELECT order_number, scan_no, list_sort(list(n)) AS ns FROM l WHERE n >= 20 GROUP BY 1, 2)
        SELECT order_number, scan_no, CAST(ns[CAST(floor(len(ns) / 2) AS INT) + 1] AS INT) AS width FROM s""",
    "manifest_by_hash": """
        WITH p AS (SELECT sha256, min(id) AS id FROM sources WHERE regexp_matches(sha256, '^[0-9a-f]{64}$') GROUP BY 1),
        e AS (SELECT p.sha256, p.id, min(s.kind) AS kind FROM p JOIN sources s ON s.sha256 = p.sha256 AND s.id = p.id GROUP BY 1, 2)
        SELECT rec_id, e.id AS entry_id, e.kind AS entry_kind FROM dole_orders o LEFT JOIN e ON e.sha256 = o.provenance.source_sha256""",
    "identity_problems": f"""
        WITH e AS (SELECT order_key, arg_min(id, (kind, id)) AS id, min(kind) AS kind FROM (SELECT {_key_sql('id')} AS order_key, kind, id FROM sources) WHERE order_key IS NOT NULL AND kind IS NOT NULL GROUP BY 1),
        d AS (SELECT rec_id AS doc_id, trim(title) AS title, order_number, {_key_sql('order_number')} AS order_key FROM dole_orders)
        SELECT doc_id, unnest(list_filter([CASE WHEN coalesce(title, '') = '' THEN 'no_text' END, CASE WHEN order_number IS NULL THEN 'no_order_number' END,
          CASE WHEN e.kind <> 'dole_order' THEN 'entry_of_other_kind' END, CASE WHEN e.id <> order_number THEN 'entry_of_other_id' END], lambda x: x IS NOT NULL)) AS problem
        FROM d LEFT JOIN e USING (order_key)""",
    "status_applied": f"""
        WITH a AS (SELECT DISTINCT article_number, provenance.source_sha256 AS sha256 FROM code_articles), r AS (SELECT min(sha256) AS s FROM a)
        SELECT a.article_number, a.sha256,
          CASE WHEN any_value(r.s) IS DISTINCT FROM a.sha256 THEN NULL WHEN count(c.file_ord) = 0 THEN 'no_change_noted' WHEN bool_or(NOT has_part) THEN 'superseded' ELSE 'partly_superseded' END AS status,
          CAST(count(c.file_ord) AS INT) AS n_changes
        FROM a CROSS JOIN r LEFT JOIN ({_CHANGES_SQL}) c ON a.sha256 = r.s AND a.article_number BETWEEN first AND last GROUP BY 1, 2""",
    "status_problems": f"""
        WITH n AS (SELECT article_number, f.note_number AS footnote, f.note_text FROM (SELECT article_number, unnest(metadata.footnotes) AS f FROM code_articles)),
        c AS ({_CHANGES_SQL}), one AS (SELECT unnest(range(first, last + 1)) AS article_number, footnote FROM c),
        u AS (SELECT DISTINCT s_suppkey % 400 AS footnote FROM supplier), a AS (SELECT DISTINCT article_number FROM code_articles)
        SELECT DISTINCT kind, CAST(article_number AS INT) AS article_number, CAST(footnote AS INT) AS footnote FROM (
          SELECT 'no_such_article' AS kind, article_number, footnote FROM one WHERE article_number NOT IN (SELECT article_number FROM a)
          UNION ALL SELECT 'footnote_not_on_article', article_number, footnote FROM one WHERE article_number IN (SELECT article_number FROM a)
            AND NOT EXISTS (SELECT 1 FROM n WHERE n.article_number = one.article_number AND n.footnote = one.footnote)
          UNION ALL SELECT 'listed_twice', NULL, footnote FROM c WHERE footnote IN (SELECT footnote FROM u)
          UNION ALL SELECT 'never_seen', NULL, footnote FROM u WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.footnote = u.footnote)
          UNION ALL SELECT 'not_reviewed', article_number, footnote FROM n WHERE regexp_matches(note_text, '{status.STATUS_WORDS}')
            AND NOT EXISTS (SELECT 1 FROM c WHERE c.footnote = n.footnote) AND NOT EXISTS (SELECT 1 FROM u WHERE u.footnote = n.footnote))""",
}
ORACLE["manifest_problem_counts"] = f"SELECT problem AS kind, count(*) AS n FROM ({ORACLE['manifest_problems']}) GROUP BY 1"
ORACLE["supersession_chain"] = f"""
    WITH RECURSIVE e AS (SELECT order_key, superseded FROM ({ORACLE['superseded_orders']})),
    w AS (SELECT order_key, superseded FROM e UNION SELECT w.order_key, e.superseded FROM w JOIN e ON e.order_key = w.superseded)
    SELECT order_key, superseded FROM w WHERE order_key <> superseded"""
ORACLE["schema_errors"] = P4_SQL + f""", o AS (SELECT record_id, record_path, rec FROM recs WHERE (rec->'$.order_number') IS NOT NULL),
    s AS (SELECT record_id, record_path, unnest(CAST(rec->'$.sections' AS JSON[])) AS x FROM o WHERE json_type(rec->'$.sections') = 'ARRAY'),
    v AS (
      SELECT record_id, record_path, '$.' || f AS path, rec->('$.' || f) AS x, kind, f FROM o, (VALUES ('order_number', 'string'), ('title', 'string'), ('source_url', 'string'), ('sections', 'array'), ('metadata', 'object')) k(f, kind)
      UNION ALL SELECT record_id, record_path, '$.sections[].' || f, x->('$.' || f), 'string', f FROM s, (VALUES ('section_number'), ('content')) k(f) WHERE json_type(x) = 'OBJECT'
      UNION ALL SELECT record_id, record_path, '$.sections[]', x, 'object', '' FROM s
    )
    SELECT record_id, record_path, path, 'is not of type ' || kind AS message FROM v WHERE (x IS NOT NULL OR path = '$.sections[]') AND coalesce(json_type(x), 'NULL') <> CASE kind WHEN 'string' THEN 'VARCHAR' WHEN 'array' THEN 'ARRAY' ELSE 'OBJECT' END
    UNION ALL SELECT record_id, record_path, path, 'does not match its pattern' FROM v WHERE f = 'order_number' AND json_type(x) = 'VARCHAR' AND NOT regexp_matches(x->>'$', '^DO-[0-9]+(-[A-Z])?-[0-9]{{2}}$')
    UNION ALL SELECT record_id, record_path, path, 'is not a URI' FROM v WHERE f = 'source_url' AND json_type(x) = 'VARCHAR' AND NOT regexp_full_match(x->>'$', '[A-Za-z][A-Za-z0-9+.-]*:[^\\s]+')
    UNION ALL SELECT record_id, record_path, '$', 'lacks ' || f FROM o, (VALUES ('title'), ('sections'), ('metadata')) k(f) WHERE (rec->('$.' || f)) IS NULL
    UNION ALL SELECT record_id, record_path, '$.sections[]', 'lacks ' || f FROM s, (VALUES ('section_number'), ('content')) k(f) WHERE json_type(x) = 'OBJECT' AND (x->('$.' || f)) IS NULL"""
ORACLE["schema_error_counts"] = f"SELECT message AS kind, count(*) AS n FROM ({ORACLE['schema_errors']}) GROUP BY 1"
