"""Operators on small inputs made for them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import blocks, lists, manifest, orders, pages, rules, statute, status
from lexquarry.plans import corpus


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_running_lines(spark):
    rows = [(1, i, f"Official Gazette\n\nbody {i}\nmore {i}\nlast {i}\nPrinted  by X") for i in range(1, 5)] + [(2, 1, "A\nb"), (2, 2, "A\nb")]
    p = spark.createDataFrame(rows, "doc_id long, page_no int, content string")
    run = pages.running_lines(p, ["doc_id"])
    assert {(r.doc_id, r.line, r.n) for r in run.collect()} == {(1, "Official Gazette", 4), (1, "Printed by X", 4)}
    left = {(r.doc_id, r.page_no): r.content for r in pages.without_running_lines(p, run, ["doc_id"]).collect()}
    assert left[1, 1] == rows[0][2] and left[1, 2] == "\nbody 2\nmore 2\nlast 2" and left[2, 1] == "A\nb"


def test_pages(spark):
    df = pages.clean_pages(pages.split_pages(spark.createDataFrame([("a", "one\f\ftwo  x")], "doc_id string, value string")))
    assert [(r.page_no, r.content, r.warning) for r in df.orderBy("page_no").collect()] == [(1, "one", "low_char_count"), (2, "", "empty_page"), (3, "two x", "low_char_count")]


def test_blocks(spark):
    text = "Preamble\nSection 1. Coverage. — This applies.\nSection 3 of R.A. 1 governs.\nSEC. 2: Body text that goes on\nand on.\nRULE II\n\nSection 1. Title only.\nx"
    rows = blocks.blocks(docs(spark, text, "no marker", "", None)).orderBy("ord").collect()
    assert [(r.label, r.title, r.content, r.uppercase) for r in rows] == [
        ("Section 1", "Coverage", "This applies.\nSection 3 of R.A. 1 governs.", False), ("Section 2", None, "Body text that goes on\nand on.", True),
        ("Rule II", None, "", True), ("Section 1", "Title only", "x", False),
    ]
    got = blocks.blocks(docs(spark, "A. COVERAGE\ntext\nB. Workers shall\nC. LEAVE\n")).orderBy("ord").collect()
    assert [(r.label, r.title, r.content) for r in got] == [("Section A", "COVERAGE", "text\nB. Workers shall"), ("Section C", "LEAVE", "")]


def test_sections(spark):
    text = "Section 1. Coverage.\nRule I\nSection 1. a\nlonger body\nSection 1. b\nSection 2. c\nSECTION 2. closing\nSECTION 3. end"
    rows = blocks.sections(docs(spark, text)).orderBy("ord").collect()
    assert [(r.section_number, r.content) for r in rows] == [
        ("Section 1", ""), ("Rule I", ""), ("Rule I, Section 1", "a\nlonger body"), ("Rule I, Section 2", "c"), ("Section 2", "closing"), ("Section 3", "end"),
    ]


@pytest.mark.parametrize("text,want", [
    ("intro\n(a) one\n(1) x\n(2) y\n(b) two\n(1) z", ["a", "a/1", "a/2", "b", "b/1"]), ("(a) only", []), ("(h) x\n(i) y\n(j) z", ["h", "i", "j"]), ("(i) x\n(ii) y", ["i", "ii"]),
    ("(a) x\n(i) y\n(ii) z\n(b) w", ["a", "a/i", "a/ii", "b"]), ("1. x\na) y\n\nb) z\n2. w", ["1", "1/a", "1/b", "2"]), ("2021. no\n2022. no", []), ("(a)  \n(b) x\n(c) y", ["b", "c"]), (None, []), ("", []),
])
def test_lists(text, want):
    assert [i["path"] for i in lists.items(text)] == want


def of(spark, column, *values):
    names = [f"v{i}" for i in range(len(values))]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names)).select(column(*map(F.col, names)).alias("r")).first().r


def test_order_parts(spark):
    text = "Body.\n\nIssued in accordance with Section 5." + " More." * 60 + "\n\nDone in the City, this 16th day of March, 2017.\n\nJUAN CRUZ\nSecretary"
    assert of(spark, orders.signed_date_of, text) == dt.date(2017, 3, 16)
    body, block = of(spark, orders.signature_parts, text)
    assert body + block == text and block.startswith("Done in")
    assert of(spark, orders.signature_parts, "Done today.")["block"] == "" and of(spark, orders.signed_date_of, "") is None
    early = "Done this 5 May 2001.\n" + "x" * 3100 + "\n  Signed\non 6 May 2001"
    assert of(spark, orders.signature_parts, early)["block"] == "  Signed\non 6 May 2001" and of(spark, orders.signature_parts, None)["body"] is None
    superseded = lambda t: of(spark, lambda c: orders.superseded_of(c, F.lit(None).cast("string")), t)
    assert superseded("D.O. No. 18-A, Series of 2011 is hereby superseded; D.O. No. 5-99 as amended is cited.\n\nD.O. No. 7-01 stays.") == ["DO-5-99", "DO-18-A-11"]  # dashed forms first
    assert superseded("Rules as amended by D.O. No. 9-02.") == [] and superseded("") == []
    assert superseded("D.O. No. 9-02 " + "far " * 60 + "is repealed") == [] and superseded("This amends D.O. No. 9-02 and repeals D.O. No. 8-01") == ["DO-9-02", "DO-8-01"]
    clause = lambda titled, t: of(spark, orders.effectivity_clause_of, titled, t)
    assert clause(None, "It takes effect never. These Rules, under Department Order No. 5, shall take effect\nnow.\n\nEnd.") == "These Rules, under Department Order No. 5, shall take effect now."
    assert clause("nothing", "shall take effect now.") is None and clause(None, "— Shall take effect now") == "Shall take effect now"
    assert of(spark, orders.first_sentence_of, "As amended by Sec. 3, R.A. No. 10151. See also R.A. No. 2.") == "As amended by Sec. 3, R.A. No. 10151."
    assert of(spark, orders.first_sentence_of, "no stop") == "no stop"


def test_order_problems(spark):
    df = spark.createDataFrame([(1, "x", "DO-1-01", "DO-1-01", "dole_order"), (2, " ", None, None, None), (3, "x", "DO-1-01", "DO-2-01", "labor_code")], "doc_id long, text string, order_number string, entry_id string, entry_kind string")
    assert {tuple(r) for r in orders.problems(df).collect()} == {(2, "no_text"), (2, "no_order_number"), (3, "entry_of_other_kind"), (3, "entry_of_other_id")}


def test_supersession(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "x"), ("a", "b")], "order_key string, superseded string")
    got = {tuple(r) for r in orders.supersession(edges).collect()}
    assert got == {("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "c", 1), ("b", "d", 2), ("c", "d", 1), ("c", "b", 2), ("d", "b", 1), ("d", "c", 2)}
    assert orders.supersession(edges.limit(0)).count() == 0


def test_order_records(spark):
    text = (
        "Republic\nDEPARTMENT ORDER NO. 202\nSeries of 2019\n\nRULES ON\nREMOTE WORK\nPursuant to R.A. No. 11165:\nSection 1. Scope. — All. Telecommuting.\n"
        "Section 2. Effectivity. — This shall take effect ten (10) days after publication.\n\nDone this 26 March 2019.\n\nANA B. REYES\nSecretary of Labor"
    )
    df = spark.createDataFrame([(1, "DO-202-19", text, dt.date(2019, 4, 1)), (2, "DO-9-01", "plain", None)], "doc_id long, file_name string, text string, published date")
    found, parts = orders.order_records(df)
    r = found.where("doc_id = 1").first()
    assert (r.order_number, r.title, r.issuing_authority, r.signed_date, r.effective_date) == ("DO-202-19", "RULES ON REMOTE WORK", "ANA B. REYES, Secretary of Labor", dt.date(2019, 3, 26), dt.date(2019, 4, 11))
    assert r.related_laws == ["RA 11165"] and r.supersedes == []
    other = found.where("doc_id = 2").first()
    assert (other.title, other.issuing_authority) == ("Department Order 9-01", orders.DEFAULT_AUTHORITY)
    assert [(x.doc_id, x.section_number) for x in parts.orderBy("doc_id", "ord").collect()] == [(1, "Section 1"), (1, "Section 2"), (2, "Full Text")]


def test_orders_are_dealt(spark, tmp_path):
    """A file of one row group is one task's work however many splits it has."""
    rows = spark.range(400).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("2001-02-03").cast("timestamp").alias("o_orderdate"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = orders.order_records(corpus.whole_orders(spark, str(tmp_path)))[0]
    assert found.count() == 400 and found.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism


def test_cut_characters(spark):
    """Reaches are in bytes; one that ends inside a character reads what stands before it."""
    assert of(spark, orders.signed_date_of, "Signed 6 May 2001 " + "é" * 200) == dt.date(2001, 5, 6)
    assert of(spark, lambda c: orders.tail_bytes(c, 3), "aéé") == "\ufffdé" and of(spark, lambda c: orders.head_bytes(c, 2), "aé") == "a\ufffd"


def test_statute(spark):
    text = "\n".join([
        "BOOK ONE – PRE 5", "PRELIMINARY TITLE", "Art. 1. Name — First.", "BOOK ONE", "PRE-EMPLOYMENT", "Art. 2. [9] Two", "TITLE I – WORK", "OF MINORS", "Chapter I", "RULES", "Art. 3. Three",
        "Article 4 of this Code applies.", "legislation. Chapter II – NIGHT WORK", "ART. 4: Four", "Book Two", "Art. 5. Five", "Title to the land", "Art. 3. x",
    ])
    rows = statute.deduped(statute.articles(docs(spark, text))).orderBy("ord").collect()
    assert [(r.article_number, r.former_article_number, r.book[:6], r.title_name, r.chapter) for r in rows] == [
        (1, None, "Prelim", "Preliminary Title", None), (2, 9, "Book I", "General Provisions", None), (3, None, "Book I", "Title I: WORK OF MINORS", "Chapter I: RULES"),
        (4, None, "Book I", "Title I: WORK OF MINORS", "Chapter II: NIGHT WORK"), (5, None, "Book I", "General Provisions", None),
    ]
    assert rows[2].body == "Article 4 of this Code applies.\nlegislation." and rows[4].body == "Title to the land"


def test_footnotes(spark):
    wide = "As amended by a very long citation that is set in a smaller type and runs on " * 2
    p1 = "\n".join(["The law was passed.1 It", "binds all the workers.2", "fifteen body words here", "1 As amended.", "2 " + wide, wide])
    p2 = "\n".join([wide, wide, "", "body text of the second page.5", "goes on for a while here", "5 See also this.", "99 Not next"])
    df = spark.createDataFrame([(7, 2, p2), (7, 1, p1)], "doc_id long, page_no int, content string")
    rows = statute.footnotes(df).collect()
    notes = {r.note_number: r.note_text for r in rows if r.note_number}
    assert set(notes) == {1, 2, 5} and notes[1] == "As amended." and notes[5] == "See also this. 99 Not next" and notes[2].count("As amended by a very") == 4
    text = next(r.text for r in rows if r.note_number is None)
    ref = statute.OPEN + "{}" + statute.CLOSE
    assert f"passed.{ref.format(1)} It" in text and f"workers.{ref.format(2)}" in text and f"page.{ref.format(5)}" in text


def test_notes_over_whole_pages(spark):
    wide = "A very long line of a note that runs on over the pages of a document " * 2
    narrow = "body words that are set as usual here"
    pages_ = [(1, f"{narrow}.1" + f"\n{narrow}" * 9 + f"\n1 {wide}\n{wide}"), (2, f"{wide}\n{wide}"), (3, f"{wide}\n{wide}\n\n{narrow}\n{narrow}"), (4, f"{wide}\n{wide}")]
    df = spark.createDataFrame([(1, p, t) for p, t in pages_] + [(2, 1, ""), (3, 1, "only 4 words.1\n\n1 A note")], "doc_id long, page_no int, content string")
    rows = statute.footnotes(df).collect()
    notes = {(r.doc_id, r.note_number): r.note_text for r in rows if r.note_number}
    assert set(notes) == {(1, 1), (3, 1)} and notes[1, 1].count("A very long") == 8 and notes[3, 1] == "A note"
    texts = {r.doc_id: r.text for r in rows if r.note_number is None}
    assert texts[1].count("A very long") == 8 and texts[2] == "" and texts[3].startswith("only 4 words." + statute.OPEN)
    assert statute.footnotes(df.limit(0)).count() == 0


def test_amendments(spark):
    df = spark.createDataFrame([("Pay. (As amended by Section 3, R.A. No. 6715, March 21, 1989) (As inserted by R.A. 1 and P.D. 2)", ["As amended by R.A. 6715.", "As added by R.A. No. 99, May 2, 2001.", "See R.A. 5."])], "content string, notes array<string>")
    got = [(a.law, a.law_date) for a in statute.amendments(df, "content", "notes").first().amendments]
    assert got == [("RA 6715", dt.date(1989, 3, 21)), ("RA 1", None), ("PD 2", None), ("RA 99", dt.date(2001, 5, 2))]


def test_article_records(spark):
    p1 = "\n".join(["BOOK ONE", "TITLE I – WAGES", "Art. 5. [4] Pay.1 – Workers shall be paid under Article 9.2", "  (a) daily", "  (b) weekly (As inserted by R.A. No. 7, May 2, 2001)", "1 See D.O. No. 018-A-11.", "2 As amended by R.A. No. 8. See R.A. 9."])
    p2 = "\n".join(["Art. 6. Rest — A day.", "Article 1700 of the Civil Code applies."])
    pages_ = spark.createDataFrame([(1, 1, p1), (1, 2, p2)], "doc_id long, page_no int, content string")
    found = statute.footnotes(pages_)
    rows = statute.records(found.where("text IS NOT NULL").select("doc_id", "text"), found.where("note_number IS NOT NULL")).orderBy("article_number").collect()
    five, six = rows
    assert (five.heading, five.former_article_number, five.title_name) == ("Pay", 4, "Title I: WAGES")
    assert five.content.startswith("Workers shall be paid under Article 9.\n(a) daily\n(b) weekly") and not five.original and six.original
    assert [(a.law, a.law_date) for a in five.amendments] == [("RA 7", dt.date(2001, 5, 2)), ("RA 8", None)]
    assert [n.note_number for n in five.footnotes] == [1, 2] and five.implementing_orders == ["DO-18-A-11"] and five.related_articles == [9]
    assert six.related_articles == [] and six.footnotes == [] and six.heading == "Rest"


def test_status(spark):
    articles = spark.createDataFrame([(i,) for i in range(1, 8)], "article_number int")
    notes = spark.createDataFrame([(1, 10, "Repealed by RA 1."), (3, 11, "Superseded."), (4, 12, "See also."), (5, 13, "deemed repealed"), (6, 14, "Obsolete")], "article_number int, footnote int, note_text string")
    changes = spark.createDataFrame([(0, 1, 1, 10, "repealed", "RA 1", None), (1, 3, 3, 11, "superseded", "RA 2", "paragraph (a)")], "file_ord int, first int, last int, footnote int, effect string, by string, part string")
    free = spark.createDataFrame([(13, "idiom")], "footnote int, reason string")
    got = {(r.kind, r.article_number, r.footnote) for r in status.problems(articles, notes, changes, free).collect()}
    assert got == {("not_reviewed", 6, 14)}
    with pytest.raises(ValueError):
        status.reconciled(articles, notes, changes, free)
    ok = status.reconciled(articles, notes.where("footnote <> 14"), changes, free)
    assert {r.article_number: r.status for r in ok.collect()} == {1: "superseded", 3: "partly_superseded", **{i: "no_change_noted" for i in (2, 4, 5, 6, 7)}}
    bad = changes.unionByName(spark.createDataFrame([(2, 7, 9, 13, "modified", "x", None)], changes.schema))
    kinds = {r.kind for r in status.problems(articles, notes, bad, free.unionByName(spark.createDataFrame([(77, "y")], free.schema))).collect()}
    assert kinds == {"not_reviewed", "no_such_article", "footnote_not_on_article", "listed_twice", "never_seen"}


def test_manifest(spark):
    h = "a" * 64
    rows = [
        ("DO-1-01", "dole_order", "t", "https://x.example", None, "2020-01-02", h, False, None, None), ("DO-1-01", "dole_order", "t", "https://x.example", None, None, h, False, None, None),
        ("bad id", "dole_order", "t", "ftp://x", "x", "2 May", "zz", False, 3, "DO-2"), ("code", "labor_code", "t", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id string, kind string, title string, source_url string, download_url string, published_date string, sha256 string, ocr boolean, ocr_first_page int, superseded_by string")
    got = {(r.id, r.problem) for r in manifest.problems(df).collect()}
    assert got == {("DO-1-01", "duplicate_id"), ("DO-1-01", "duplicate_hash"), ("code", "bad_source_url")} | {
        ("bad id", p) for p in ("bad_id", "bad_order_id", "bad_source_url", "bad_download_url", "bad_published_date", "bad_superseded_by", "first_page_without_ocr", "bad_hash")
    }
    seen = spark.createDataFrame([("DO-1-01", h), ("DO-1-01", "b"), ("code", h), ("none", h)], "id string, sha256 string")
    assert sorted(r.outcome for r in manifest.verified(seen, df).collect()) == ["mismatch", "unknown", "unpinned", "verified"]
    filled = manifest.pinned(df, spark.createDataFrame([("code", "c"), ("DO-1-01", "d")], "id string, found string"))
    assert {r.id: r.sha256 for r in filled.collect()} == {"DO-1-01": h, "bad id": "zz", "code": "c"}


def test_schema_rules(spark):
    schema = {
        "type": "object", "required": ["id"], "additionalProperties": False,
        "properties": {"id": {"type": "string", "pattern": "^[a-z]+$"}, "n": {"type": "integer", "minimum": 1}, "kind": {"enum": ["a", "b"]}, "day": {"type": "string", "format": "date"},
                       "items": {"type": "array", "minItems": 1, "items": {"$ref": "#/definitions/item"}}},
        "definitions": {"item": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number"}, "items": {"type": "array", "items": {"$ref": "#/definitions/item"}}}}},
    }
    payloads = ['{"id": "ok", "n": 2, "kind": "a", "day": "2020-02-03", "items": [{"x": 1.5}]}', '{"id": "NO", "n": 0, "kind": "z", "day": "soon", "items": [], "more": 1}', '{"n": "1", "items": [{"x": "s"}, {"items": [{"y": 1}]}]}']
    df = spark.createDataFrame(list(enumerate(payloads)), "k int, p string").select("k", F.try_parse_json("p").alias("record"))
    got = {(r.k, r.path, r.message) for r in rules.errors(df, schema, ["k"]).collect()}
    assert got == {
        (1, "$", "has unknown fields more"), (1, "$.id", "does not match its pattern"), (1, "$.n", "is below its minimum"), (1, "$.kind", "is not one of the allowed values"), (1, "$.day", "is not a date"), (1, "$.items", "has too few items"),
        (2, "$", "lacks id"), (2, "$.n", "is not of type integer"), (2, "$.items[].x", "is not of type number"), (2, "$.items[]", "lacks x"), (2, "$.items[].items[]", "lacks x"),
    }
    deep = {"id": "ok"}
    item = {"y": 1}
    for _ in range(12):
        item = {"x": 1, "items": [item]}
    schema["properties"]["const"] = {"const": 3}
    df = spark.createDataFrame([(0, json.dumps({**deep, "items": [item], "const": 3})), (1, json.dumps({"id": "ok", "const": True})), (2, None)], "k int, p string").select("k", F.try_parse_json("p").alias("record"))
    found = rules.errors(df, schema, ["k"])
    got = {(r.k, r.path, r.message) for r in found.collect()}
    assert got == {(0, "$" + ".items[]" * 13, "lacks x"), (1, "$.const", "is not the constant")}
    assert {tuple(r) for r in rules.counts(found).collect()} == {("lacks x", 1), ("is not the constant", 1)}


def test_hash_lookup_and_selection(spark):
    h, g = "a" * 64, "b" * 64
    entries = spark.createDataFrame([("DO-2-02", "dole_order", h, True), ("DO-1-01", "dole_order", h, None), ("code", "labor_code", g, False), ("x", "dole_order", "zz", True)], "id string, kind string, sha256 string, ocr boolean")
    docs = spark.createDataFrame([(1, h), (2, g), (3, "zz"), (4, None)], "doc_id long, sha256 string")
    assert {(r.doc_id, r.entry_id, r.entry_kind) for r in manifest.by_hash(docs, entries).collect()} == {(1, "DO-1-01", "dole_order"), (2, "code", "labor_code"), (3, None, None), (4, None, None)}
    assert manifest.chosen(entries).count() == 4 and manifest.chosen(entries, ["code"]).count() == 1 and manifest.chosen(entries, [], True).count() == 2 and manifest.chosen(entries, None, False).count() == 2


def test_status_of_the_reviewed_file_only(spark):
    articles = spark.createDataFrame([(1, "h"), (2, "h"), (1, "other")], "article_number int, sha256 string")
    changes = spark.createDataFrame([(0, 1, 1, 10, "repealed", "RA 1", None)], "file_ord int, first int, last int, footnote int, effect string, by string, part string")
    assert {(r.article_number, r.sha256, r.status) for r in status.applied(articles, changes, "h").collect()} == {(1, "h", "superseded"), (2, "h", "no_change_noted"), (1, "other", None)}
