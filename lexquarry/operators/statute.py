"""A renumbered code: articles with their book, title and chapter, and footnotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexquarry.functions import dates, refs
from lexquarry.functions.binding import let
from lexquarry.functions.text import capital_heading, squeeze, strip, upper_median
from lexquarry.operators.blocks import heading, longest
from lexquarry.operators.lists import items_of
from lexquarry.operators.orders import PARSER, first_sentence_of

#: The books as they are shown, and how their numbers are printed.
BOOKS = [
    "Preliminary Title", "Book I: Pre-Employment", "Book II: Human Resources Development", "Book III: Conditions of Employment",
    "Book IV: Health, Safety and Social Welfare Benefits", "Book V: Labor Relations", "Book VI: Post-Employment", "Book VII: Transitory and Final Provisions",
]
NUMERALS = [["ONE", "I", "1"], ["TWO", "II", "2"], ["THREE", "III", "3"], ["FOUR", "IV", "4"], ["FIVE", "V", "5"], ["SIX", "VI", "6"], ["SEVEN", "VII", "7"]]
#: The general shape of a header line: a word, a number, a separator, the rest. What it heads is told by the word.
SHAPE = r"^\s*([A-Za-z]+)\.?\s+([0-9]{1,3}|[A-Za-z]+(?:-[A-Z])?)(?![A-Za-z0-9])(\s*[-.:–—])?\s*(.*)$"
#: The words of headers.
HEADERS = {"BOOK": "book", "TITLE": "title", "CHAPTER": "chapter", "ART": "article", "ARTICLE": "article"}
#: A reference to a footnote, between two characters for private use that no text has.
OPEN, CLOSE = "\ue000", "\ue001"
TOKEN = f"{OPEN}([0-9]+){CLOSE}"
#: A line that may open a note, and a number that may refer to one.
NOTE = r"^\s*([0-9]{1,3})[ \t]+(?=[A-Z\"“(\[])"
MARK = r"(?m)(?<=[A-Za-z.,;:)\]”’])[0-9]{1,3}\b|^[0-9]{1,3}$"
#: How far footnote numbers may jump, how much wider notes are set, which lines are measured.
GAP, WIDER, MEASURED = 3, 1.3, 20
#: Verbs that begin a note on a change of the law; all but the first insert something new.
AMENDED, INSERTING = "amended", ["inserted", "added", "incorporated"]


# --- footnotes -----------------------------------------------------------------------------------
def _chain(candidates: Column, may=lambda x: F.lit(True)) -> Column:
    """The elements of an ordered array (with number ``n``) that go on counting: none jumps back or further than ``GAP``."""
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("kept"))

    def fold(cs: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            c = F.get(cs, i)
            fits = (c["n"] >= s["next"]) & (c["n"] <= s["next"] + GAP) & may(c)
            return F.struct(F.when(fits, c["n"] + 1).otherwise(s["next"]).alias("next"), F.when(fits, F.concat(s["kept"], F.array(i))).otherwise(s["kept"]).alias("kept"))

        places = F.when(F.size(cs) > 0, F.sequence(F.lit(0), F.size(cs) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.aggregate(places, start, step, lambda s: s["kept"]), lambda i: F.get(cs, i))

    return let(candidates, fold)


def _widths(lines: Column) -> Column:
    return F.filter(F.transform(lines, lambda x: F.char_length(strip(x))), lambda n: n >= MEASURED)


def note_units(pages: DataFrame, doc: str) -> DataFrame:
    """(doc, page_no, lines): the pages of each document; of a document with one page its paragraphs."""
    many = F.count("*").over(Window.partitionBy(doc)) > 1
    units = F.when(F.col("_many"), F.array("content")).otherwise(F.split("content", "\n{2,}", -1))
    return (
        pages.select(doc, F.col("page_no").cast("long").alias("_p"), "content", many.alias("_many")).select(doc, "_p", F.posexplode(units).alias("_u", "unit"))
        .select(doc, F.struct("_p", "_u").alias("page_no"), F.split("unit", "\n", -1).alias("lines"))
    )


def footnotes(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, text, note_number, note_text): the marked text in a row without a number, and the notes.

    1. Lines that may open a note are counted through over the pages of a document; the area of notes
       of a page begins at the first that counts and is shared out among them.
    2. Notes are set wider than the text. Paragraphs of that width that end the text of a page belong
       to the note that was open at the end of the page before: the last one there, or, if that page
       was taken up whole, the one open before it (windows over the pages).
    3. The rest of the pages is the text; numbers in it that count through the notes found become references.
    """
    units = note_units(pages, doc)
    opens = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), F.regexp_extract(x, NOTE, 1).try_cast("int").alias("n"))), lambda c: c["n"].isNotNull())
    units = units.withColumn("opens", opens)
    listed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "opens"))), lambda p: F.transform(p["opens"], lambda c: F.struct(p["page_no"].alias("page_no"), c["i"].alias("i"), c["n"].alias("n")))))
    chains = units.groupBy(doc).agg(listed.alias("c")).select(doc, _chain(F.col("c")).alias("counted"))
    units = units.join(chains, doc).withColumn("own", F.filter("counted", lambda c: c["page_no"] == F.col("page_no"))).drop("counted", "opens")
    area = F.coalesce(F.get("own", F.lit(0))["i"], F.size("lines"))

    def note(c: Column, k: Column) -> Column:
        end = F.coalesce(F.get("own", k + 1)["i"], F.size("lines"))
        first = F.regexp_replace(F.get("lines", c["i"]), NOTE, "")
        return F.struct(c["n"].alias("n"), F.concat(F.array(first), F.slice("lines", c["i"] + 2, end - c["i"] - 1)).alias("lines"))

    units = units.select(doc, "page_no", F.transform("own", note).alias("notes"), F.slice("lines", F.lit(1), area).alias("body"))
    measured = units.groupBy(doc).agg(
        upper_median(F.flatten(F.collect_list(_widths(F.flatten(F.transform("notes", lambda n: n["lines"])))))).alias("wide"), upper_median(F.flatten(F.collect_list(_widths(F.col("body"))))).alias("narrow")
    ).select(doc, F.when(F.col("wide") >= WIDER * F.col("narrow"), F.floor((F.col("wide") + F.col("narrow")) / 2)).alias("least"))
    paragraphs = F.regexp_extract_all(F.array_join("body", "\n"), F.lit(r"(?s).+?(?:\n(?:[ \t]*\n)+|\z)"), F.lit(0))

    def is_wide(p: Column) -> Column:
        lines = F.filter(F.split(p, "\n"), lambda x: strip(x) != "")
        return (F.size(lines) >= 2) & F.coalesce(upper_median(_widths(lines)) >= F.col("least"), F.lit(False))

    last_narrow = F.array_max(F.transform("pars", lambda p, i: F.when(~is_wide(p), i)))
    units = units.join(measured, doc).withColumn("pars", paragraphs).withColumn("keep", F.coalesce(last_narrow + 1, F.lit(0)))
    in_order = Window.partitionBy(doc).orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    taken_whole = (F.size("notes") == 0) & (F.col("keep") == 0) & (F.size("pars") > 0) & (strip(F.get("body", F.lit(0))) != "")
    state = F.when(~taken_whole, F.struct(F.get("notes", F.size("notes") - 1)["n"].alias("n")))
    units = units.withColumn("open", F.last(state, ignorenulls=True).over(in_order)["n"]).withColumn("keep", F.when(F.col("open").isNull(), F.size("pars")).otherwise(F.col("keep")))
    kept = F.array_join(F.slice("pars", F.lit(1), F.col("keep")), "")
    units = units.withColumn("kept", F.when(F.col("keep") < F.size("pars"), F.regexp_replace(kept, "\n\\z", "")).otherwise(kept))
    spilt = F.when(F.col("keep") < F.size("pars"), F.array(F.struct(F.col("open").alias("n"), F.slice("pars", F.col("keep") + 1, F.size("pars")).alias("lines")))).otherwise(F.array().cast("array<struct<n:int,lines:array<string>>>"))
    pieces = units.select(doc, "page_no", F.explode(F.concat(spilt, "notes")).alias("x")).select(doc, "page_no", F.col("x.n").alias("n"), squeeze(F.array_join("x.lines", " ")).alias("t"))
    notes = pieces.groupBy(doc, "n").agg(F.array_sort(F.collect_list(F.struct("page_no", "t"))).alias("t")).select(
        doc, F.lit(None).cast("string").alias("text"), F.col("n").alias("note_number"), F.array_join(F.filter(F.transform("t", lambda x: x["t"]), lambda x: x != ""), " ").alias("note_text"))
    bodies = units.where(strip(F.col("kept")) != "").groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "kept"))), lambda x: x["kept"]), "\n").alias("text"))
    known = notes.groupBy(doc).agg(F.collect_set("note_number").alias("known"))
    texts = units.select(doc).distinct().join(bodies, doc, "left").join(known, doc, "left").select(
        doc, marked(F.coalesce("text", F.lit("")), F.coalesce("known", F.array().cast("array<int>"))).alias("text"), F.lit(None).cast("int").alias("note_number"), F.lit(None).cast("string").alias("note_text"))
    return texts.unionByName(notes)


def marked(text: Column, known: Column) -> Column:
    """The text with the numbers that count through the known notes as references."""

    def joined(numbers: Column) -> Column:
        places = F.transform(_chain(F.transform(numbers, lambda n, i: F.struct(i.alias("i"), n.cast("int").alias("n"))), lambda c: F.array_contains(known, c["n"])), lambda c: c["i"])
        shown = lambda ps: F.transform(numbers, lambda n, i: F.when(F.array_contains(ps, i), F.concat(F.lit(OPEN), n.cast("int"), F.lit(CLOSE))).otherwise(n))
        return F.array_join(F.zip_with(F.split(text, MARK, -1), let(places, shown), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    return let(F.regexp_extract_all(text, F.lit(MARK), F.lit(0)), joined)


def note_references(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(TOKEN), 1), lambda n: n.cast("int"))


def without_references(c: Column) -> Column:
    return F.regexp_replace(c, TOKEN, "")


def leading_verb(note: Column) -> Column:
    """The first word of a note, "as" left out, in lower case."""
    return F.regexp_extract(F.lower(note), r"^\s*(?:as\s+)?(\p{L}+)", 1)


def amends(note: Column) -> Column:
    return leading_verb(note).isin(AMENDED, *INSERTING)


def inserts(note: Column) -> Column:
    return leading_verb(note).isin(*INSERTING)


def bracketed_notes(text: Column) -> Column:
    """The notes in brackets that say by what a text was changed."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda n: amends(n) & n.rlike(r"(?i)^\s*(?:as\s+)?\p{L}+\s+by\b"))


#: The number that an article had before, in brackets.
FORMER = r"^\[([0-9]{1,3})\]\s*"


# --- scan ----------------------------------------------------------------------------------------
def articles(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, ord, article_number, former_article_number, book, title_name, chapter, title_refs, chapter_refs, heading_rest, body).

    The context of an article is carried forward over the lines of its document by windows: books
    start partitions for titles, titles for chapters. All windows share one partitioning and sort.
    """
    glued = F.regexp_replace(F.regexp_replace(text, "\r", ""), r"(?<=[.;:)\]”])[ \t]+(?=(?:Chapter|Title)\s+[IVXLCDM]+\s+[–—-]\s+[A-Z]{2})", "\n")
    lines = docs.select(doc, F.posexplode(F.split(glued, "\n", -1)).alias("i", "line"))
    w = Window.partitionBy(doc).orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    line = F.col("line")
    word = F.regexp_extract(line, SHAPE, 1)
    words = F.create_map(*[F.lit(x) for pair in HEADERS.items() for x in pair])
    lines = lines.withColumn("w", F.when((word == F.upper(word)) | (word == F.initcap(word)), F.try_element_at(words, F.upper(word))))
    lines = lines.withColumns({"n": F.regexp_extract(line, SHAPE, 2), "mark": F.trim(F.regexp_extract(line, SHAPE, 3)), "rest": strip(F.regexp_extract(line, SHAPE, 4))})
    apart = (F.col("mark") != "") | (F.col("rest") == "")
    preliminary = squeeze(line) == "PRELIMINARY TITLE"
    in_contents = (F.col("w").isin("book", "title", "chapter") | squeeze(line).startswith("PRELIMINARY TITLE")) & F.regexp_replace(line, r"^\s*\p{L}+\.?", "").rlike(r"\S[ \t]+[0-9]{1,3}\s*$")
    book = F.coalesce(*[F.when(F.upper("n").isin(*names), F.lit(BOOKS[i + 1])) for i, names in enumerate(NUMERALS)])
    small = F.col("n").rlike("^(?:[IVXLCDM]{1,7}|[0-9]{1,2})$")
    is_head = (
        F.when(F.col("w") == "book", book.isNotNull() & apart).when(F.col("w") == "title", (small | F.col("n").rlike("^[IVXLCDM]{1,7}-[A-Z]$")) & apart)
        .when(F.col("w") == "chapter", small & apart).when(F.col("w") == "article", F.col("n").rlike("^[0-9]{1,3}$") & F.col("mark").isin(".", ":")).otherwise(False)
    )
    lines = lines.withColumn("contents", F.coalesce(in_contents, F.lit(False))).withColumn("h", F.when(is_head, F.col("w")))
    contents, structural = F.col("contents"), F.col("h").isNotNull() | F.col("contents")
    lines = lines.withColumn("caps", F.when((strip(line) != "") & ~structural & capital_heading(strip(line)), strip(line)))
    for k in (1, 2):
        lines = lines.withColumn(f"c{k}", F.lead("caps", k).over(w))
    lone = lambda c: (F.size(note_references(c)) > 0) & (strip(without_references(c)) == "")
    n_caps = F.when(F.col("c1").isNull(), 0).when(F.col("c2").isNull(), 1).otherwise(2)
    lines = lines.withColumn("n_caps", n_caps).withColumn(
        "wraps", F.coalesce(F.when(n_caps == 0, lone(F.lead("line", 1).over(w))).when(n_caps == 1, lone(F.lead("line", 2).over(w))).otherwise(lone(F.lead("line", 3).over(w))), F.lit(False))
    )
    after = F.when(n_caps == 0, F.lead("line", 1).over(w)).when(n_caps == 1, F.lead("line", 2).over(w)).otherwise(F.lead("line", 3).over(w))
    lines = lines.withColumn("wrapped", F.when(F.col("wraps"), after))
    lines = lines.withColumn("is_book", (F.coalesce("h", F.lit("")) == "book") & ~contents).withColumn("seen_book", F.max("is_book").over(upto))
    follow = F.concat_ws(" ", "c1", F.when(F.col("c1").isNotNull(), F.col("c2")))
    name = squeeze(without_references(F.concat_ws(" ", F.nullif("rest", F.lit("")), F.nullif(follow, F.lit("")))))
    lines = lines.withColumn("name", name)
    heads = lambda kind: F.coalesce(F.col("h") == kind, F.lit(False)) & ~contents & ((F.col("name") != "") | F.col("seen_book"))

    def shown(word: str) -> Column:
        label = F.concat(F.lit(f"{word} "), "n")
        return F.when(F.col("name") == "", label).otherwise(F.concat(label, F.lit(": "), "name"))

    lines = lines.withColumns({
        "kind": F.when(contents, "contents").when(preliminary, "preliminary").when(F.col("is_book"), "book")
        .when(heads("title"), "title").when(heads("chapter"), "chapter").when(F.col("h") == "article", "article"),
        "refs": note_references(F.concat_ws(" ", "line", follow, "wrapped")),
        "book": F.when(F.col("is_book"), book), "title": F.when(heads("title"), shown("Title")), "chapter": F.when(heads("chapter"), shown("Chapter")),
    })
    # Lines that a header above took as the rest of its name.
    took = F.when(F.col("kind") == "book", F.col("n_caps")).when(F.col("kind").isin("title", "chapter"), F.col("n_caps") + F.col("wraps").cast("int")).otherwise(0)
    lines = lines.withColumn("took", took)
    taken = F.greatest(*[F.coalesce(F.lag("took", k).over(w), F.lit(0)) >= k for k in (1, 2, 3)])
    lines = lines.withColumn("kind", F.when(taken, "taken").otherwise(F.col("kind")))
    event = lambda *kinds: F.sum(F.col("kind").isin(*kinds).cast("int")).over(upto)
    lines = lines.withColumns({
        "book_id": F.coalesce(event("book", "preliminary"), F.lit(0)), "title_id": F.coalesce(event("book", "preliminary", "title"), F.lit(0)),
        "head_id": F.coalesce(event("book", "preliminary", "title", "chapter", "article"), F.lit(0)),
    })
    in_book = Window.partitionBy(doc, "book_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    in_title = Window.partitionBy(doc, "book_id", "title_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    of = lambda c, kind, over: F.last(F.when(F.col("kind") == kind, F.col(c)), ignorenulls=True).over(over)
    lines = lines.withColumns({"in_book": of("book", "book", in_book), "in_title": of("title", "title", in_title), "in_chapter": of("chapter", "chapter", in_title),
        "title_refs": of("refs", "title", in_title), "chapter_refs": of("refs", "chapter", in_title)})
    context = F.struct(
        F.col("i").alias("ord"), F.col("n").try_cast("int").alias("article_number"), F.regexp_extract("rest", FORMER, 1).try_cast("int").alias("former_article_number"),
        F.coalesce("in_book", F.lit(BOOKS[0])).alias("book"), F.coalesce("in_title", F.when(F.col("in_book").isNull(), F.lit(BOOKS[0])).otherwise("General Provisions")).alias("title_name"),
        F.col("in_chapter").alias("chapter"), "title_refs", "chapter_refs", strip(F.regexp_replace("rest", FORMER, "")).alias("heading_rest"),
    )
    grouped = lines.where("kind IS NULL OR kind = 'article'").groupBy(doc, "head_id").agg(
        F.max(F.when(F.col("kind") == "article", context)).alias("a"), F.array_sort(F.collect_list(F.when(F.col("kind").isNull(), F.struct("i", "line")))).alias("b")
    )
    body = strip(F.array_join(F.transform("b", lambda x: x["line"]), "\n"))
    return grouped.where("a IS NOT NULL").select(doc, "a.*", body.alias("body"))


def deduped(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Of articles with one number the longest; tables of contents repeat them nearly empty."""
    return longest(found, [doc, "article_number"], F.octet_length("heading_rest") + F.octet_length("body"))


def amendments(found: DataFrame, text: str = "content", notes: str | None = None) -> DataFrame:
    """Adds ``amendments`` (law, law_date, description) from notes in brackets and from footnotes; each law once.

    Of a footnote only the first sentence counts. A date is given only where the note names one law.
    """
    shape = "array<struct<law:string,law_date:date,description:string>>"

    def of(note: Column) -> Column:
        laws = refs.cited_laws(note)
        day = F.when(F.size(laws) == 1, dates.first_date(note))
        return F.transform(laws, lambda law: F.struct(law.alias("law"), day.alias("law_date"), note.alias("description"))).cast(shape)

    every = F.transform(bracketed_notes(F.col(text)), squeeze)
    if notes is not None:
        every = F.concat(every, F.filter(F.coalesce(notes, F.array().cast("array<string>")), amends))
    found = found.withColumn("_all", F.coalesce(F.flatten(F.transform(every, of)), F.array().cast(shape))).withColumn("_laws", F.transform("_all", lambda a: a["law"]))
    first = F.filter("_all", lambda a, i: F.array_position("_laws", a["law"]) == i + 1)
    return found.withColumn("amendments", first).drop("_all", "_laws")


def records(docs: DataFrame, notes: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole article records of marked texts and their notes (doc, note_number, note_text).

    Notes are joined on (document, number), for the article and for the headings above it;
    references to notes that do not exist vanish.
    """
    raw = deduped(articles(docs, doc, text), doc)
    parts = raw.select(
        doc, "ord", "article_number", "former_article_number", "book", "title_name", "chapter",
        note_references(F.concat("heading_rest", F.lit("\n"), "body")).alias("own"),
        F.concat(
            F.transform(F.coalesce("title_refs", F.array().cast("array<int>")), lambda n: F.struct(F.col("title_name").alias("heading"), n.alias("n"))),
            F.transform(F.coalesce("chapter_refs", F.array().cast("array<int>")), lambda n: F.struct(F.col("chapter").alias("heading"), n.alias("n"))),
        ).alias("above"),
        heading(without_references(F.col("heading_rest")), bare=False).alias("h"), strip(without_references(F.col("body"))).alias("rest"),
    )
    both = F.when(F.col("h.inline") == "", F.col("rest")).when(F.col("rest") == "", F.col("h.inline")).otherwise(F.concat("h.inline", F.lit("\n"), "rest"))
    parts = parts.withColumn("content", F.regexp_replace(both, r"(?m)^[ \t]+", "")).withColumn("heading", F.col("h.title")).drop("h", "rest")
    key = [doc, "article_number"]
    asked = parts.select(*key, F.posexplode("own").alias("seq", "note_number"), F.lit(None).cast("string").alias("heading")).unionByName(
        parts.select(*key, F.posexplode("above").alias("seq", "a")).select(*key, "seq", F.col("a.n").alias("note_number"), F.col("a.heading").alias("heading"))
    )
    held = asked.join(notes.where("note_number IS NOT NULL").select(doc, "note_number", "note_text"), [doc, "note_number"])
    listed = F.array_sort(F.collect_list(F.struct("seq", "heading", "note_number", "note_text")))
    grouped = held.groupBy(*key).agg(listed.alias("n"))
    full = parts.join(grouped, key, "left").withColumn("n", F.coalesce("n", F.array().cast("array<struct<seq:int,heading:string,note_number:int,note_text:string>>")))
    full = full.withColumn("footnotes", F.transform(F.filter("n", lambda x: x["heading"].isNull()), lambda x: F.struct(x["note_number"], x["note_text"])))
    full = full.withColumn("heading_footnotes", F.transform(F.filter("n", lambda x: x["heading"].isNotNull()), lambda x: F.struct(x["heading"], x["note_number"], x["note_text"])))
    texts = F.transform("footnotes", lambda x: x["note_text"])
    full = full.withColumn("leads", F.transform(texts, first_sentence_of))
    full = amendments(full, "content", "leads")
    full = full.join(docs.select(doc, "sha256"), doc) if "sha256" in docs.columns else full.withColumn("sha256", F.lit(None).cast("string"))
    return full.select(
        doc, "article_number", "former_article_number", "book", "title_name", "chapter", "heading", "content", items_of(F.col("content")).alias("subsections"), "footnotes", "heading_footnotes", "amendments",
        (~F.exists(bracketed_notes(F.col("content")), inserts) & ~F.exists(texts, inserts)).alias("original"),
        refs.related_articles(F.col("content"), F.col("article_number")).alias("related_articles"),
        F.array_distinct(F.flatten(F.transform(texts, refs.order_ids))).alias("implementing_orders"),
        refs.tags(F.col("content"), F.col("heading")).alias("tags"), F.struct(F.col("sha256").alias("source_sha256"), F.lit(PARSER).alias("parser")).alias("provenance"),
    )
