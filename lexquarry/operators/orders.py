"""From cleaned order texts to order records, all in Column expressions but for nested enumerations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexquarry import VERSION
from lexquarry.functions import dates, refs
from lexquarry.functions.binding import let
from lexquarry.functions.text import BLANKS, mostly_capitals, squeeze, strip
from lexquarry.operators import blocks
from lexquarry.operators.lists import items_of

#: Words that sign an order, that open its signature block, and that put it into effect.
SIGNING_WORDS = ["signed", "done", "issued", "approved", r"manila,\s+philippines"]
BLOCK_WORDS = ["done", "signed", "given", "issued", "approved", r"manila,\s+philippines"]
EFFECT_PHRASES = ["shall take effect", "shall become effective", "shall be effective", "takes effect"]
#: Verbs by which one order changes another.
AMENDING_VERBS = [
    "amend", "amends", "amended", "amending", "superseding", "supersedes", "superseded", "repealing", "repeals", "repealed",
    "revoking", "revokes", "revoked", "modifying", "modifies", "modified",
]
#: Who signs an order, and who issues it if no one is named.
OFFICIALS = ["secretary", "officer-in-charge", "officer in charge"]
DEFAULT_AUTHORITY = "Department of Labor and Employment"
#: Words in capitals that open a body, and how many lines are looked at for a title and how many it may have.
BODY_WORDS = ["RULE", "PART", "SECTION", "ARTICLE"]
COVER_LINES, TITLE_LINES = 60, 8
#: Fixed values, in bytes: the tail with a signature block and its date, the reach of a signing verb, the
#: tail searched without one, and the reach of an amending verb.
SIGNATURE_TAIL, SIGNATURE_DATE, SIGNING_REACH, DATE_TAIL, AMENDING_REACH = 3000, 300, 120, 2000, 200
#: Abbreviations after which a full stop ends no sentence.
CITING = ["no", "nos", "sec", "art", "rep", "s"]
NOTE_CITING = ["No", "Nos", "Sec", "Secs", "Art", "Arts", "Par", "Pars", "Blg", "Rep", "Inc", "Co", "vs"]


#: Who made a record: the library and its version, never a time.
PARSER = f"lexquarry {VERSION}"


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + ")"


def _bytes_of(text: Column, start: int, size: int) -> Column:
    """A byte range of a text, from 1 or from the end; a character that it cuts is replaced."""
    return F.when(F.octet_length(text) <= size, text).otherwise(F.make_valid_utf8(F.substring(text.cast("binary"), start, size).cast("string")))


def head_bytes(text: Column, size: int) -> Column:
    return _bytes_of(text, 1, size)


def tail_bytes(text: Column, size: int) -> Column:
    return _bytes_of(text, -size, size)


def signature_parts(text: Column) -> Column:
    """(body, block): the text before the signature block, and the block; a text without one is all body.

    The block begins at a line that opens with a word of signing, near the end of the text and with a
    date soon after; the first such line counts.
    """

    def cut(parts: Column) -> Column:
        rest = lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "")
        dated = lambda r: (F.octet_length(r) <= SIGNATURE_TAIL) & let(head_bytes(r, SIGNATURE_DATE), dates.first_date).isNotNull()
        opens = lambda i: parts[i].rlike(rf"(?i)^[ \t]*{_any(BLOCK_WORDS)}\b") & let(rest(i), dated)
        first = F.get(F.filter(F.sequence(F.lit(0), F.size(parts) - 1), opens), F.lit(0))
        return let(F.coalesce(first, F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i), "").alias("body"), rest(i).alias("block")))

    return let(F.split(text, rf"(?mi)^(?=[ \t]*{_any(BLOCK_WORDS)}\b)"), cut)


def signed_date_of(text: Column) -> Column:
    """The date soon after the last word of signing that has one, else the first near the end of the text.

    Cut at these words, every piece but the first is what follows one of them. Where the last has a date,
    no other is read.
    """
    text = F.col(text) if isinstance(text, str) else text
    date_of = lambda p: let(head_bytes(p, SIGNING_REACH), dates.first_date)

    def last(ps: Column) -> Column:
        every = F.filter(F.transform(F.slice(ps, F.lit(2), F.size(ps)), date_of), lambda d: d.isNotNull())
        return F.when(F.size(ps) > 1, F.coalesce(date_of(F.get(ps, F.size(ps) - 1)), let(every, lambda ds: F.get(ds, F.size(ds) - 1))))

    after = F.split(text, rf"(?i)(?=[sdiam][iospa])\b{_any(SIGNING_WORDS)}\b")
    return F.coalesce(let(after, last), let(tail_bytes(text, DATE_TAIL), dates.first_date))


def _stop(citing: list[str]) -> str:
    """The empty place behind a full stop that ends a sentence."""
    return rf"(?<=\.)(?<!\b(?:{'|'.join(citing)})\.)(?=\s|$)"


def effectivity_clause_of(titled: Column, text: Column) -> Column:
    """The sentence with the last effectivity phrase, of the section titled so if there is one.

    Sentences end at full stops that end no citation, and at blank lines.
    """
    phrase = rf"(?i)(?=[st][ha])\b{_any(EFFECT_PHRASES)}\b"

    def last(where: Column) -> Column:
        sentences = F.split(where, rf"{_stop([f'(?i:{w})' for w in CITING])}|\n\n")
        return F.when(where.rlike(phrase), let(F.filter(sentences, lambda s: s.rlike(phrase)), lambda ss: F.get(ss, F.size(ss) - 1)))

    return squeeze(F.regexp_replace(strip(let(F.coalesce(titled, text), last)), "^[—–-]+", ""))


def first_sentence_of(text: Column) -> Column:
    """Up to the first full stop before white space that follows neither an initial nor a citation."""
    return F.get(F.split(text, _stop([r"\p{L}", *NOTE_CITING]), 2), F.lit(0))


def superseded_of(text: Column, own: Column) -> Column:
    """Orders named near an amending verb, in its paragraph; those merely cited "as amended" are not meant.

    Cut at the verbs, an order is near one if it stands near the cut end of a piece. Paragraphs without
    a verb or a number of an order are left out first.
    """
    verb = rf"(?i)(?=[asrm][mueo])(?<!\bas\s{{1,3}})\b{_any(AMENDING_VERBS)}\b"
    numbered = rf"(?i){refs.ORDER_HEAD}[0-9]"

    def near(pieces: Column) -> Column:
        def ids(p: Column, i: Column) -> Column:
            none = F.array().cast("array<struct<form:string,id:string>>")
            left = F.when(i > 0, refs.mentions(head_bytes(p, AMENDING_REACH))).otherwise(none)
            right = F.when(i + 1 < F.size(pieces), refs.mentions(tail_bytes(p, AMENDING_REACH))).otherwise(none)
            return F.concat(left, right)

        return F.flatten(F.transform(pieces, ids))

    paragraphs = F.filter(F.split(text, "\n\n"), lambda p: p.rlike(numbered) & p.rlike(verb))
    found = F.flatten(F.transform(paragraphs, lambda p: let(F.split(p, verb), near)))
    return let(found, lambda ms: F.array_distinct(F.filter(F.concat(refs.ids_of(ms, refs.DASHED), refs.ids_of(ms, refs.SERIES)), lambda x: own.isNull() | (x != own))))


def supersession(edges: DataFrame, newer: str = "order_key", older: str = "superseded") -> DataFrame:
    """(newer, older, distance): every order that an order replaces, directly or through others.

    The edges are walked from both ends at once, so a chain of n orders takes log(n) rounds; each
    round is cut with a checkpoint. A cycle ends the walk, as no pair gets a shorter way.
    """
    from lexquarry.session import cut

    known = cut(edges.where(F.col(newer) != F.col(older)).groupBy(newer, older).agg(F.lit(1).alias("distance")))
    n = known.count()
    while True:
        a = known.select(newer, F.col(older).alias("_mid"), F.col("distance").alias("_d"))
        b = known.select(F.col(newer).alias("_mid"), older, "distance")
        longer = a.join(b, "_mid").where(F.col(newer) != F.col(older)).select(newer, older, (F.col("_d") + F.col("distance")).alias("distance"))
        known = cut(known.unionByName(longer).groupBy(newer, older).agg(F.min("distance").alias("distance")))
        before, n = n, known.count()
        if n == before:
            return known


def title_of(text: Column) -> Column:
    """The lines in capitals below the order number, joined; null if there are none.

    An ordered fold over the first lines: the state is what was found and whether the title is over.
    """
    lines = F.slice(F.split(text, "\n", -1), 1, COVER_LINES)
    start = F.struct(F.lit(0).alias("phase"), F.array().cast("array<string>").alias("found"))

    def step(s: Column, line: Column) -> Column:
        state = lambda phase, found: F.struct(F.lit(phase).alias("phase"), found.alias("found"))

        def titled(bare: Column) -> Column:
            over = bare.rlike(rf"^(?:{_any(BODY_WORDS)}|[A-Z]\.)\s") | (F.size(s["found"]) >= TITLE_LINES) | ~mostly_capitals(bare)
            return F.when((bare == "") | F.lower(bare).startswith("series of"), s).when(over, state(2, s["found"])).otherwise(state(1, F.concat(s["found"], F.array(bare))))

        begins = line.rlike(rf"(?i)^\s*{refs.ORDER_HEAD}[0-9]")
        return F.when(s["phase"] == 2, s).when(s["phase"] == 1, let(strip(line), titled)).when(begins, state(1, s["found"])).otherwise(s)

    return F.nullif(F.aggregate(lines, start, step, lambda s: F.array_join(s["found"], " ")), F.lit(""))


def authority_of(text: Column) -> Column:
    """"NAME, Secretary …" of the last official's line under a name in capitals; null if there is none.

    A fold from the end: the state is the official's line whose name is still looked for.
    """
    lines = F.reverse(F.split(text, "\n", -1))
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("line"), none.alias("found"), F.lit(False).alias("over"))

    def step(s: Column, raw: Column) -> Column:
        state = lambda line, found, over: F.struct(line.alias("line"), found.alias("found"), F.lit(over).alias("over"))
        official = raw.rlike(rf"(?i)^\s*{_any(OFFICIALS)}\b")

        def named(bare: Column) -> Column:
            fits = mostly_capitals(bare) & (F.size(F.split(squeeze(bare), " ")) >= 2)
            return F.when(bare == "", s).when(fits, state(none, F.concat(bare, F.lit(", "), s["line"]), True)).when(official, state(bare, none, False)).otherwise(state(none, none, False))

        return F.when(s["over"], s).when(s["line"].isNotNull(), let(strip(raw), named)).when(official, state(strip(raw), none, False)).otherwise(s)

    return F.aggregate(lines, start, step, lambda s: s["found"])


def problems(docs: DataFrame) -> DataFrame:
    """(doc_id, problem) of docs (doc_id, text, order_number and, of the manifest entry they belong to, entry_id and entry_kind).

    A document without text, without a number, or with an entry of another kind or another id.
    """
    rules = {
        "no_text": F.coalesce(strip(F.col("text")), F.lit("")) == "", "no_order_number": F.col("order_number").isNull(),
        "entry_of_other_kind": F.col("entry_kind") != "dole_order", "entry_of_other_id": F.col("entry_id") != F.col("order_number"),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    return docs.select("doc_id", F.explode(broken).alias("problem"))


def order_records(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders, sections) of docs (doc_id, file_name, text, published): the whole pipeline of one order.

    Texts are cleaned already. The body ends where the signature block begins. ``info_title``,
    ``source_url``, ``sha256``, ``superseded_by`` and ``effective_given``, which overrides the date of the
    clause, are used where docs have them. A document is one
    row from end to end, so nothing is exchanged.
    """
    optional = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("info_title", "source_url", "sha256", "superseded_by", "effective_given")}
    rows = docs.withColumns(optional).where(F.col("text").rlike(f"[^{BLANKS}]"))
    rows = rows.withColumn("order_number", refs.order_number(F.col("text"), F.col("file_name"))).withColumn("body", signature_parts(F.col("text"))["body"])
    rows = rows.withColumn("blocks", blocks.blocks_in(F.col("body")))
    null = F.lit(None).cast("string")
    whole = F.struct(
        F.lit(1).cast("bigint").alias("ord"), null.alias("kind"), null.alias("number"), null.alias("label"), null.alias("title"), F.lit(False).alias("uppercase"),
        F.col("body").alias("content"), F.lit("Full Text").alias("section_number"),
    )
    parts, kept = blocks.kept_sections(rows.select("doc_id", "body", "blocks"), "blocks")
    out = parts.select("doc_id", F.explode(F.when(F.size("blocks") > 0, kept).otherwise(F.array(whole))).alias("b")).select("doc_id", "b.ord", "b.section_number", "b.title", "b.content")
    out = out.withColumn("subsections", items_of(F.col("content")))
    titled = F.filter("blocks", lambda b: F.lower(b["title"]).contains("effectiv"))
    found = (
        rows.withColumn("titled", let(titled, lambda ts: F.get(ts, F.size(ts) - 1)["content"]))
        .withColumn("title", F.coalesce(title_of(F.col("text")), "info_title", F.concat(F.lit("Department Order "), F.regexp_replace("order_number", "^DO-", ""))))
        .withColumn("signed_date", signed_date_of(F.col("text"))).withColumn("effectivity_clause", effectivity_clause_of(F.col("titled"), F.col("text")))
        .select(
            "doc_id", "order_number", "title", "source_url", "signed_date", F.col("published").alias("published_date"), "effectivity_clause",
            F.coalesce(dates.given_date(F.col("effective_given")), dates.effective_date(F.col("effectivity_clause"), F.col("published"), F.col("signed_date"))).alias("effective_date"),
            F.coalesce(authority_of(F.col("text")), F.lit(DEFAULT_AUTHORITY)).alias("issuing_authority"),
            superseded_of(F.col("text"), F.col("order_number")).alias("supersedes"), refs.laws(F.col("text")).alias("related_laws"), refs.tags(F.col("text"), F.col("title")).alias("tags"),
            "superseded_by", F.struct(F.col("sha256").alias("source_sha256"), F.lit(PARSER).alias("parser")).alias("provenance"),
        )
    )
    return found, out
