"""Identifiers, citations and topics in legal text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexquarry.functions.binding import let

#: How an order is named before its number.
ORDER_HEAD = r"(?:department\s+order|d\.?\s*o\.?)\s*no\.?\s*"
#: A mention of an order: its number, a letter, and a year behind a connector; the connector decides what it is.
#: Here and below, a look at the first letters comes before the word boundary, which costs more at every place.
MENTION = rf"(?i)(?=d)\b{ORDER_HEAD}([0-9]{{1,4}})(?:\s*-\s*([a-z])\b)?(?:([-,(\s]*(?:series\s+of|s\.)?)\s*([0-9]{{2,4}})\b)?"
DASHED, SERIES, BRACKETED = "dashed", "series", "bracketed"
#: Kinds of laws, written out.
LAW_NAMES = {"RA": "republic act", "PD": "presidential decree", "BP": "batas pambansa", "EO": "executive order"}
_LAW_WORDS = "|".join([name.replace(" ", r"\s+") for name in LAW_NAMES.values()] + [r"\.?\s*".join(k.lower()) + r"\.?" for k in LAW_NAMES])
CITATION = rf"(?i)(?=[rpbe][erxado.p\s])\b(?:{_LAW_WORDS})\s*(?:no\.?|blg\.?|bilang)?\s*([0-9]{{1,5}}(?:-[a-z])?)\b"
CODE = "PD 442 (Labor Code)"
#: Tags and the words that earn them, and how often a text must mention one.
TAGS = [
    ("telecommuting", r"telecommut\w*"),
    ("contracting", r"(?:sub)?contracting|(?:sub)?contractors?"),
    ("osh", r"occupational\s+safety|safety\s+and\s+health"),
    ("wages", r"(?:minimum\s+)?wages?"),
    ("termination", r"termination|dismissal|security\s+of\s+tenure"),
    ("probationary", r"probationary"),
    ("apprenticeship", r"apprentices?(?:hip)?|learners?(?:hip)?"),
    ("leave", r"maternity|paternity|service\s+incentive\s+leave|solo\s+parents?"),
    ("labor_relations", r"collective\s+bargaining|labor\s+organizations?|unfair\s+labor\s+practices?"),
    ("kasambahay", r"kasambahay|domestic\s+workers?"),
    ("ofw", r"overseas\s+filipinos?|migrant\s+workers?|ofws?"),
    ("harassment", r"sexual\s+harassment|safe\s+spaces|gender-based"),
    ("drug_free_workplace", r"drug-free|dangerous\s+drugs|drug\s+test(?:ing|s)?"),
]
MENTIONS = 3
#: The first two letters of these words, each by itself.
TAG_LETTERS = "(?=[tcsomwdpalukg][euocairpnvf])"
#: The widest range of articles that is listed one by one, and how far "of …" is looked for.
WIDEST_RANGE = 20
LOOK_AHEAD = 40
ARTICLES = rf"(?is)\bart(?:icle)?s?\.?\s+([0-9]{{1,3}})(?:\s*(to|and|-|–)\s*([0-9]{{1,3}}))?\b(?=(.{{0,{LOOK_AHEAD}}}))"


def _mention(piece: Column) -> Column:
    """struct<form, id> of one mention; the form is null if it names no year."""

    def parsed(g: Column) -> Column:
        number, letter, link, year = (g[i] for i in range(4))
        bare = F.lower(F.regexp_replace(link, r"[\s,]", ""))
        long = F.char_length(year) == 4
        form = (
            F.when((bare == "-") & (F.char_length(year) == 2), DASHED)
            .when(long & F.btrim(bare, F.lit("(")).isin("seriesof", "s."), SERIES).when(long & (bare == "("), BRACKETED)
        )
        name = F.concat(F.lit("DO-"), number, F.when(letter != "", F.concat(F.lit("-"), F.upper(letter))).otherwise(""), F.lit("-"), F.right(year, F.lit(2)))
        return F.struct(form.alias("form"), name.alias("id"))

    return let(F.array(*[F.regexp_extract(piece, MENTION, i) for i in (1, 2, 3, 4)]), parsed)


def mentions(text: Column) -> Column:
    """array<struct<form, id>> of the orders that a text names with a year, in the order of the text; digits as printed."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(MENTION), F.lit(0)), _mention), lambda m: m["form"].isNotNull())


def ids_of(found: Column, form: str) -> Column:
    """The ids of the mentions of one form."""
    return F.transform(F.filter(found, lambda m: m["form"] == form), lambda m: m["id"])


def order_number(text: Column, file_name: Column) -> Column:
    """The id that stands first in the text, in the dashed or the series form, else the one in the file name; digits as printed.

    Mostly the first mention has one of these forms; the others are read only where it has not.
    """
    every = F.get(F.filter(mentions(text), lambda m: m["form"] != BRACKETED), F.lit(0))["id"]
    usual = lambda piece: let(_mention(piece), lambda m: F.when(m["form"] != BRACKETED, m["id"]))
    first = let(F.regexp_extract(text, MENTION, 0), lambda piece: F.when(piece != "", F.coalesce(usual(piece), every)))
    parts = F.split(F.upper(F.regexp_replace(file_name, r"\.[A-Za-z0-9]+$", "")), "[-_ ]+")
    glued = F.regexp_replace(F.array_join(parts, "-"), "(^|-)DO([0-9])", "$1DO-$2")
    named = F.regexp_extract(glued, r"(?:^|-)(DO-[0-9]{1,4}(?:-[A-Z])?)-(?:[0-9]{0,2})([0-9]{2})(?:-|$)", 1)
    year = F.regexp_extract(glued, r"(?:^|-)DO-[0-9]{1,4}(?:-[A-Z])?-[0-9]{0,2}([0-9]{2})(?:-|$)", 1)
    return F.coalesce(first, F.when(named != "", F.concat(named, F.lit("-"), year)))


def order_ids(text: Column) -> Column:
    """All order ids in a text: dashed forms first, then series forms, then years in brackets; first mention of each, no leading zeros."""

    def plain(ms: Column) -> Column:
        by_form = F.concat(*[ids_of(ms, form) for form in (DASHED, SERIES, BRACKETED)])
        return F.array_distinct(F.transform(by_form, lambda x: F.regexp_replace(x, "^DO-0+(?=[0-9])", "DO-")))

    return let(mentions(text), plain)


def citations(text: Column) -> Column:
    """array<struct<kind, number>> of the laws that a text cites, in its order; numbers with their letter, in capitals."""

    def parsed(piece: Column) -> Column:
        kind = lambda letters: F.coalesce(*[F.when(letters.startswith(k.lower()) | letters.startswith(name.replace(" ", "")), F.lit(k)) for k, name in LAW_NAMES.items()])
        return F.struct(let(F.regexp_replace(F.lower(piece), r"[\s.]", ""), kind).alias("kind"), F.upper(F.regexp_extract(piece, CITATION, 1)).alias("number"))

    return F.transform(F.regexp_extract_all(text, F.lit(CITATION), F.lit(0)), parsed)


def laws(text: Column) -> Column:
    """Acts, then decrees, then the code by name; each once. Acts have three digits at least, decrees four at most."""

    def listed(cited: Column) -> Column:
        digits = lambda c: F.substring_index(c["number"], "-", 1)
        name = lambda c: F.concat(c["kind"], F.lit(" "), digits(c))
        acts = F.transform(F.filter(cited, lambda c: (c["kind"] == "RA") & (F.char_length(digits(c)) >= 3)), name)
        decrees = F.transform(F.filter(cited, lambda c: (c["kind"] == "PD") & (F.char_length(digits(c)) <= 4)), name)
        return F.concat(acts, decrees)

    code = F.when(F.lower(text).contains("labor code"), F.array(F.lit(CODE))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(let(citations(text), listed), code))


def cited_laws(text: Column) -> Column:
    """Citations in the short form "RA 6715", first mention of each, without the code's own decree."""
    short = F.transform(citations(text), lambda c: F.concat(c["kind"], F.lit(" "), c["number"]))
    return F.filter(F.array_distinct(short), lambda x: x != "PD 442")


def tags(text: Column, title: Column) -> Column:
    """Topics named in the title or at least three times in the text, in the order of the rules.

    One pass over the text finds the words of all topics; what each stands for is decided on the words alone.
    """
    every = rf"(?i){TAG_LETTERS}\b(?:{'|'.join(p for _, p in TAGS)})\b"
    named_any = F.coalesce(title.rlike(every), F.lit(False))

    def earned(words: Column) -> Column:
        def one(tag: str, pattern: str) -> Column:
            named = named_any & title.rlike(rf"(?i)\b(?:{pattern})\b")
            often = (F.size(words) >= MENTIONS) & (F.size(F.filter(words, lambda w: w.rlike(rf"(?i)^(?:{pattern})$"))) >= MENTIONS)
            return F.when(often | named, F.lit(tag))

        return F.when((F.size(words) >= MENTIONS) | named_any, F.array_compact(F.array(*[one(t, p) for t, p in TAGS]))).otherwise(F.array().cast("array<string>"))

    return let(F.regexp_extract_all(text, F.lit(every), F.lit(0)), earned)


def related_articles(text: Column, own: Column) -> Column:
    """Other articles of the same code that a text refers to, ascending; those of other laws are skipped."""
    pieces = F.zip_with(
        F.zip_with(F.regexp_extract_all(text, F.lit(ARTICLES), 1), F.regexp_extract_all(text, F.lit(ARTICLES), 2), lambda a, s: F.struct(a.alias("a"), s.alias("s"))),
        F.zip_with(F.regexp_extract_all(text, F.lit(ARTICLES), 3), F.regexp_extract_all(text, F.lit(ARTICLES), 4), lambda b, t: F.struct(b.alias("b"), F.lower(F.ltrim(t)).alias("t"))),
        lambda x, y: F.struct(x["a"].cast("int").alias("a"), F.lower(x["s"]).alias("s"), y["b"].try_cast("int").alias("b"), y["t"].alias("t")),
    )
    own_law = F.filter(pieces, lambda p: ~p["t"].startswith("of ") | p["t"].contains("this code") | p["t"].contains("labor code"))

    def numbers(p: Column) -> Column:
        span = (p["s"] != "and") & (p["b"] > p["a"]) & (p["b"] - p["a"] <= WIDEST_RANGE)
        return F.when(p["b"].isNull(), F.array(p["a"])).when(span, F.sequence(p["a"], p["b"])).otherwise(F.array(p["a"], p["b"]))

    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(own_law, numbers)), lambda n: n != own)))
