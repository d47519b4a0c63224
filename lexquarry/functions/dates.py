"""Dates in legal text as Column expressions. A date that is not stated is never guessed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexquarry.functions.binding import let

#: The months, and the spelt numbers of days.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
SPELT_DAYS = {"ten": 10, "fifteen": 15, "thirty": 30, "sixty": 60}

_NAME = rf"\b(?:{'|'.join(m[:3] for m in MONTHS)})[a-z]*"
#: A month and two numbers in either order; what the words and numbers mean is decided on the piece alone.
#: A look at the first letters comes before the word boundary, which costs more at every place.
_PIECE = rf"(?i)(?=[0-9]|[jfmasond][aepuco][bcglnprtvy])(?:\b[0-9]{{1,2}}(?:st|nd|rd|th)?\s+(?:day\s+of\s+)?{_NAME},?|{_NAME}\s+[0-9]{{1,2}},?)\s+[0-9]{{4}}"
_COUNTED = r"(?i)(\S+)\s+(?:calendar\s+)?days?\s+(?:after|following|from)\b"


def month_number(name: Column) -> Column:
    """1 to 12 for a month or its first letters, three at least; null for other words."""
    known = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for n in range(3, len(m) + 1) for x in (F.lit(m[:n]), F.lit(i).cast("bigint"))])
    return let(F.lower(name), lambda word: F.try_element_at(known, F.when(F.left(word, F.lit(4)) == "sept", F.lit("sept")).otherwise(word)))


def _date(piece: Column) -> Column:
    month = month_number(F.regexp_extract(piece, f"(?i){_NAME}", 0)).cast("string")
    return let(F.regexp_extract_all(piece, F.lit("[0-9]+"), F.lit(0)), lambda numbers: F.concat_ws("-", numbers[1], F.coalesce(month, F.lit("")), numbers[0]).try_cast("date"))


def first_date(c: Column) -> Column:
    """The first date in a text, in either printed style.

    Each style is tried once: an impossible first date of a style is not replaced by a later one of
    the same style, only by the first of the other. Where the first of all is possible, nothing else is read.
    """
    day_first = lambda p: p.rlike("^[0-9]")
    pieces = F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0))
    firsts = lambda ps: F.concat(F.slice(ps, 1, 1), F.slice(F.filter(ps, lambda p: day_first(p) != day_first(ps[0])), 1, 1))
    either = let(pieces, lambda ps: F.get(F.filter(F.transform(firsts(ps), _date), lambda d: d.isNotNull()), F.lit(0)))
    return let(F.regexp_extract(c, _PIECE, 0), lambda p: F.when(p != "", F.coalesce(_date(p), either)))


def offset_days(clause: Column) -> Column:
    """The days that a clause counts from its event, in figures or else spelt; null if it states none."""

    def value(bare: Column) -> Column:
        figure = F.get(F.filter(bare, lambda w: w.rlike("^[0-9]{1,3}$")), F.lit(0)).cast("int")
        spelt = F.create_map(*[F.lit(x) for pair in SPELT_DAYS.items() for x in pair])
        return F.coalesce(figure, F.get(F.filter(F.transform(bare, lambda w: F.try_element_at(spelt, w)), lambda n: n.isNotNull()), F.lit(0)))

    return let(F.transform(F.regexp_extract_all(clause, F.lit(_COUNTED), F.lit(1)), lambda w: F.lower(F.btrim(w, F.lit("()")))), value)


def effective_date(clause: Column, published: Column, signed: Column) -> Column:
    """When an order takes effect, from its clause and its dates; null whenever the clause leaves it open."""

    def counted(low: Column) -> Column:
        base = F.when(low.contains("publication"), published).when(low.contains("sign") | low.contains("approv"), signed)
        at_once = F.when(low.contains("publication"), published).when(low.contains("immediately"), signed)
        return F.when(~low.contains("working day"), let(offset_days(clause), lambda days: F.when(days.isNotNull(), F.date_add(base, days)).otherwise(at_once)))

    return F.coalesce(first_date(clause), let(F.lower(clause), counted))


def given_date(text: Column) -> Column:
    """A date given as ``yyyy-MM-dd`` or as an RFC 3339 time, which is taken at UTC; null for anything else."""
    day = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
    time = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.][0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$"), F.to_utc_timestamp(F.try_to_timestamp(F.upper(text)), F.current_timezone()))
    return F.coalesce(day, time.cast("date"))
