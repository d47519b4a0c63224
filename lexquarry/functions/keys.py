"""Order keys in one form, however they are printed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Horizontal strokes that print as a hyphen.
STROKES = "‐‑‒–—―−﹘﹣－"
#: White space other than the ASCII kinds.
BLANKS = "  -​ 　﻿"
KEY = r"^(?:D\.?O\.?|DEPARTMENT ORDER)[ -]*(?:NO\.?)?[ -]*0*([0-9]+)(?:[ -]*([A-Z]))?(?:[ -]+|, *SERIES OF +| *\()((?:[0-9]{2})?[0-9]{2})\)?$"


def order_key(printed: Column) -> Column:
    """``DO-<number without leading zeros>[-<LETTER>]-<yy>``, or null if the text is no order number."""
    s = F.translate(printed, STROKES, "-" * len(STROKES))
    s = F.upper(F.trim(F.regexp_replace(s, rf"[\s{BLANKS}]+", " ")))
    part = lambda i: F.regexp_extract(s, KEY, i)
    letter = F.when(part(2) != "", F.concat(F.lit("-"), part(2))).otherwise("")
    return F.when(s.rlike(KEY), F.concat(F.lit("DO-"), part(1), letter, F.lit("-"), F.right(part(3), F.lit(2))))
