"""Sentence units in any script.

The rules are those of Unicode's sentence boundaries: terminators come from the character property
``Sentence_Break`` (STerm, ATerm) and so cover every script; closing marks stay with their
sentence; a full stop before a lower-case letter, or inside a number or word, ends nothing. On top:
abbreviations suppress a boundary, those of titles by the language of the text, those of references
only before a number; the language is the given one or, where none of the known ones is given, the one
whose function words the text has most of. Quotations and brackets inside a sentence end nothing; enumerations are cut at their labels; Thai, which has no
terminator, is cut at white space between two Thai letters.

Defined results: null, empty and blank texts have no units; a text without terminators is one unit
per block between blank lines; an opening mark without its closing mark in the same block counts
as an ordinary character; wrongly decoded runs are read as they were meant, with positions as
stored, if one byte stands for one stored character; repeated rows give repeated units; extra columns are dropped. Positions
are 0-based, in characters, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.llm.encoding import decoded_view

_PLANES = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))
STERM = "".join(regex.findall(r"\p{Sentence_Break=STerm}", _PLANES))
ATERM = "".join(regex.findall(r"\p{Sentence_Break=ATerm}", _PLANES))
#: Terminators that need no white space after them.
WIDE = "。！？｡．﹒﹖﹗"
PAIRS = {"(": ")", "[": "]", "（": "）", "「": "」", "『": "』", "【": "】", "《": "》", "〈": "〉", "“": "”", "«": "»"}
BRACKETS = "([（【"
CLOSERS = "".join(dict.fromkeys(PAIRS.values())) + "’\"'"
#: Titles and parts of names, by language; they never end a sentence. Official texts of all of them use the English ones.
TITLES = {
    "en": {"Mr", "Mrs", "Ms", "Messrs", "Dr", "Prof", "Atty", "Engr", "Hon", "Rev", "Fr", "Gen", "Col", "Capt", "Sgt", "Gov", "Sen", "Rep", "Pres", "Dir", "St", "Mfg", "Brgy", "Bldg", "Ave", "Dept", "Mt", "Ft"},
    "fil": {"G", "Gng", "Bb", "Kgg"},
    "es": {"Sr", "Sra", "Srta", "Sres", "Dra", "Avda", "Av", "Ud", "Uds", "D", "Dña", "Lic", "Ing"},
    "hi": {"डॉ", "श्री"},
    "ar": {"د", "أ", "م"},
}
#: Words that go on in a sentence whatever their language.
ALWAYS = {"i.e", "e.g", "cf", "Cf", "vs", "viz", "approx", "Approx", "ej", "R.A", "P.D", "B.P", "E.O", "D.O", "G.R"}
#: Words of references, by language; they suppress a boundary before a number only.
REFERENCES = {
    "en": {"Sec", "Secs", "Art", "Arts", "No", "Nos", "par", "pars", "p", "pp", "Fig", "Figs", "Vol", "Vols", "Ch", "Rm"},
    "fil": {"Blg", "Sek"}, "es": {"núm", "Núm", "núms", "Res", "pág", "págs"}, "hi": {"सं", "क्र", "पृ"}, "ar": {"ص"},
}
EVERY_REFERENCE = frozenset().union(*REFERENCES.values())
#: The commonest function words, to tell the languages in Latin letters apart.
FUNCTION_WORDS = {
    "en": {"the", "of", "and", "to", "is", "in", "for", "shall", "with", "that", "by", "on"}, "fil": {"ang", "ng", "sa", "na", "mga", "ay", "si", "kung", "hindi", "para"},
    "es": {"el", "la", "de", "que", "los", "las", "en", "del", "por", "con", "una", "se"},
}
#: Before a single letter these words mean a mark or a kind, not an initial.
NO_INITIAL = {"a", "an", "the", "grade", "letter", "class", "type", "group", "plan", "vitamin"}
NUMBERED = regex.compile(r"[^\s\p{L}]*(?:\p{Nd}|[IVXLC]+\b|[^\s.,;:]*[-/]?\p{Nd})")


def language_of(text: str) -> str:
    """The language whose function words a text in Latin letters has most of; English if it has none."""
    words = set(re.findall(r"[a-z]+", text.lower()))
    return max(FUNCTION_WORDS, key=lambda k: (len(FUNCTION_WORDS[k] & words), k == "en"))


def titles_of(lang: str | None, text: str) -> frozenset[str]:
    """The titles that count in a text; those of scripts of their own always do."""
    known = lang.split("-")[0] if lang else ""
    known = {"tl": "fil"}.get(known, known)
    own = known if known in FUNCTION_WORDS else language_of(text)
    return _titles(own)


@lru_cache
def _titles(lang: str) -> frozenset[str]:
    return frozenset(TITLES["en"] | TITLES[lang] | TITLES["hi"] | TITLES["ar"])


#: Abbreviations that end a sentence only before a capital or an opening mark.
OPEN_ENDED = {"Inc", "Co", "Corp", "Ltd", "Jr", "a.m", "p.m", "A.M", "P.M", "M.D", "Ph.D", "al", "etc", "ed", "suppl", "kg", "hr", "hrs", "min", "km"}
#: Particles that carry a Japanese sentence on after a quotation.
CARRY_ON = "とがをはにのもでやっ"
LABEL = r"(?:\((?:[A-Za-z]|[ivxlIVXL]{1,5}|[0-9]{1,3})\)|(?:[A-Za-z]|[ivxl]{1,5}|[0-9]{1,3})[.)]|[•▪●◦‣○■*–-])"
THAI = "ก-ฺเ-๎"

_class = lambda chars: "[" + "".join(map(re.escape, chars)) + "]"
_SHUT = frozenset(PAIRS.values())
#: The only characters at which anything is decided; everything else is skipped by one class search.
EVENT = re.compile(rf"\n|{_class([*PAIRS, *_SHUT])}|(?<![0-9])\.|\.(?![0-9])|{_class((STERM + ATERM).replace('.', ''))}")
TERMS = re.compile(f"{_class(STERM + ATERM)}+")
BLANK_LINE = re.compile(r"\n[^\S\n]*\n\s*")
LABELLED = re.compile(rf"\n[^\S\n]*{LABEL}[^\S\n]+(?=\S)")
FIRST_LABEL = re.compile(rf"\s*{LABEL}\s")
WORD = re.compile(r"(?:[A-Za-zÀ-ɏ][A-Za-zÀ-ɏ.]*|[^\W\d_A-Za-zÀ-ɏ][\wऀ-ॿ]*)$")
LEADS = re.compile(r"(?:[:;,]|\b(?:and|or|at|o|y|u|e))\s*$")
THAI_GAP = re.compile(rf"(?<=[{THAI}])\s+(?=[{THAI}])")
HAS_THAI = re.compile(f"[{THAI}]")
BLANK = re.compile(r"\s*")


def _starts(text: str, at: int) -> bool:
    """Whether a sentence can start at the non-blank position ``at``."""
    c = text[at]
    if c.islower():
        after = text[at + 1 : at + 2]
        return after.isupper() or after.isdigit()  # eServices, v2.1
    return c.isalnum() or c in PAIRS or c in "¿¡\"'‘•§₱$€" or not c.isascii()


def _ends(text: str, at: int, end: int, marks: str, titles) -> bool:
    """Whether the terminators text[at:end], outside any quotation or bracket, end a sentence."""
    size = len(text)
    if any(c in WIDE for c in marks):
        return True
    after = end
    while after < size and text[after] in CLOSERS:
        after += 1
    if after >= size:
        return True
    nxt = BLANK.match(text, after).end()
    if nxt == size:
        return True
    if nxt == after:
        # No white space: only a terminator other than the full stop before an opening mark or another script.
        return marks.strip("." + ATERM) != "" and (text[nxt] in PAIRS or text[nxt] in "¿¡" or not text[nxt].isascii())
    if not _starts(text, nxt):
        return False
    if marks.strip("." + ATERM):
        return True
    left = at
    while left > 0 and not text[left - 1].isspace():
        left -= 1
    m = WORD.search(text, left, at)
    if not m:
        return True
    word = m.group()
    if word in OPEN_ENDED:
        return not text[nxt].isdigit()
    if word in ALWAYS or word in titles():
        return False
    if word in EVERY_REFERENCE:
        return not NUMBERED.match(text, nxt)
    if len(word) == 1 and (word.isupper() or not word.islower()):
        before = text[max(0, m.start() - 12) : m.start()].rstrip().rpartition(" ")[2].lower() if word.isascii() else ""
        return before in NO_INITIAL
    return "." not in word or not all(len(x) <= 1 for x in word.split("."))


def sentence_spans(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit of ``text``."""
    if not text or text.isspace():
        return []
    held: list[frozenset[str]] = []

    def titles() -> frozenset[str]:
        if not held:
            held.append(titles_of(lang, text))
        return held[0]

    spans: list[tuple[int, int]] = []
    start, stack, closed = 0, [], -1

    def emit(end: int) -> None:
        nonlocal start
        part = text[start:end]
        left = start + len(part) - len(part.lstrip())
        right = start + len(part.rstrip())
        if left < right:
            if HAS_THAI.search(part):
                for gap in THAI_GAP.finditer(text, left, right):
                    spans.append((left, gap.start()))
                    left = gap.end()
            spans.append((left, right))
        start = end

    block_end = -1
    # Events before this position were dealt with, or lie in the label of an item.
    passed = m.end() if (m := FIRST_LABEL.match(text)) else 0
    size = len(text)
    for event in EVENT.finditer(text):
        at = event.start()
        if at < passed:
            continue
        c = text[at]
        end = at + 1
        if c == "\n":
            if m := BLANK_LINE.match(text, at):
                emit(at)
                start, stack, closed = m.end(), [], -1
                passed = label.end() if (label := FIRST_LABEL.match(text, start)) else start
            elif (m := LABELLED.match(text, at)) and LEADS.search(text, max(start, at - 12), at):
                emit(at)
                stack, closed, passed = [], -1, m.end()
        elif c in PAIRS:
            closer = PAIRS[c]
            if at > block_end:
                b = text.find("\n\n", at)
                block_end = size if b < 0 else b
            if text.find(closer, end, block_end) >= 0:
                stack.append((closer, at, c in BRACKETS))
        elif c in _SHUT:
            if not stack or stack[-1][0] != c:
                continue
            _, opened, bracket = stack.pop()
            inner = closed == at
            if inner:
                closed = end
            if stack or not inner:
                continue
            nxt = BLANK.match(text, end).end()
            if nxt == size:
                continue
            whole = not text[start:opened].strip()
            c = text[nxt]
            if not _starts(text, nxt) or c in "、，；：。！？":
                stop = False
            elif bracket:
                stop = whole
            elif c.isupper() or c.isdigit() or c in PAIRS or c in "¿¡":
                stop = True
            else:  # a script without case: a quotation at the start is followed by who said it
                stop = not whole and not (nxt == end and c in CARRY_ON)
            if stop:
                emit(end)
        else:
            end = closed = passed = TERMS.match(text, at).end()
            if not stack and _ends(text, at, end, text[at:end], titles):
                while end < size and text[end] in CLOSERS:
                    end += 1
                emit(end)
                passed = end
    emit(size)
    return spans


def stored_spans(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """Units of a text as stored: where a wrong decoding hid the terminators, they are found in what was meant."""
    view = decoded_view(text) if text and not text.isascii() else None
    if view is None:
        return sentence_spans(text, lang)
    meant, at = view
    return [(at[a], at[b]) for a, b in sentence_spans(meant, lang)]


def sentence_units(df: DataFrame, text: str = "text") -> DataFrame:
    """(tab, rec_id, start_pos, end_pos): one row per unit of each row of df (tab, rec_id, text and, if there is one, lang)."""

    def work(batch):
        tabs, ids, starts, ends = [], [], [], []
        for tab, rec, value, lang in zip(*(column(batch, c) for c in ("tab", "rec_id", "text", "lang"))):
            got = stored_spans(value, lang)
            tabs += [tab] * len(got)
            ids += [rec] * len(got)
            starts += [a for a, _ in got]
            ends += [b for _, b in got]
        return {"tab": tabs, "rec_id": ids, "start_pos": starts, "end_pos": ends}

    lang = F.col("lang") if "lang" in df.columns else F.lit(None).cast("string")
    rows = df.where(F.col(text).isNotNull()).select("tab", "rec_id", F.col(text).alias("text"), lang.alias("lang"))
    return map_batches(rows, work, "tab string, rec_id long, start_pos int, end_pos int")


def covered(df: DataFrame) -> DataFrame:
    """(tab, rec_id, n_units, digest) of df (tab, rec_id, text, lang): the digest of the units of a text, end to end without blanks.

    As every character that is no blank is in exactly one unit, it is that of the text without blanks.
    """

    def work(batch):
        out = {"tab": column(batch, "tab"), "rec_id": column(batch, "rec_id"), "n_units": [], "digest": []}
        for text, lang in zip(column(batch, "text"), column(batch, "lang")):
            spans = stored_spans(text, lang)
            out["n_units"].append(len(spans))
            out["digest"].append(hashlib.md5(re.sub(r"\s", "", "".join(text[a:b] for a, b in spans)).encode()).hexdigest())
        return out

    return map_batches(df.where(F.col("text").isNotNull()).select("tab", "rec_id", "text", "lang"), work, "tab string, rec_id long, n_units int, digest string")
