"""Noise in text from scanned pages: find it line by line, and repair the text.

1. *Counts* of words, of pairs of neighbouring words and of short lines, pre-aggregated inside tasks, stay
   tables. Nothing is cut by its share of the corpus: every threshold is a least support (``LEAST``), a ratio
   between two counts, or a confidence bound, so a text gets the same rows in a small and a large corpus.
2. *Page furniture*: lines at page edges are masked (digits to ``#``, and runs of capitalised words one after
   another to ``<X>``). A mask becomes a header template if it stands at edges nearly always, as far as its count
   tells (Wilson's lower bound), or, grouped by scan, on half of the pages of one scan; masks whose number
   follows the page number become page-number templates. Templates are matched with up to two misread
   characters. They go to the tasks in blocks of ``TEMPLATE_BYTES``; beyond one block every block labels all
   lines and the labels are joined to the texts.
3. *Misread words*: words are grouped by confusable-glyph skeleton. A form that another form of its group
   exceeds ``DOMINANCE`` times, or at all if it has other signs than letters, is suspect; tasks recognise suspects by a bitmap of fixed size and hand on only
   those with their neighbours, for joins with the forms and with the pairs: the frequent form counts if a
   neighbour supports it. Words broken at a line end are joined with the next line of running text or, by a
   window over the pages of a scan, with the next page, and looked up whole and hyphened.
4. *Paragraphs* are reflowed in windows over the lines of a scan, so they run on across pages.

Defined results: null and empty texts have no lines of interest; lines are split at line feeds only
and counted from 0; a page scanned twice gives rows for each scan; a broken word whose next page is
missing counts as broken if its first part is in lower case; extra columns are dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.session import cut

LEAST, DOMINANCE = 3, 10
#: Lower bounds of the share of a mask's lines at page edges, and of those that print the page number.
EDGE_BOUND, NUMBER_BOUND, Z = 0.5, 0.35, 1.96
SHORT = 8
EDGE = 3
TEMPLATE_BYTES = 1 << 20
#: Size of the bitmap of suspect forms.
BITS = 1 << 24
#: Glyphs that scans confuse, each replaced by strokes that all look-alikes share: ``d`` looks like ``cl``,
#: ``h`` like ``li``, ``u`` like ``ii``, ``n`` like ``ri``, ``m`` like ``rn``, and so on.
GLYPHS = str.maketrans({
    **dict.fromkeys("1!|lj", "i"), "0": "o", "@": "a", **dict.fromkeys("5sq9$", "g"), **dict.fromkeys("f+", "t"), "e": "c",
    "d": "ci", **dict.fromkeys("hbu68", "ii"), **dict.fromkeys("nñ", "ri"), "m": "rri", "w": "vv",
})
BREAK = "-‐‑–¬­"
BROKEN = re.compile(rf"([^\W\d_]+)[{BREAK}]\s*$")
EDGE_PUNCT = "“”\"'‘’«».,;:?()[]…•¿¡"
TOKEN = re.compile(r"\S+")
HEAD = re.compile(r"\s*[“\"'(]*([^\W\d_]+)")
LETTERS = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*$")
NUMBER = re.compile(r"[0-9]+")
PAGE = re.compile(
    r"(?i)^[^\w]*(?:(?:page|pahina|pg|p)\.?\s*[0-9]{1,4}(?:\s*(?:of|ng|/)\s*[0-9]{1,4})?|[0-9]{1,3}(?:\s*/\s*[0-9]{1,4})?(?:\s*\|\s*p\s*a\s*g\s*e)?|[ivxl]{1,7})[^\w]*$"
)
ROMAN = re.compile(r"(?i)^[^\w]*[ivxl]{1,7}[^\w]*$")


@lru_cache(200_000)
def skeleton(word: str) -> str:
    """One form for all words that scans may confuse."""
    return word.translate(GLYPHS)


def plain(token: str) -> str:
    return token.strip(EDGE_PUNCT).lower()


def digits_masked(bare: str) -> str:
    return NUMBER.sub("#", re.sub(r"-[A-Za-z](?=-)", "", bare)).lower()


def masks(bare: str) -> list[str]:
    """The line with its digits masked, then with one run of one or two capitalised words at a time masked as well."""
    tokens = bare.split()
    plain_mask = [digits_masked(t) for t in tokens]
    found = [" ".join(plain_mask)]
    capital = [t.strip(EDGE_PUNCT)[:1].isupper() and not any(c.isdigit() for c in t) for t in tokens]
    for n in (1, 2):
        for i in range(len(tokens) - n + 1):
            if all(capital[i : i + n]):
                found.append(" ".join([*plain_mask[:i], "<X>", *plain_mask[i + n :]]))
    return found


def place(form: str) -> int:
    return xxhash.xxh32_intdigest(form) & (BITS - 1)


def kind_of(token: str) -> str:
    """What stands for a token in a pair of neighbours: the word, a name or a number."""
    bare = token.strip(EDGE_PUNCT)
    if any(c.isdigit() for c in bare) and not bare[:1].islower():
        return "#"
    return "X" if bare[:1].isupper() else bare


class Specks:
    """Stray marks: short lines that hardly ever stand inside longer lines."""

    def __init__(self, lines: dict[str, int], inner: dict[str, int]):
        self.specks = frozenset(
            s for s, n in lines.items()
            if not PAGE.match(s) and len(s) <= 6 and not s.endswith((".", ";", ":", ",", "?", "”", "»", ")")) and s == s.strip("-")
            and not any(c.isdigit() and len(s.split()) == 1 for c in s)
            and max(inner.get(t, 0) for t in s.split()) < n
        )
        self.speck_tokens = frozenset(t.lower() for s in self.specks for t in s.split())

    def is_speck(self, bare: str) -> bool:
        if len(bare) > SHORT:
            return False
        if bare in self.specks or not any(c.isalnum() for c in bare):
            return True
        tokens = bare.split()
        if len(tokens) < 2 or PAGE.match(bare) or bare[0] in "(•" or any(len(t) > 1 and t[-1] in ".;,:" and t[:-1].isalnum() for t in tokens):
            return False
        return all(len(t) == 1 for t in tokens) and not all(t.isdigit() for t in tokens) or any(not any(c.isalnum() for c in t) and t not in "•—–&" for t in tokens)

    def without_specks(self, bare: str) -> str:
        """The line without stray marks at its ends."""
        tokens = bare.split()
        a, b = 0, len(tokens)
        stray = lambda t: t.lower() in self.speck_tokens or not any(c.isalnum() for c in t)
        while b - a > 1 and stray(tokens[b - 1]):
            b -= 1
        while b - a > 2 and all(len(t) == 1 and t.isalpha() for t in tokens[b - 2 : b]):
            b -= 2
        while b - a > 1 and stray(tokens[a]):
            a += 1
        return " ".join(tokens[a:b])


def keeps_hyphen(first: str, rest: str) -> bool:
    """Whether a word broken at a line end keeps its hyphen whatever the corpus says."""
    return not rest or not rest[0].islower() and not first.isupper()


def _counts(df: DataFrame) -> DataFrame:
    """(kind, key, n): words (``w``), pairs (``b``), short lines (``l``) and short tokens inside lines (``i``)."""

    def work(batch):
        words, pairs, lines, inner = Counter(), Counter(), Counter(), Counter()
        for text in column(batch, "text"):
            for line in text.split("\n"):
                bare = line.strip()
                if len(bare) <= SHORT:
                    if bare:
                        lines[bare] += 1
                    continue
                tokens = bare.split()
                words.update(map(plain, tokens))
                inner.update(t for t in tokens[:-2] if len(t) <= 4)
                kinds = list(map(kind_of, tokens))
                pairs.update(map(" ".join, zip(kinds, kinds[1:])))
        shaped = lambda w: any(map(str.isalpha, w)) and 3 * sum(map(str.isdigit, w)) <= len(w)
        found = [("w", k, n) for k, n in words.items() if len(k) > 2 and shaped(k)] + [("b", k, n) for k, n in pairs.items()] + [("l", k, n) for k, n in lines.items() if len(k) <= 6] + [("i", k, n) for k, n in inner.items()]
        return dict(zip(("kind", "key", "n"), map(list, zip(*found)))) if found else None

    counts = map_batches(df.select("text"), work, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    return cut(counts.where((F.col("kind") == "w") | (F.col("n") >= LEAST)))


def _specks(counts: DataFrame) -> Specks:
    """Short lines have six characters at most, and only tokens of such lines are asked for."""
    lines = counts.where("kind = 'l'")
    inner = counts.where("kind = 'i'").join(lines.select(F.explode(F.split("key", r"\s+")).alias("key")).distinct(), "key", "left_semi")
    rows = {k: {r.key: r.n for r in part.select("key", "n").collect()} for k, part in (("l", lines), ("i", inner))}
    return Specks(rows["l"], rows["i"])


def _least(form, n):
    """What a form must be exceeded by: other signs than letters make no word."""
    return F.when(form.rlike(r"^[\p{L}’'-]+$"), DOMINANCE * n).otherwise(n)


def _words(counts: DataFrame) -> DataFrame:
    """(skeleton, form, n, whole): the forms of the corpus; ``whole`` ones have letters only and may be meant by others."""

    def work(batch):
        forms = column(batch, "key")
        return {"skeleton": list(map(skeleton, forms)), "form": forms, "n": column(batch, "n"), "whole": [bool(LETTERS.match(w)) for w in forms]}

    return map_batches(counts.where("kind = 'w'").select("key", "n"), work, "skeleton string, form string, n long, whole boolean")


def _confusions(words: DataFrame) -> DataFrame:
    """(form, meant, n_meant): forms with the forms of their skeleton that exceed them many times."""
    meant = words.where(F.col("whole") & (F.col("n") >= LEAST)).select("skeleton", F.col("form").alias("meant"), F.col("n").alias("n_meant"))
    pairs = words.join(meant, "skeleton").where((F.col("form") != F.col("meant")) & (F.col("n_meant") >= _least(F.col("form"), F.col("n"))))
    # A word before an exclamation mark is no misread word if it is one without the mark.
    called = words.select(F.col("form").alias("called"), F.col("n").alias("n_called"))
    shouted = pairs.where("form LIKE '%!'").withColumn("called", F.rtrim("form", F.lit("!"))).join(called, "called", "left").where(F.col("n_called").isNull() | (F.col("n_meant") >= DOMINANCE * F.col("n_called")))
    cols = ("form", "meant", "n_meant")
    return pairs.where("NOT form LIKE '%!'").select(*cols).unionByName(shouted.select(*cols))


def _bitmap(forms: DataFrame) -> np.ndarray:
    """The bitmap of forms, ``BITS`` bits whatever their number; Spark joins it in blocks of 4 KB."""

    def places(batch):
        return {"p": [place(f) + 1 for f in column(batch, "form")]}  # Spark counts them from 1

    blocks = map_batches(forms.select("form"), places, "p long").groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in blocks.collect():
        bits = np.frombuffer(bytes(r.bits), dtype=np.uint8)
        out[(r.b - 1) * 4096 : (r.b - 1) * 4096 + len(bits)] |= bits
    return out


def _lower_bound(hits, n):
    """Wilson's lower bound of a share."""
    p = hits / n
    return (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def _templates(pages: DataFrame, specks) -> DataFrame:
    """(kind, mask, hits) over whole pages (doc, scan_no, page_no, text): header masks ``h`` and page-number masks ``n``."""

    def work(batch):
        found: dict[tuple, list[int]] = {}
        for doc, scan, text, page_no in zip(*(column(batch, c) for c in ("doc", "scan_no", "text", "page_no"))):
            lines = [b for b in (x.strip() for x in text.split("\n")) if b]
            for i, bare in enumerate(lines):
                edge = i < EDGE or i >= len(lines) - EDGE
                numbers = NUMBER.findall(bare) if len(bare) <= 16 else ()
                if numbers and numbers != [bare]:
                    c = found.setdefault(("n", NUMBER.sub("#", bare.lower()), doc, scan), [0, 0])
                    c[0] += 1
                    c[1] += edge and page_no is not None and str(page_no) in numbers
                clean = specks.value.without_specks(bare)
                if may_be_header(clean) and not PAGE.match(clean):
                    for k, mask in enumerate(masks(clean)):
                        if sum(c.isalpha() for c in mask.replace("<X>", "")) >= 6:
                            c = found.setdefault(("x" if k else "h", mask, doc, scan), [0, 0])
                            c[0] += 1
                            c[1] += edge
        rows = [(*key, *v) for key, v in found.items()]
        return dict(zip(("kind", "mask", "doc", "scan_no", "n", "hits"), map(list, zip(*rows)))) if rows else None

    schema = "kind string, mask string, doc string, scan_no int, n long, hits long"
    per_scan = map_batches(pages.select("doc", "scan_no", "text", "page_no"), work, schema).groupBy("kind", "mask", "doc", "scan_no").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    sizes = pages.groupBy("doc", "scan_no").agg(F.count("*").alias("n_pages"))
    own = F.col("doc").isNotNull() & (F.col("kind") == "h") & (F.col("hits") >= LEAST) & (2 * F.col("hits") >= F.col("n_pages"))
    # One row per scan, so nothing is exchanged again but the sums of a mask.
    rows = per_scan.join(sizes, ["doc", "scan_no"], "left").groupBy("kind", "mask").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max(F.coalesce(own, F.lit(False))).alias("own"), F.count("*").alias("n_scans")
    )
    number = F.col("kind") == "n"
    ratio = F.when(number, 0.5).otherwise(0.7)
    anywhere = (F.col("hits") >= LEAST) & (F.col("hits") >= ratio * F.col("n")) & (_lower_bound(F.col("hits"), F.col("n")) >= F.when(number, NUMBER_BOUND).otherwise(EDGE_BOUND)) & ((F.col("kind") != "x") | (F.col("n_scans") > 1))
    return cut(_without_idle_slots(rows.where(F.col("own") | anywhere).select(F.when(number, "n").otherwise("h").alias("kind"), "mask", "hits")))


def may_be_header(clean: str) -> bool:
    """Whether a line may be furniture by its looks: not like running text."""
    return len(clean) >= 8 and clean[-1] not in ".;:,?" and not clean[:1].islower() and sum(t[:1].islower() for t in clean.split()) <= 3


def _blocks(templates: DataFrame) -> list[tuple[list[str], list[str]]]:
    """The templates by blocks of bounded size: (headers, page numbers) each; one empty block if there are none."""
    size = templates.agg(F.sum(F.octet_length("mask") + 64).alias("b")).first().b or 0
    n = max(1, -(-size // TEMPLATE_BYTES))
    out = []
    for b in range(n):
        rows = templates.where(F.pmod(F.xxhash64("mask"), F.lit(n)) == b).orderBy(F.desc("hits"), "mask").collect()
        out.append(([r.mask for r in rows if r.kind == "h"], [r.mask for r in rows if r.kind == "n"]))
    return out


def _without_idle_slots(templates: DataFrame) -> DataFrame:
    """Drop masks with ``<X>`` most of whose lines have one wording, as that wording is a template itself."""
    slots = lambda m: F.transform(F.sequence(F.lit(0), F.size(m) - 1), lambda i: F.array_join(F.concat(F.slice(m, F.lit(1), i), F.array(F.lit("<X>")), F.slice(m, i + 2, F.size(m))), " "))
    pairs = lambda m: F.transform(F.sequence(F.lit(0), F.size(m) - 2), lambda i: F.array_join(F.concat(F.slice(m, F.lit(1), i), F.array(F.lit("<X>")), F.slice(m, i + 3, F.size(m))), " "))
    tokens = F.split("mask", " ")
    made = templates.where("kind = 'h' AND NOT mask LIKE '%<X>%'").select(F.explode(F.concat(slots(tokens), F.when(F.size(tokens) > 1, pairs(tokens)).otherwise(F.array().cast("array<string>")))).alias("mask"), F.col("hits").alias("worded"))
    most = made.groupBy("mask").agg(F.max("worded").alias("worded"))
    return templates.join(most, "mask", "left").where("worded IS NULL OR NOT mask LIKE '%<X>%' OR 2 * worded < hits").drop("worded")


def _within(a: str, b: str, most: int) -> int | None:
    """The edit distance of two short strings if it is at most ``most``."""
    if abs(len(a) - len(b)) > most:
        return None
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return None
    return row[-1] if row[-1] <= most else None


class Furniture:
    """Header and page-number templates."""

    def __init__(self, specks: Specks, headers: list[str], numbers: list[str]):
        self.specks, self.headers, self.numbers = specks, frozenset(headers), frozenset(numbers)
        # (text before the first name, text after the last): what of a template is compared with edits.
        self.ends = []
        self.kind = self._kind
        for h in headers:
            # Headers come by falling frequency: one that reads as a more frequent one is a misread header.
            if len(h) >= 10 and "<X>" not in h and self._reads_as_header(h):
                continue
            before, after = h.split("<X>")[0], h.split("<X>")[-1] if "<X>" in h else None
            # Two edits leave one of three parts of the template as it is.
            parts = sorted((x for x in (before, after) if x), key=len)
            longest = parts.pop()
            step = -(-len(longest) // (3 - len(parts)))
            parts += [longest[i : i + step] for i in range(0, len(longest), step)]
            self.ends.append((parts, before, after))
        self.kind = lru_cache(100_000)(self._kind)

    def _kind(self, bare: str) -> str | None:
        if len(bare) > 16 and sum(t[:1].islower() for t in bare.split()) > 4:
            return None  # running text
        clean = self.specks.without_specks(bare)
        for form in (bare, clean):
            if NUMBER.sub("#", form.lower()) in self.numbers or PAGE.match(form) and not (ROMAN.match(form) and form.isalpha()):
                return "page_number"
        if self.specks.is_speck(bare):
            return "speck"
        if may_be_header(clean) and any(m in self.headers for m in masks(clean)):
            return "header"
        # Running text that ends like a sentence, or starts in lower case, is not compared with edits.
        if len(clean) < 8 or clean[-1:] in ".;:," or clean[:1].islower() and clean[:2].islower() and " " not in clean[:10] or sum(t[:1].islower() for t in clean.split()) > 4:
            return None
        return "header" if self._reads_as_header(digits_masked(clean)) else None

    def _reads_as_header(self, low: str) -> bool:
        return any(any(p in low for p in parts) and self._alike(low, before, after) for parts, before, after in self.ends)

    @staticmethod
    def _alike(low: str, before: str, after: str | None) -> bool:
        """Whether a masked line reads as a template with at most two misread characters."""
        if after is None:
            d = _within(low, before, 2)
            return d is not None and len(before) >= 8
        if len(before) + len(after) < 10 or len(low) < len(before) + len(after):
            return False
        left = _end_within(low, before)
        right = _end_within(low[::-1], after[::-1])
        return left is not None and right is not None and left + right <= 2


def _end_within(text: str, start: str) -> int | None:
    """The least edit distance of ``start`` to a beginning of ``text`` if it is at most 2."""
    if not start or text.startswith(start):
        return 0
    found = [d for k in (-1, 0, 1) if (d := _within(text[: len(start) + k], start, 2)) is not None]
    return min(found, default=None)


class Reader:
    """Labels the lines of one text and finds what may be misread or broken."""

    def __init__(self, furniture: Furniture | None, suspects: np.ndarray):
        self.furniture = furniture
        self.suspect = lru_cache(200_000)(lambda w: len(w) > 2 and bool(suspects[(h := place(w)) >> 3] >> (h & 7) & 1))

    def label(self, text: str) -> list[tuple[int, str]]:
        return [(i, kind) for i, line in enumerate(text.split("\n")) if (bare := line.strip()) and (kind := self.furniture.kind(bare))]

    def read(self, text: str, furniture: list[tuple[int, str]]):
        """(lines, numbers of the running lines, suspects, broken ends).

        A suspect is (line, token, form, before, after, loose), a broken end (line, next line or None,
        first part, rest or None, word, before); its rest may be on the next page.
        """
        lines = text.split("\n")
        marked = {i for i, _ in furniture}
        running = [i for i, line in enumerate(lines) if i not in marked and line.strip()]
        suspects, broken, tail = [], [], False
        for at, i in enumerate(running):
            tokens = lines[i].split()
            skip, m = tail, BROKEN.search(lines[i]) if tokens[-1][-1] in BREAK else None
            follow = running[at + 1] if at + 1 < len(running) else None
            tail = bool(m)
            for k, t in enumerate(tokens):
                if k == 0 and skip or tail and k == len(tokens) - 1:
                    continue  # parts of broken words are judged together
                bare = t.strip(EDGE_PUNCT)
                low = bare.lower()
                if not self.suspect(low):
                    continue
                odd = any(not c.isalpha() for c in low)
                if not odd and not bare[0].islower() and k:
                    continue  # a name
                before = kind_of(tokens[k - 1]) if k else self._last(lines, running, at)
                after = kind_of(tokens[k + 1]) if k + 1 < len(tokens) else self._first(lines, running, at)
                suspects.append((i, bare, low, before, after, odd and bare[0].isupper()))
            if m:
                before = kind_of(tokens[-2]) if len(tokens) > 1 else "^"
                if follow is None:
                    broken.append((i, None, m.group(1), None, "", before))
                else:
                    rest = HEAD.match(lines[follow])
                    second = lines[follow].split()[0]
                    word = plain(tokens[-1].rstrip(BREAK + " ")) + second.lower().strip(EDGE_PUNCT)
                    broken.append((i, follow, m.group(1), rest.group(1) if rest else "", word, before))
        return lines, running, suspects, broken

    @staticmethod
    def _last(lines, running, at) -> str:
        return kind_of(lines[running[at - 1]].split()[-1]) if at else "^"

    @staticmethod
    def _first(lines, running, at) -> str:
        return kind_of(lines[running[at + 1]].split()[0]) if at + 1 < len(running) else "$"


KEY = ("tab", "rec_id")
READ = "tab string, rec_id long, line_no int, kind string, doc string, scan_no int, page_no int, next_line int, token string, form string, skeleton string, before string, after string, loose boolean, rest string"


class Analysis:
    """What a corpus (tab, rec_id, doc, scan_no, page_no, text) says about its lines.

    ``lines`` (tab, rec_id, line_no, kind) has every finding, ``fixes`` (tab, rec_id, line_no, token,
    meant) the misread words. Rows with a page number are pages of a scan; the others are texts of their own.
    """

    def __init__(self, df: DataFrame, pages: str = "scan_pages"):
        spark = df.sparkSession
        texts = df.where(F.col("text").isNotNull()).select(*KEY, "doc", "scan_no", "page_no", "text")
        counts = _counts(texts)
        specks = spark.sparkContext.broadcast(_specks(counts))
        words = cut(_words(counts))
        confusions = cut(_confusions(words))
        suspects = spark.sparkContext.broadcast(_bitmap(confusions))
        blocks = _blocks(_templates(texts.where(F.col("tab") == pages), specks))
        read = cut(self._read(texts, specks, suspects, blocks))
        verdicts = self._broken(read, words)
        misread = self._misread(read, verdicts, words, confusions, counts.where("kind = 'b'").select("key", "n"))
        furniture = read.where("kind IN ('header', 'page_number', 'speck')").select(*KEY, "line_no", "kind")
        hyphens = verdicts.select(*KEY, "line_no", F.lit("hyphen").alias("kind"))
        self.fixes = misread
        self.lines = reduce_union([furniture, hyphens, misread.select(*KEY, "line_no", F.lit("misread").alias("kind"))]).distinct()

    @staticmethod
    def _read(texts: DataFrame, specks, suspects, blocks) -> DataFrame:
        one = len(blocks) == 1
        if not one:
            # More templates than a block holds: each block labels all lines, the first kind by name counts.
            labels = reduce_union([_labelled(texts, specks, b) for b in blocks]).groupBy(*KEY, "line_no").agg(F.min("kind").alias("kind"))
            texts = texts.join(labels.groupBy(*KEY).agg(F.collect_list(F.struct("line_no", "kind")).alias("labels")), list(KEY), "left")
        else:
            texts = texts.withColumn("labels", F.lit(None).cast("array<struct<line_no:int,kind:string>>"))
        made: dict[str, Reader] = {}
        names = [c.split()[0] for c in READ.split(", ")]

        def work(batch):
            if not made:
                made["r"] = Reader(Furniture(specks.value, *blocks[0]) if one else None, suspects.value)
            reader, rows = made["r"], []
            for tab, rec, doc, scan, page, text, labels in zip(*(column(batch, c) for c in (*KEY, "doc", "scan_no", "page_no", "text", "labels"))):
                found = reader.label(text) if one else [(x["line_no"], x["kind"]) for x in labels or ()]
                lines, running, suspicious, broken = reader.read(text, found)
                rows += [(tab, rec, i, kind, *[None] * 11) for i, kind in found]
                rows += [(tab, rec, i, "_suspect", None, None, None, None, token, form, None, before, after, loose, None) for i, token, form, before, after, loose in suspicious]
                rows += [(tab, rec, i, "_broken", doc, scan, page, follow, first, word, skeleton(word), before, None, None, rest) for i, follow, first, rest, word, before in broken]
                if running and page is not None:
                    first = HEAD.match(lines[running[0]])
                    rows.append((tab, rec, running[0], "_head", doc, scan, page, None, None, None, None, None, None, None, first.group(1) if first else ""))
            return dict(zip(names, map(list, zip(*rows)))) if rows else None

        return map_batches(texts, work, READ)

    @staticmethod
    def _broken(read: DataFrame, words: DataFrame) -> DataFrame:
        """The broken ends whose word is joined without a mark."""
        turn = Window.partitionBy("tab", "doc", "scan_no").orderBy("page_no").rangeBetween(1, 1)
        over = F.first(F.when(F.col("kind") == "_head", F.col("rest")), ignorenulls=True).over(turn)
        paged = read.where("kind = '_head' OR kind = '_broken' AND next_line IS NULL AND page_no IS NOT NULL").withColumn("rest", F.when(F.col("kind") == "_head", F.col("rest")).otherwise(over)).where("kind = '_broken'")
        ends = paged.unionByName(read.where("kind = '_broken' AND (next_line IS NOT NULL OR page_no IS NULL)"))
        lower = lambda c: (c == F.lower(c)) & (c != F.upper(c))
        part, rest = F.col("token"), F.col("rest")
        decided = F.when(rest.isNull(), lower(part)).when((rest == "") | ~lower(F.left(rest, F.lit(1))) & (part != F.upper(part)), F.lit(False))
        ends = ends.withColumn("joins", decided)
        asked = ends.where("joins IS NULL").withColumns({"_h": F.lower(F.concat("token", F.lit("-"), "rest")), "_j": F.lower(F.concat("token", "rest"))})
        for c in ("_h", "_j"):
            asked = asked.join(words.select(F.col("form").alias(c), F.col("n").alias(f"n{c}")), c, "left")
        asked = asked.where(F.coalesce("n_h", F.lit(0)) <= F.coalesce("n_j", F.lit(0))).drop("_h", "_j", "n_h", "n_j")
        return ends.where("joins").unionByName(asked).drop("joins")

    @staticmethod
    def _misread(read: DataFrame, verdicts: DataFrame, words: DataFrame, confusions: DataFrame, pairs: DataFrame) -> DataFrame:
        """(tab, rec_id, line_no, token, meant): misread words with the frequent form that they stand for."""
        cols = (*KEY, "line_no", "token", "meant")
        asked = read.where("kind = '_suspect'").select(*KEY, "line_no", "token", "form", "before", "after", "loose").join(confusions, "form")
        # The frequent form and the form itself, each beside either neighbour.
        sides = lambda w: F.array(F.concat("before", F.lit(" "), w), F.concat(w, F.lit(" "), "after"))
        rows = asked.withColumn("k", F.explode(F.arrays_zip(sides(F.col("meant")).alias("g"), sides(F.col("form")).alias("f")))).select("*", F.col("k.g").alias("g"), F.col("k.f").alias("f")).drop("k")
        rows = rows.join(pairs.select(F.col("key").alias("g"), F.col("n").alias("n_g")), "g", "left").join(pairs.select(F.col("key").alias("f"), F.col("n").alias("n_f")), "f", "left")
        supported = F.coalesce((F.col("n_g") >= _least(F.col("form"), F.coalesce("n_f", F.lit(0)))), F.lit(False))
        best = lambda df: df.groupBy(*KEY, "line_no", "token").agg(F.max_by("meant", F.struct("n_meant", "meant")).alias("meant"))
        plain_ones = best(rows.where(supported | F.col("loose")))
        # Broken words are judged whole; where the first part agrees, the second one is misread.
        whole = verdicts.where("next_line IS NOT NULL AND length(form) > 4")
        whole = whole.join(words.select("form", F.col("n").alias("n_own")), "form", "left")
        meant = words.where(F.col("whole") & (F.col("n") >= LEAST)).select("skeleton", F.col("form").alias("meant"), F.col("n").alias("n_meant"))
        whole = whole.join(meant, "skeleton").where((F.col("form") != F.col("meant")) & (F.col("n_meant") >= _least(F.col("form"), F.coalesce("n_own", F.lit(1)))))
        whole = whole.groupBy(*KEY, "line_no", "next_line", "token", "form").agg(F.max_by("meant", F.struct("n_meant", "meant")).alias("meant"))
        first = F.lower("token") != F.left("meant", F.char_length("token"))
        return plain_ones.select(*cols).unionByName(whole.withColumn("line_no", F.when(first, F.col("line_no")).otherwise(F.col("next_line"))).withColumn("token", F.lit(None).cast("string")).select(*cols))


def _labelled(texts: DataFrame, specks, block) -> DataFrame:
    made: dict[str, Reader] = {}

    def work(batch):
        if not made:
            made["r"] = Reader(Furniture(specks.value, *block), np.zeros(BITS // 8, dtype=np.uint8))
        rows = [(tab, rec, i, kind) for tab, rec, text in zip(*(column(batch, c) for c in (*KEY, "text"))) for i, kind in made["r"].label(text)]
        return dict(zip(("tab", "rec_id", "line_no", "kind"), map(list, zip(*rows)))) if rows else None

    return map_batches(texts, work, "tab string, rec_id long, line_no int, kind string")


def reduce_union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def noise(df: DataFrame) -> DataFrame:
    """(tab, rec_id, line_no, kind) of df (tab, rec_id, doc, scan_no, page_no, text)."""
    return Analysis(df).lines


LABEL = r"^\s*(?:\((?:[a-z]{1,4}|\d+)\)|(?:[a-z]|[ivx]+|\d+)[.)]|•)\s"


def paragraphs(df: DataFrame) -> DataFrame:
    """(tab, rec_id, par_no, paragraph): the repaired running text of every scan and of every other text, in paragraphs.

    Windows over the lines of a scan, or of a text that is no page, number the paragraphs: furniture is
    dropped, misread words are replaced, broken words joined across lines and pages. A paragraph starts at
    an enumeration label, or behind a blank line if what stands before it ends like a sentence. It belongs
    to the record in which it begins.
    """
    found = Analysis(df)
    per_line = found.lines.groupBy(*KEY, "line_no").agg(F.collect_set("kind").alias("kinds"))
    put = F.when(F.left("token", F.lit(1)) == F.upper(F.left("token", F.lit(1))), F.initcap("meant")).otherwise(F.col("meant"))
    fixes = found.fixes.where("token IS NOT NULL").groupBy(*KEY, "line_no").agg(F.collect_list(F.struct("token", put.alias("put"))).alias("fixes"))
    lines = df.where(F.col("text").isNotNull()).select(*KEY, "doc", "scan_no", "page_no", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.join(per_line, [*KEY, "line_no"], "left").join(fixes, [*KEY, "line_no"], "left")
    repaired = F.aggregate(F.coalesce("fixes", F.array().cast("array<struct<token:string,put:string>>")), F.trim(F.regexp_replace("line", r"^\s+|\s+$", "")), lambda acc, x: F.replace(acc, x["token"], x["put"]))
    is_page = F.col("page_no").isNotNull()
    lines = lines.select(
        *KEY, "line_no", F.when(is_page, F.concat_ws("\t", "doc", "scan_no")).otherwise(F.concat(F.lit("\t"), "rec_id")).alias("of"), F.coalesce("page_no", F.lit(0)).alias("page_no"), repaired.alias("line"),
        F.coalesce(F.array_contains("kinds", "hyphen"), F.lit(False)).alias("joins"), F.coalesce(F.arrays_overlap("kinds", F.array(*map(F.lit, ("header", "page_number", "speck")))), F.lit(False)).alias("furniture"),
    )
    w = Window.partitionBy("tab", "of").orderBy("page_no", "rec_id", "line_no")
    lines = lines.withColumn("blanks", F.sum((F.col("line") == "").cast("int")).over(w)).where("NOT furniture AND line <> ''")
    lines = lines.withColumns({"before": F.lag("line").over(w), "joined": F.coalesce(F.lag("joins").over(w), F.lit(False)), "gap": F.col("blanks") > F.lag("blanks").over(w)})
    starts = F.col("before").isNull() | ~F.col("joined") & (F.col("gap") & F.col("before").rlike(r"(?:[.:;?!”)]| and)$") | F.col("line").rlike(LABEL))
    lines = lines.withColumn("par_no", F.sum(starts.cast("int")).over(w) - 1)
    piece = F.concat(F.when(F.col("joined") | starts, "").otherwise(" "), F.when(F.col("joins"), F.regexp_replace("line", rf"[{BREAK}\s]+$", "")).otherwise(F.col("line")))
    at = F.struct("page_no", "rec_id", "line_no")
    return lines.groupBy("tab", "of", "par_no").agg(F.min_by("rec_id", at).alias("rec_id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), piece.alias("p")))), lambda x: x["p"]), "").alias("paragraph")).select("tab", "rec_id", "par_no", "paragraph")
