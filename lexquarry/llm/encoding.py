"""Text garbled by a wrong character decoding: find the records and restore what can be restored.

Every distinct clean form of the corpus is garbled under every chain of wrong decodings, and the
garbled forms are hash-joined with the forms that the records hold. There are four kinds of forms:

* ``w``: a word with a character beyond ASCII, digits masked, whole however long it is;
* ``r``: a run of such characters with the kinds of its two neighbours;
* ``c``: a single character, of the corpus or of the alphabets in ``ALPHABETS``, so that a garbled
  text is found even where nothing else of its kind is in the corpus;
* ``g``: neighbouring characters that make six bytes, two of three bytes or three of two, which wrong
  East Asian decodings (two bytes a character) turn into three; they are looked for at every place
  inside clean text.

What a decodable run was meant as counts as a form of the corpus, too: some words occur garbled only.
A match of ``w`` or ``r`` counts if the original is at least as frequent as the garbled form (for runs,
``RUN_RATIO`` times). Forms are counted over the distinct texts of all records, so that copies of a
garbled text do not outvote the originals; every copy is judged by that. A match of ``c`` is checked
exactly: the run that holds it must decode backwards as a whole. Forms of ``c`` and ``g`` go to the join
only if a bitmap of fixed size (``BITS``), built from all garbled forms, has them. Replacement
characters and C1 controls are garbling by themselves, even where the original is lost.

Defined results: null and empty texts are clean; foreign text is clean; repeated rows are judged
alike; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.session import cut

#: Decodings that were wrongly applied: to UTF-8 bytes, and to bytes of the Western code page.
WRONG_FOR_UTF8 = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "cp1254", "iso8859_15", "gb18030", "cp932", "big5", "cp949")
WRONG_FOR_CP1252 = ("latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866")
WIDE_CODECS = frozenset(("gb18030", "cp932", "big5", "cp949"))
RUN_RATIO = 20
NATIVE = "؀-ۿऀ-ॿ฀-๿぀-ヿ㐀-鿿"
#: Marks that clean text of any script uses.
WIDE_MARKS = "　-〿！-～"
LOST = re.compile("[�\x80-\x9f]")
RUN = re.compile(rf"[^\x00-\x7f{NATIVE}{WIDE_MARKS}]+")
#: Native characters inside a Latin word: clean text sets them beside numbers and codes only.
MIXED = re.compile(r"(?:(?<=[a-zñ])[぀-ヿ㐀-鿿｡-ﾟ]+|[㐀-鿿]+(?=[a-z]{2}))")
#: Alphabets whose single characters are garbled whether or not the corpus has them.
ALPHABETS = ((0xA1, 0x180), (0x600, 0x700), (0x900, 0x980), (0xE00, 0xE80), (0x2010, 0x2045), (0x20A0, 0x20C0), (0x2200, 0x2210), (0x3000, 0x3100), (0x4E00, 0xA000), (0xFF00, 0xFFF0))
#: Size of the bitmap of garbled forms, and the longest garbled form of one character.
BITS, LONGEST = 1 << 24, 9
DIGITS = re.compile(r"[0-9][0-9.,]*")
CLEAN_SCRIPTS = re.compile(rf"[\x00-\x7f -ɏ{NATIVE}{WIDE_MARKS}‐-₿ḀỲ-ỿ︀-️﷼-﷽]+")


def to_bytes(text: str, codec: str) -> bytes | None:
    """The bytes that ``codec`` decodes to ``text``; code points it leaves undefined stand for themselves."""
    try:
        return text.encode(codec)
    except UnicodeEncodeError:
        out = bytearray()
        for c in text:
            try:
                out += c.encode(codec)
            except UnicodeEncodeError:
                if not 0x80 <= ord(c) <= 0xA0:
                    return None
                out.append(ord(c))
        return bytes(out)


def garble(text: str, right: str, wrong: str) -> str | None:
    """``text`` in encoding ``right``, decoded as ``wrong``; undefined bytes stand for themselves."""
    try:
        data = text.encode(right)
    except UnicodeEncodeError:
        return None
    try:
        return data.decode(wrong)
    except UnicodeDecodeError:
        if wrong not in WRONG_FOR_CP1252 and wrong not in ("cp1252", "cp1254", "iso8859_15"):
            return data.decode(wrong, "replace")
        return "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in data)


def garbled_forms(text: str) -> dict[str, str]:
    """Garbled form -> chain, for all chains that change ``text``; twice garbled forms included."""
    forms: dict[str, str] = {}
    for right, wrongs in (("utf-8", WRONG_FOR_UTF8), ("cp1252", WRONG_FOR_CP1252)):
        for wrong in wrongs:
            once = garble(text, right, wrong)
            if once and once != text:
                forms.setdefault(once, f"{right}>{wrong}")
                if wrong in ("cp1252", "latin-1"):
                    twice = garble(once, "utf-8", wrong)
                    if twice and twice != once:
                        forms.setdefault(twice, f"{right}>{wrong}>{wrong}")
    return forms


def _decoded(data: bytes) -> str | None:
    """Valid UTF-8 but for a cut character at either end, as text."""
    a = 0
    while a < 3 and a < len(data) and 0x80 <= data[a] < 0xC0:
        a += 1
    for b in range(len(data), max(len(data) - 4, a), -1):
        try:
            return data[a:b].decode("utf-8")
        except UnicodeDecodeError:
            continue
    return None


@lru_cache(100_000)
def ungarbled(run: str, whole: bool = False) -> str | None:
    """The original of a run of garbled characters, or None if no chain gives one.

    Chains that decode every byte come first; unless ``whole``, others may lose a cut character at
    either end.
    """
    for lossless in (True,) if whole else (True, False):
        for wrong in WRONG_FOR_UTF8:
            data = to_bytes(run, wrong)
            if data is None or len(data) < 2 or not any(0xC2 <= x <= 0xF4 for x in data[:4]):
                continue
            text = _decoded(data)
            if not text or text == run or text.isascii() or not CLEAN_SCRIPTS.fullmatch(text):
                continue
            size = len(text.encode("utf-8"))
            if lossless and size != len(data):
                continue
            # By chance a few bytes of East Asian text are valid; hardly ever are most bytes of a run.
            if wrong in WIDE_CODECS and not whole and (len(text) < 3 or size + 4 < len(data)):
                continue
            again = ungarbled(text, True) if any(0x80 <= ord(c) < 0x2200 for c in text) and len(text) > 1 else None
            return again or text
    return None


@lru_cache(50_000)
def ungarbled_widths(run: str) -> tuple[tuple[str, int], ...] | None:
    """The original characters of a run, each with the number of stored characters it takes.

    Only for codecs with one byte a character; None if no such chain fits the run.
    """
    for lossless in (True, False) if len(run) >= 4 else (True,):
        for wrong in WRONG_FOR_UTF8:
            data = None if wrong in WIDE_CODECS else to_bytes(run, wrong)
            if data is None or not any(0xC2 <= x <= 0xF4 for x in data[:4]):
                continue
            text = _decoded(data)
            if not text or text.isascii() or text == run or not CLEAN_SCRIPTS.fullmatch(text):
                continue
            size = len(text.encode("utf-8"))
            if lossless and size != len(data):
                continue
            front = next(i for i in range(4) if data[i : i + size] == text.encode("utf-8"))
            out = [(c, 1) for c in run[:front]] + [(c, len(c.encode("utf-8"))) for c in text] + [(c, 1) for c in run[front + size :]]
            again = ungarbled_widths(text) if size == len(data) and len(text) > 1 and RUN.fullmatch(text) else None
            if again:
                widths, at = [], 0
                for c, n in again:
                    widths.append((c, sum(w for _, w in out[at : at + n])))
                    at += n
                out = widths
            return tuple(out)
    return None


def decoded_view(text: str) -> tuple[str, list[int]] | None:
    """(text as it was meant, stored position of each of its characters and of the end); None if it is clean."""
    view: list[str] = []
    starts: list[int] = []
    last = 0
    for m in RUN.finditer(text):
        got = ungarbled_widths(m.group()) if len(m.group()) > 1 else None
        if got is None:
            continue
        view.append(text[last : m.start()])
        starts += range(last, m.start())
        at = m.start()
        for c, n in got:
            view.append(c)
            starts.append(at)
            at += n
        last = m.end()
    if not view:
        return None
    view.append(text[last:])
    starts += range(last, len(text) + 1)
    return "".join(view), starts


def _kind(c: str) -> str:
    return " " if not c or c.isspace() else "9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "." if c.isascii() else "x"


def forms_of(text: str) -> set[str]:
    """The words and runs of a text beyond ASCII, whatever their length."""
    forms: set[str] = set()
    for m in BEYOND.finditer(text):
        word = DIGITS.sub("9", m.group()).strip(EDGES)
        # Scripts without blanks have no words; their characters go as ``c`` and ``g``.
        if word and "�" not in word and not word.isascii() and (not NO_BLANKS.search(word) or MIXED.search(word)):
            forms.add("w" + word)
    for pattern in (RUN, MIXED):
        for m in pattern.finditer(text):
            run, a, b = m.group(), m.start(), m.end()
            if "�" not in run:
                forms.add(f"r{_kind(text[a - 1 : a])}{_kind(text[b : b + 1])}{run}")
    return forms


def meant_forms(text: str) -> set[str]:
    """The words and runs that decodable runs of a text were meant as, but for scripts without blanks, which have no words."""
    forms: set[str] = set()
    done = 0
    for m in TWO.finditer(text):
        meant = ungarbled(m.group(), len(m.group()) < 4)
        if not meant or NO_BLANKS.search(meant):
            continue
        a, b = m.start(), m.end()
        forms.add(f"r{_kind(text[a - 1 : a])}{_kind(text[b : b + 1])}{meant}")
        if a < done:
            continue  # in the word of the run before
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        whole = TWO.sub(lambda r: ungarbled(r.group(), len(r.group()) < 4) or r.group(), text[a:b])
        whole = DIGITS.sub("9", whole).strip(EDGES)
        if whole and not whole.isascii() and not NO_BLANKS.search(whole):
            forms.add("w" + whole)
    return forms


#: A run of two characters or more.
TWO = re.compile(rf"[^\x00-\x7f{NATIVE}{WIDE_MARKS}]{{2,}}")
#: A word that holds a character beyond ASCII, and the scripts without blanks.
BEYOND = re.compile(r"[^\s]*[^\x00-\x7f\s][^\s]*")
NO_BLANKS = re.compile(f"[฀-๿぀-ヿ㐀-鿿{WIDE_MARKS}]")
EDGES = ".,;:?!()[]\"'/"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def place(form: str) -> int:
    """The place of a form in the bitmap."""
    h = 0
    for c in form:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & 0xFFFFFFFFFFFFFFFF
    return h >> 40


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def six_bytes_of(text: str) -> np.ndarray:
    """The neighbouring characters that make six bytes in UTF-8, each group as one number."""
    p = points_of(text).astype(np.uint64)
    three, two = (p >= 0x800) & (p < 0x10000) & (p != 0xFFFD), (p >= 0xA0) & (p < 0x800)
    at = np.flatnonzero(three[:-1] & three[1:])
    pairs = p[at] << np.uint64(21) | p[at + 1]
    at = np.flatnonzero(two[:-2] & two[1:-1] & two[2:])
    return np.unique(np.concatenate([pairs, p[at] << np.uint64(42) | p[at + 1] << np.uint64(21) | p[at + 2]]))


def characters(number: int) -> str:
    """The characters of one such number."""
    return "".join(chr(c) for c in (number >> 42, number >> 21 & 0x1FFFFF, number & 0x1FFFFF) if c)


def native_triples(text: str, bitmap: np.ndarray) -> set[str]:
    """The triples of East Asian characters that the bitmap has."""
    p = points_of(text).astype(np.uint64)
    if len(p) < 3:
        return set()
    east = (p >= 0x2E80) & (p < 0x10000) & (p != 0xFFFD)
    at = np.flatnonzero(east[:-2] & east[1:-1] & east[2:])
    h = ((p[at] * FACTOR + p[at + 1]) * FACTOR + p[at + 2]) >> np.uint64(40)
    hit = at[(bitmap[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return {text[i : i + 3] for i in hit.tolist()}


def run_pieces(text: str, bitmap: np.ndarray) -> set[str]:
    """The pieces of runs that decode backwards which the bitmap has."""
    found: set[str] = set()
    for pattern in (RUN, MIXED):
        for m in pattern.finditer(text):
            run = m.group()
            if (len(run) > 1 or pattern is MIXED) and ungarbled(run, len(run) < 4 or pattern is MIXED):
                for i in range(len(run)):
                    for n in range(1 if pattern is MIXED else 2, min(LONGEST, len(run) - i) + 1):
                        h = place(run[i : i + n])
                        if bitmap[h >> 3] >> (h & 7) & 1:
                            found.add(run[i : i + n])
    return found


def _held(df: DataFrame) -> DataFrame:
    """(tab, rec_id, field, hash, form): the words and runs of each record and the hash of its text; a null form marks loss.

    Rows without a record are what decodable runs were meant as, and the characters (``c``) and groups (``g``) of a
    task's texts, each once.
    """

    def work(batch):
        out = {"tab": [], "rec_id": [], "field": [], "hash": [], "form": []}
        singles: set[str] = set()
        groups = []
        for tab, rec, field, hashed, text in zip(*(column(batch, c) for c in ("tab", "rec_id", "field", "hash", "text"))):
            if text.isascii():
                continue
            held = [*forms_of(text), *([None] if LOST.search(text) else [])]
            singles.update(text)
            groups.append(six_bytes_of(text))
            meant = meant_forms(text)
            for name, values in (("tab", [tab] * len(held)), ("rec_id", [rec] * len(held)), ("field", [field] * len(held)), ("hash", [hashed] * len(held)), ("form", held)):
                out[name] += values
            for name, values in (("tab", [None] * len(meant)), ("rec_id", [None] * len(meant)), ("field", [None] * len(meant)), ("hash", [hashed] * len(meant)), ("form", list(meant))):
                out[name] += values
        vocabulary = ["c" + c for c in singles if not c.isascii() and not LOST.match(c)]
        if groups:
            vocabulary += ["g" + characters(g) for g in np.unique(np.concatenate(groups)).tolist()]
        for name in ("tab", "rec_id", "field", "hash"):
            out[name] += [None] * len(vocabulary)
        out["form"] += vocabulary
        return out

    rows = df.where(F.col("text").isNotNull()).select("tab", "rec_id", "field", F.xxhash64("text").alias("hash"), "text")
    return map_batches(rows, work, "tab string, rec_id long, field string, hash long, form string")


def _forward(counts: DataFrame, held=None) -> DataFrame:
    """(form, original, n_original): every garbled form of the forms of the corpus (form, n).

    ``held`` is the broadcast bitmap of the forms that records hold: garbled forms that no record has
    need not travel to the join.
    """

    def work(batch):
        out = {"form": [], "original": [], "n_original": []}
        for form, n in zip(column(batch, "form"), column(batch, "n")):
            head, text = (form[:3], form[3:]) if form[0] == "r" else (form[0], form[1:])
            if head == "c" and ord(text) >= 0x3400:
                bad = {b for w in WRONG_FOR_UTF8 if w not in WIDE_CODECS and (b := garble(text, "utf-8", w))}
            elif head == "c":
                bad = {b for b in garbled_forms(text) if len(b) > 1 or ord(b) >= 0x2E80}
            elif head == "g":
                bad = {b for w in WIDE_CODECS if (b := garble(text, "utf-8", w)) and len(b) == 3 and all(ord(c) >= 0x2E80 for c in b)}
            elif any(len(m.group()) > 1 and ungarbled(m.group(), True) for m in RUN.finditer(text)):
                continue  # garbled itself, so no original
            else:
                bad = garbled_forms(text)
            for b in bad:
                if head in "cg" and ("�" in b or b.isascii()):
                    continue
                if held is not None:
                    h = form_place(head + b)
                    if not held.value[h >> 3] >> (h & 7) & 1:
                        continue
                for name, value in zip(out, (("c" if head == "g" else head) + b, form, n)):
                    out[name].append(value)
        return out

    return map_batches(counts.where("NOT form RLIKE '[\\\\x{80}-\\\\x{9f}\\\\x{fffd}]'"), work, "form string, original string, n_original long")


def form_place(form: str) -> int:
    """The place of a word or a run in the bitmap."""
    return xxhash.xxh32_intdigest(form) & (BITS - 1)


def _bitmap(forms: DataFrame, place=form_place) -> np.ndarray:
    """A bitmap of forms: ``BITS`` bits, whatever their number.

    Spark joins the bits in blocks of 4 KB, so the driver gets at most ``BITS / 8`` bytes.
    """

    def places(batch):
        return {"p": [place(f) + 1 for f in column(batch, "form")]}  # Spark counts them from 1

    blocks = map_batches(forms.select("form"), places, "p long").groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in blocks.collect():
        at = (r.b - 1) * 4096
        bits = np.frombuffer(bytes(r.bits), dtype=np.uint8)
        out[at : at + len(bits)] |= bits
    return out


def _alphabets(spark) -> DataFrame:
    """(form): the single characters of ``ALPHABETS``."""
    inside = F.lit(False)
    for a, b in ALPHABETS:
        inside = inside | F.col("id").between(a, b - 1)
    every = spark.range(ALPHABETS[0][0], ALPHABETS[-1][1], 1, 4).where(inside)
    hexed = F.lpad(F.hex("id"), 8, "0")
    return every.select(F.concat(F.lit("c"), F.decode(F.unhex(hexed), "UTF-32")).alias("form"))


def garbled(df: DataFrame) -> DataFrame:
    """(tab, rec_id, field, fixes): the garbled records of df (tab, rec_id, field, text).

    ``fixes`` lists the record's verified (form, original) pairs.
    """
    spark, key = df.sparkSession, ("tab", "rec_id", "field")
    held = cut(_held(df))
    records = held.where("tab IS NOT NULL")
    counts = held.where("form IS NOT NULL AND hash IS NOT NULL").groupBy("form").agg(F.count_distinct("hash").alias("n"))
    letters = held.where("hash IS NULL").select("form").unionByName(_alphabets(spark)).distinct().withColumn("n", F.lit(1).cast("long"))
    # Forms are spread by their hash: a few forms make many.
    spread = lambda x: x.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "form")
    counts = cut(spread(counts))
    forward = _forward(counts, spark.sparkContext.broadcast(_bitmap(counts)))
    # One original per garbled form: the most frequent.
    best = forward.groupBy("form").agg(F.max_by("original", F.struct("n_original", "original")).alias("original"), F.max("n_original").alias("n_original"))
    least = F.when(F.col("form").startswith("r"), F.lit(RUN_RATIO)).otherwise(1)
    table = counts.join(best, "form").where(F.col("n_original") >= least * F.col("n")).select("form", "original")
    hits = records.join(table, "form").select(*key, F.struct("form", "original").alias("fix"))
    lost = records.where("form IS NULL").select(*key, F.lit(None).cast(hits.schema["fix"].dataType).alias("fix"))
    letter_table = cut(_forward(spread(letters)).groupBy("form").agg(F.min("original").alias("original")))
    bitmap = spark.sparkContext.broadcast(_bitmap(letter_table, lambda f: place(f[1:])))

    def pieces(batch):
        out = {"tab": [], "rec_id": [], "field": [], "form": []}
        for tab, rec, field, text in zip(*(column(batch, c) for c in ("tab", "rec_id", "field", "text"))):
            got = run_pieces(text, bitmap.value) | native_triples(text, bitmap.value)
            for name, values in (("tab", [tab] * len(got)), ("rec_id", [rec] * len(got)), ("field", [field] * len(got)), ("form", ["c" + g for g in got])):
                out[name] += values
        return out

    # Only texts with two neighbours beyond ASCII, or an East Asian character, can hold such a piece.
    rows = df.where(F.col("text").rlike(r"[^\x00-\x7f](?:[^\x00-\x7f]|(?<=[\x{2e80}-\x{ffef}]))")).select(*key, "text")
    found = map_batches(rows, pieces, "tab string, rec_id long, field string, form string").join(letter_table, "form").select(*key, F.struct("form", "original").alias("fix"))
    # A record holds few distinct forms, so the list per record is short.
    return hits.unionByName(lost).unionByName(found).groupBy(*key).agg(F.collect_set("fix").alias("fixes"), F.max(F.col("fix").isNull()).alias("lost")).drop("lost")


def native_region(text: str, at: int, size: int) -> tuple[int, int, str] | None:
    """The longest decodable stretch around a garbled piece inside East Asian text: (start, end, original).

    It grows from the piece to both sides as long as the bytes are UTF-8 but for a cut character at either end.
    """
    for wrong in ("gb18030", "cp932", "big5", "cp949"):
        a, b = at, at + size
        if ungarbled_by(text[a:b], wrong) is None:
            continue
        while b < len(text) and not text[b].isspace() and ungarbled_by(text[a : b + 1], wrong) is not None:
            b += 1
        while a > 0 and not text[a - 1].isspace() and ungarbled_by(text[a - 1 : b], wrong) is not None:
            a -= 1
        # A clean character at either end may pass for a cut one: without it all bytes are used.
        for x, y in ((a, b), (a, b - 1), (a + 1, b), (a + 1, b - 1)):
            got = ungarbled_by(text[x:y], wrong) if y > x else None
            if got is not None and len(got.encode()) == len(to_bytes(text[x:y], wrong)):
                return x, y, got
        return a, b, ungarbled_by(text[a:b], wrong)
    return None


def ungarbled_by(run: str, wrong: str) -> str | None:
    data = to_bytes(run, wrong)
    text = _decoded(data) if data else None
    ok = text and not text.isascii() and text != run and CLEAN_SCRIPTS.fullmatch(text) and len(text.encode()) + 4 >= len(data)
    return text if ok else None


def restore(text: str, fixes: list[tuple[str, str]]) -> str:
    """The text with the verified originals in place of garbled forms; the rest unchanged.

    Runs with a verified piece are decoded by the chain that fits the whole run.
    """
    pieces = {form[1:] for form, _ in fixes if form[0] == "c"}

    def run(m: re.Match) -> str:
        whole = m.group()
        if not any(p in whole for p in pieces):
            return whole
        return ungarbled(whole, len(whole) < 4 or m.re is MIXED) or whole

    for form, original in sorted(fixes, key=lambda f: (f[0][0] != "w", -len(f[0]))):
        if form[0] == "w":
            # Masked digits are those of the text.
            numbers = r"([0-9][0-9.,]*)"
            pattern = numbers.join(re.escape(x) for x in form[1:].split("9"))

            def put(m: re.Match, parts=original[1:].split("9")) -> str:
                return "".join(p + (m[i + 1] if i < len(parts) - 1 else "") for i, p in enumerate(parts)) if len(parts) - 1 == m.re.groups else m.group()

            text = re.sub(rf"(?<![\w{RAW}]){pattern}(?![\w{RAW}])", put, text)
        elif form[0] == "r":
            left, right, bad = form[1], form[2], form[3:]
            text = re.sub(
                re.escape(bad), lambda m: original[3:] if (_kind(m.string[m.start() - 1 : m.start()]), _kind(m.string[m.end() : m.end() + 1])) == (left, right) else m.group(), text
            )
    if not pieces:
        return text
    text = RUN.sub(run, MIXED.sub(run, text))
    for piece in sorted(p for p in pieces if len(p) == 3 and all(ord(c) >= 0x2E80 for c in p)):
        at = text.find(piece)
        while at >= 0:
            region = native_region(text, at, len(piece))
            if region is None:
                at = text.find(piece, at + 1)
                continue
            a, b, original = region
            text = text[:a] + original + text[b:]
            at = text.find(piece, a + len(original))
    return text


#: Characters that belong to a garbled word as letters do.
RAW = "\x80-ÿ–-™Œ-ƒˆ˜"


def restored(df: DataFrame) -> DataFrame:
    """(tab, rec_id, field, restored): the garbled records with their text restored where possible."""
    found = garbled(df)

    def work(batch):
        out = {"tab": [], "rec_id": [], "field": [], "restored": []}
        for tab, rec, field, text, fixes in zip(*(column(batch, c) for c in ("tab", "rec_id", "field", "text", "fixes"))):
            fixed = restore(text, [(f["form"], f["original"]) for f in fixes if f])
            for name, value in zip(out, (tab, rec, field, fixed)):
                out[name].append(value)
        return out

    rows = df.select("tab", "rec_id", "field", "text").join(found, ["tab", "rec_id", "field"])
    return map_batches(rows, work, "tab string, rec_id long, field string, restored string")
