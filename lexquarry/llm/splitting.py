"""Cut oversized texts into pieces at natural boundaries, with a fixed overlap.

The ends of the pieces are chosen by dynamic programming over the boundary positions of the text.
The cost of a split is the sum of the penalties of its cuts (by kind: paragraph, sentence, clause,
word, none), of the squared deviation of each piece from the ideal size, and of a charge per piece.
No piece is longer than the limit and every piece but the first begins exactly ``overlap``
characters before the end of the one before it. Clauses, words and single characters are offered as
cuts only inside stretches in which no coarser boundary would keep a piece under the limit, so the
program stays small however long the text is.

Defined results: texts not longer than the limit are one piece; null texts give no piece and empty
texts one empty piece; a text without any boundary is cut between characters, but not before a combining
mark; repeated rows are split alike; a table without a limit, or with one below 1, gives no pieces; an
overlap below 0 is none, one that is not smaller than the limit is one less than it; extra columns are dropped.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.llm.sentences import sentence_spans

#: Penalties of a cut by kind.
PARAGRAPH, SENTENCE, CLAUSE, WORD, NONE = 0.0, 1.0, 4.0, 16.0, 64.0
PER_PIECE = 2.0
BLANK_LINE = re.compile(r"\n[^\S\n]*\n")
CLAUSES = re.compile(r"[,;:—、，；：،؛](?=\s|[^\x00-\x7f])")
WORDS = re.compile(r"\S(?=\s)")


def boundaries(text: str, first: int, step: int) -> list[tuple[int, float]]:
    """(position, penalty) of the cuts offered, ascending; the end of the text is the last, free."""
    size = len(text)
    cuts: dict[int, float] = {}
    for _, end in sentence_spans(text):
        cuts[end] = PARAGRAPH if BLANK_LINE.match(text, end) else SENTENCE
    cuts[size] = 0.0
    at, room = 0, first
    for end in sorted(cuts):
        if end - at > room:
            _fill(text, at, end, step, cuts)
        at, room = end, step
    return sorted(cuts.items())


def _fill(text: str, at: int, end: int, step: int, cuts: dict[int, float]) -> None:
    """Offer finer cuts between two boundaries that lie too far apart."""
    for pattern, penalty in ((CLAUSES, CLAUSE), (WORDS, WORD)):
        for m in pattern.finditer(text, at + 1, end):
            cuts.setdefault(m.end(), penalty)
    last = at
    for p in sorted(x for x in cuts if at < x <= end):
        if p - last > step:
            # No blank for a whole piece: single characters, evenly.
            parts = -(-(p - last) // max(1, step // 2))
            for i in range(1, parts):
                cuts.setdefault(_between(text, last + i * (p - last) // parts, last, min(p, last + step)), NONE)
        last = p


def _between(text: str, at: int, low: int, high: int) -> int:
    """The next place from ``at`` on that tears no combined character, else the last before it; ``at`` if there is none."""
    torn = lambda i: unicodedata.category(text[i])[0] == "M" or text[i] == "\u200d" or text[i - 1] == "\u200d"
    up = at
    while up < high and up < len(text) and torn(up):
        up += 1
    if up < high or up == len(text):
        return up
    down = at
    while down > low + 1 and torn(down):
        down -= 1
    return down if not torn(down) else at


def split_spans(text: str | None, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece of ``text``."""
    if text is None:
        return []
    if not 0 <= overlap < limit:
        raise ValueError(f"the overlap {overlap} must be smaller than the limit {limit}")
    size = len(text)
    if size <= limit:
        return [(0, size)]
    step = limit - overlap
    pieces = -(-(size - overlap) // step)
    ideal = (size - overlap) / pieces
    offered = [(0, 0.0), *boundaries(text, limit, step)]
    place = [p for p, _ in offered]
    best = [0.0] + [float("inf")] * (len(offered) - 1)
    back = [0] * len(offered)
    low = 1
    for i in range(1, len(offered)):
        end, penalty = offered[i]
        while low < i and end - place[low] > step:
            low += 1
        options = range(low, i) if end > limit else [0, *range(low, i)]
        for j in options:
            grown = end - place[j] - (0 if j else overlap)
            cost = best[j] + (grown / ideal - 1.0) ** 2
            if cost < best[i]:
                best[i], back[i] = cost, j
        best[i] += penalty + PER_PIECE
    spans, i = [], len(offered) - 1
    while i:
        j = back[i]
        spans.append((max(0, place[j] - overlap) if j else 0, place[i]))
        i = j
    return spans[::-1]


def split_rows(df: DataFrame) -> DataFrame:
    """(tab, rec_id, piece_no, start_pos, end_pos, piece) from df (tab, rec_id, text, max_chars, overlap_chars)."""

    def work(batch):
        out: dict[str, list] = {k: [] for k in ("tab", "rec_id", "piece_no", "start_pos", "end_pos", "piece")}
        for tab, rec, text, most, shared in zip(*(column(batch, c) for c in ("tab", "rec_id", "text", "max_chars", "overlap_chars"))):
            for i, (a, b) in enumerate(split_spans(text, most, shared)):
                for k, v in zip(out, (tab, rec, i, a, b, text[a:b])):
                    out[k].append(v)
        return out

    shared = F.least(F.greatest(F.coalesce("overlap_chars", F.lit(0)), F.lit(0)), F.col("max_chars") - 1)
    rows = df.where("text IS NOT NULL AND max_chars >= 1").select("tab", "rec_id", "text", "max_chars", shared.alias("overlap_chars"))
    return map_batches(rows, work, "tab string, rec_id long, piece_no int, start_pos int, end_pos int, piece string")


def oversized(df: DataFrame) -> DataFrame:
    """Only the rows whose text is longer than its limit; the rest never leave the JVM."""
    return df.where(F.char_length("text") > F.col("max_chars"))
