import itertools
import random

import pytest

from lexquarry.llm import splitting
from lexquarry.llm.splitting import boundaries, split_rows, split_spans


def checked(text, limit, overlap):
    spans = split_spans(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in spans)
    assert text[: spans[0][1]] + "".join(text[a + overlap : b] for a, b in spans[1:]) == text
    assert all(a == before - overlap for (_, before), (a, _) in zip(spans, spans[1:]))
    return spans


def test_properties():
    rnd = random.Random(5)
    for _ in range(60):
        words = ["x" * rnd.randint(1, 90) + rnd.choice(["", "", ".", ",", ".\n\n"]) for _ in range(rnd.randint(20, 300))]
        checked(" ".join(words), rnd.randint(100, 400), rnd.randint(0, 60))
    checked("x" * 5000, 300, 100)
    checked("字。" * 3000, 500, 50)


def test_best_of_all_splits():
    rnd = random.Random(6)
    for _ in range(20):
        text = " ".join("Ab " * rnd.randint(1, 6) + "c." for _ in range(9))
        limit, overlap = 60, 10
        if len(text) <= limit:
            continue
        spans = checked(text, limit, overlap)
        step = limit - overlap
        offered = boundaries(text, limit, step)
        ideal = (len(text) - overlap) / -(-(len(text) - overlap) // step)

        def cost(cuts):
            total, last = 0.0, 0
            for p, penalty in cuts:
                grown = p - last - (0 if last else overlap)
                if p - last > (step if last else limit):
                    return float("inf")
                total += penalty + splitting.PER_PIECE + (grown / ideal - 1) ** 2
                last = p
            return total

        inner, end = offered[:-1], offered[-1]
        best = min(cost([*c, end]) for n in range(len(inner) + 1) for c in itertools.combinations(inner, n))
        chosen = dict(offered)
        assert cost([(b, chosen[b]) for _, b in spans]) == pytest.approx(best)


def test_edges(spark):
    assert split_spans(None, 5, 1) == [] and split_spans("", 5, 1) == [(0, 0)] and split_spans("abcde", 5, 1) == [(0, 5)]
    with pytest.raises(ValueError):
        split_spans("abc", 2, 2)
    rows = [("t", 1, "One two. Three four.", 12, 2, "x")] * 2 + [("t", 2, None, 5, 1, "x"), ("t", 3, "a b", None, 1, "x"), ("t", 4, "abcdef", 4, None, "x")]
    df = spark.createDataFrame(rows, "tab string, rec_id long, text string, max_chars int, overlap_chars int, piece string")
    got = sorted(map(tuple, split_rows(df).collect()))
    want = [("t", rec, i, a, b, text[a:b]) for _, rec, text, limit, overlap, _ in (*rows[:2], rows[4]) for i, (a, b) in enumerate(split_spans(text, limit, overlap or 0))]
    assert got == sorted(want) and {g[1] for g in got} == {1, 4}
    assert split_rows(df.limit(0)).count() == 0


def test_combining_marks_stay_with_their_letters():
    text = "é̂" * 400
    assert all(text[b : b + 1] != "\u0302" and text[b : b + 1] != "\u0301" for _, b in checked(text, 50, 10))
    checked("\u0301" * 300, 40, 5)


def test_bad_limits_stop_nothing(spark):
    rows = [("a", 1, "One two three. Four five six.", 12, 12), ("b", 2, "One two three.", 0, 0), ("c", 3, "One two three.", -4, 1), ("d", 4, "One two three. Four.", 15, -3)]
    got = split_rows(spark.createDataFrame(rows, "tab string, rec_id long, text string, max_chars int, overlap_chars int")).collect()
    assert {r.rec_id for r in got} == {1, 4} and [r.piece for r in got if r.rec_id == 4] == ["One two three.", " Four."]
