import random
from collections import Counter

import pytest

from lexquarry.llm import mixing

RND = random.Random(2)


def tables(spark, n=3000):
    docs = [(i, RND.choice(["Big ", "BIG", "big", "mid", "small" if i % 9 == 0 else "mid", None, "other"]), RND.randint(5, 400), "x") for i in range(n)]
    targets = [("big", 0.3, 1, 0), ("mid", 0.3, 2, 0), ("small", 0.3, 5, 0), ("absent", 0.1, 3, 0)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long, copies string").selectExpr("doc_id", "lower(trim(source)) AS source", "n_tokens", "copies")
    return sizes, spark.createDataFrame(targets, "source string, target_share double, max_repeats int, available int")


@pytest.mark.parametrize("block", [20_000, 50])
def test_shares_caps_and_repeatability(spark, block):
    sizes, targets = tables(spark)
    mixed = mixing.mix(sizes, targets, block=block, fan_in=3)
    rows = mixed.collect()
    assert len({r.doc_id for r in rows}) == len(rows) == sizes.count()
    assert all(r.copies == 0 for r in rows if r.source in (None, "other"))
    rows = [r for r in rows if r.copies]
    cap = {"big": 1, "mid": 2, "small": 5}
    assert all(0 < r.copies <= cap[r.source] for r in rows)
    report = {r.source: r for r in mixing.report(mixed, sizes, targets).collect()}
    total = sum(r.n_tokens * r.copies for r in rows)
    for s in cap:
        assert abs(report[s].actual_share - 1 / 3) < 3 * 400 / total
    assert report["absent"].actual_share == 0 and report["other"].target_share is None
    # Every record of a source gets the floor or the ceiling of the same expectation.
    for s in cap:
        held = Counter(r.copies for r in mixed.where(f"source = '{s}'").collect())
        assert max(held) - min(held) <= 1
    again = mixing.mix(sizes.repartition(7), targets, block=block, fan_in=3).where("copies > 0")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_pivotal_keeps_sum_and_expectation():
    n, hits = 21, Counter()
    sizes = [RND.randint(1, 9) for _ in range(n)]
    for seed in range(3000):
        out, left = mixing.pivotal(list(range(n)), sizes, [0.3] * n, seed)
        assert sum(s * m for s, m in zip(sizes, out)) == pytest.approx(0.3 * sum(sizes))
        assert all(m in (0, 1) for i, m in enumerate(out) if i != left)
        for i, m in enumerate(out):
            hits[i] += m
    assert all(abs(hits[i] / 3000 - 0.3) < 0.05 for i in range(n))


def test_tokens_and_edges(spark):
    docs = spark.createDataFrame([(1, " A ", "two words"), (2, "a", ""), (3, "a", None), (4, None, "x"), (5, "b", "word " * 30_000)], "doc_id long, source string, text string")
    got = {r.doc_id: (r.source, r.n_tokens) for r in mixing.with_tokens(docs).collect()}
    assert set(got) == {1, 4, 5} and got[1] == ("a", 2) and got[5][1] >= 30_000
    none = mixing.with_tokens(docs.limit(0))
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert mixing.mix(none, targets).count() == 0 and mixing.report(mixing.mix(none, targets), none, targets).count() == 1
    assert {r.copies for r in mixing.mix(mixing.with_tokens(docs), targets.limit(0)).collect()} == {0}
