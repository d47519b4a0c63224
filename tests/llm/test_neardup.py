import random

import numpy as np

from lexquarry.llm import neardup


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return words


def corpus(rnd):
    texts = []
    for g in range(12):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.randint(45, 200))]
        texts += [" ".join(edited(rnd, base, rnd.randrange(0, 8))) for _ in range(5)] + ["\t".join(base).upper()]
    return texts + texts[:3] + [None, "", "short text", "x " * 60, " ".join(f"u{i}" for i in range(20000))]


def brute(texts, size, threshold, least):
    sets = [neardup.shingles_of(w, size) if t is not None and len(w := neardup.words_of(t)) >= least else None for t in texts]
    return {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])
    }


def frame(spark, texts):
    return spark.createDataFrame([("t", i, t, 0) for i, t in enumerate(texts)], "tab string, rec_id long, text string, id_a int")


def test_pairs_equal_brute_force(spark):
    texts = corpus(random.Random(3))
    got = [(r.id_a, r.id_b) for r in neardup.similar_pairs(frame(spark, texts)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts, 3, 0.75, 40)


def test_groups_are_the_components(spark):
    texts = corpus(random.Random(4))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = brute(texts, 3, 0.75, 40)
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for p in pairs for x in p}
    got = {r.rec_id: r.class_id for r in neardup.groups(frame(spark, texts)).collect()}
    assert got == {x: find(x) for x in linked}


def test_chain(spark):
    edges = spark.createDataFrame([("t", i, i + 1) for i in range(60)] + [("t", 100, 101)], "tab string, id_a long, id_b long")
    got = {r.rec_id: r.class_id for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_empty(spark):
    df = spark.createDataFrame([], "tab string, rec_id long, text string")
    assert neardup.similar_pairs(df).count() == 0 and neardup.groups(df).count() == 0


def test_estimate():
    rnd = np.random.default_rng(1)
    common, own = rnd.integers(0, 2**63, 150).astype(np.uint64), rnd.integers(0, 2**63, (2, 25)).astype(np.uint64)
    sets = [np.concatenate([common, o]) for o in own]
    sig = neardup.superminhash(np.concatenate(sets), np.repeat([0, 1], 175), 2, 192)
    assert abs((sig[0] == sig[1]).mean() - 0.75) < 0.1 and (sig != neardup.EMPTY).all()
    one = neardup.superminhash(sets[0][::-1].copy(), np.zeros(175, dtype=np.int64), 1, 192)
    assert (one[0] == sig[0]).all()


def family(rnd, n, base_size=60, far=0):
    """Variants of one text; every tenth is ``far`` edits away from the rest and near a twin of its own."""
    base = [f"w{i}" for i in range(base_size)]
    texts = []
    for i in range(n):
        words = edited(rnd, base, 2)
        if far and i % 10 == 0:
            words = edited(rnd, words, far)
            texts.append(" ".join(edited(rnd, words, 1)))
        texts.append(" ".join(words))
    return texts


def test_large_bands(spark, monkeypatch):
    texts = family(random.Random(8), 150, far=4)
    want = brute(texts, 3, 0.75, 40)
    df = frame(spark, texts)
    monkeypatch.setattr(neardup, "CHUNK", 16)
    monkeypatch.setattr(neardup.paired, "__defaults__", (16,))
    got = [(r.id_a, r.id_b) for r in neardup.similar_pairs(df).collect()]
    assert len(got) == len(set(got)) and len(set(got) & want) >= 0.99 * len(want) and set(got) <= want
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    monkeypatch.setattr(neardup.star_links, "__defaults__", (8,))
    classes = {r.rec_id: r.class_id for r in neardup.groups(df).collect()}
    assert classes == {x: find(x) for x in {y for p in got for y in p}}


def test_chunks_make_every_pair_once(spark):
    rows = [("t", 1, i, 40) for i in range(40)] + [("t", 2, i, 3) for i in (1, 2, 50)]
    df = spark.createDataFrame(rows, "tab string, h long, id long, n long")
    got = [(r.id_a, r.id_b) for r in neardup.paired(df, 7).collect()]
    assert sorted(got) == sorted({(a, b) for a in range(40) for b in range(a + 1, 40)} | {(1, 50), (2, 50)})


def test_slices_give_the_same_signatures(monkeypatch):
    rnd = random.Random(12)
    docs = [[f"w{rnd.randrange(500)}" for _ in range(n)] for n in (50, 900, 3, 2500)]
    known = neardup._Hashes()
    whole = neardup.signatures(docs, 3, 48, known)
    monkeypatch.setattr(neardup, "AT_ONCE", 200)
    assert (neardup.signatures(docs, 3, 48, known) == whole).all()
