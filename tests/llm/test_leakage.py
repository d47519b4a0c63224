import random

import numpy as np

from lexquarry.llm import leakage

RND = random.Random(11)
NAMES = [f"name{i}" for i in range(900)]
COMMON = "the of shall under rule for a case what may worker pay be and in when".split()


def sentence(n):
    return [RND.choice(NAMES) if RND.random() < 0.45 else RND.choice(COMMON) for _ in range(n)]


def setup(spark):
    items = [(i, " ".join(sentence(30)) + "?", " ".join(sentence(40)) + f" total {1000 + i}", "x") for i in range(20)] + [(20, "too short", None, "x"), (21, None, "", "x")]
    docs, want = [], set()
    for d in range(300):
        words = sentence(80)
        if d % 6 == 0:
            item = RND.randrange(20)
            source = leakage.words_of(items[item][1 + d % 2])
            n = RND.choice([12, 15, len(source)])
            a = RND.randrange(len(source) - n + 1)
            p = RND.randrange(len(words))
            words[p:p] = source[a : a + n]
            want.add((d, item))
        if d % 7 == 0:  # eleven words are no leak
            source = leakage.words_of(items[RND.randrange(20)][1])
            words += ["zzz", *source[3:14], "zzz"]
        docs.append((d, ", ".join(words), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, "word " * 60_000, "x")]
    return (spark.createDataFrame(docs, "doc_id long, text string, kind string"), spark.createDataFrame(items, "item_id long, question string, expected_answer string, doc_id string"), want, docs, items)


def test_recall_against_brute_force(spark):
    docs, items, want, rows, held = setup(spark)
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs, items).where("kind <> 'paraphrase'").collect()}
    grams = {}
    for i, q, a, _ in held:
        for ws in map(leakage.words_of, (q, a)):
            for g in zip(*(ws[k:] for k in range(12))):
                grams.setdefault(g, set()).add(i)
    true = {(d, i) for d, t, _ in rows if t for g in zip(*(leakage.words_of(t)[k:] for k in range(12))) for i in grams.get(g, ())}
    assert want <= true and got <= true
    assert len(got & true) >= 0.98 * len(true)


def test_kinds(spark):
    q = "how should a reader reconcile burden rule annex 4336 with notice test form 9749 for bus washers in cafalar yard today"
    docs = [(1, q), (2, " ".join(q.split()[:13])), (3, q.replace(" reader", " careful reader").replace(" notice", " prior notice").replace(" bus", " tired bus").replace("yard", "north yard")), (4, "nothing here")]
    rows = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, q, "short")], "item_id long, question string, expected_answer string")).collect()
    assert {(r.doc_id, r.kind) for r in rows} == {(1, "whole"), (2, "part"), (3, "paraphrase")}


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a " * 30, None)], "item_id long, question string, expected_answer string")
    assert leakage.leaks(docs, items).count() == 0
    assert leakage.leaks(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).count() == 0


def test_lcs():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(200):
        a, b = ([RND.choice("abcd") for _ in range(RND.randint(1, 30))] for _ in range(2))
        assert leakage.lcs(a, b) == slow(a, b)


def test_latent_space_spans_the_leading_directions(spark):
    passages = leakage.Passages([(i, " ".join(sentence(30)), None) for i in range(40)]).passages()
    vocabulary = {w: i for i, w in enumerate(sorted({w for p in passages for w in p}))}
    ids, idf = [[vocabulary[w] for w in p] for p in passages], np.ones(len(vocabulary))
    space = leakage.latent_space(spark, ids, idf, rank=10)
    r, t, v = leakage.tfidf(ids, idf)
    dense = np.zeros((len(ids), len(idf)))
    dense[r, t] = v
    best = np.linalg.svd(dense)[1][:10]
    assert ((dense @ space) ** 2).sum() >= 0.97 * (best**2).sum()


def paraphrased(rnd, words, other):
    """The words with one in seven left out and one in six set behind another word, so that most of the order stays."""
    out = []
    for w in words:
        if rnd.random() > 1 / 7 or w[0].isdigit():
            out.append(w)
        if rnd.random() < 1 / 6:
            out.append(rnd.choice(other))
    return out


def planted(seed=9, n=200):
    rnd = random.Random(seed)
    words, other = [f"w{i}" for i in range(3000)], [f"o{i}" for i in range(3000)]
    pick = lambda k: [rnd.choice(COMMON) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(k)]
    items = [(i, " ".join([*pick(20), str(1000 + i), *pick(15)]), None) for i in range(n)]
    docs, want = [], set()
    for i, q, _ in items:
        bad = paraphrased(rnd, q.split(), other)
        own = leakage.lcs(q.split(), bad)
        runs = set(zip(*(q.split()[k:] for k in range(12)))) & set(zip(*(bad[k:] for k in range(12))))
        docs.append((i, " ".join([*rnd.choices(other + COMMON * 50, k=60), *bad, *rnd.choices(other + COMMON * 50, k=60)])))
        if own >= 0.7 * len(q.split()) and not runs:
            want.add((i, i))
    return items, docs, want


def test_recall_of_planted_paraphrases(spark):
    items, docs, want = planted()
    assert len(want) > 120
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, question string, expected_answer string"))
    found = {(r.doc_id, r.item_id) for r in got.where("kind = 'paraphrase'").collect()}
    assert len(found & want) >= 0.9 * len(want) and all(d == i for d, i in found)


def test_index_against_all_passages(spark):
    items, docs, _ = planted()
    model = leakage.fitted(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, question string, expected_answer string"))
    passages = leakage.Passages(items)
    near, every = leakage.Search(passages, model), leakage.Search(passages, model, probes=10**6)
    texts = [t.split() for _, t in docs]
    pairs = lambda s: {(d, t) for d, ts in s.close(texts, leakage.COSINE).items() for t in ts}
    brute = pairs(every)
    assert len(pairs(near) & brute) >= 0.9 * len(brute)


def test_blocks_give_the_same_rows(spark, monkeypatch):
    items, docs, _ = planted(n=60)
    docs = [(d, t + " " + items[(d + 1) % 60][1]) for d, t in docs]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, question string, expected_answer string")
    monkeypatch.setattr(leakage, "PROBES", 10**6)
    one = sorted(map(tuple, leakage.leaks(*frames).collect()))
    monkeypatch.setattr(leakage, "MAX_WORDS", 800)
    assert sorted(map(tuple, leakage.leaks(*frames).collect())) == one and any(r[3] == "paraphrase" for r in one) and any(r[3] == "whole" for r in one)


def test_every_run_of_every_item(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(2500)]
    items = [(i, " ".join(rnd.sample(words, 40)), None) for i in range(150)]
    docs, want = [], set()
    for i, q, _ in items:
        ws = q.split()
        for a in range(0, len(ws) - 11, 4):
            docs.append((len(docs), " ".join([*rnd.sample(words, 23), *ws[a : a + 12], *rnd.sample(words, 23)])))
            want.add((len(docs) - 1, i))
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, question string, expected_answer string"))
    assert {(r.doc_id, r.item_id) for r in got.where("kind = 'part'").collect()} == want
