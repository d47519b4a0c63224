"""Evaluation texts that leak into a corpus.

Passages are windows of words. The vocabulary is that of the evaluation texts and its weights are
inverse document frequencies over all corpus documents. A distributed randomised SVD of the TF-IDF
matrix of the evaluation passages gives a latent space, into which corpus passages are projected and
in which they are compared by cosine. The SVD is fitted on the evaluation side because the corpus's own
leading directions are its boilerplate, in which the rare words of a leaked passage vanish. It is fitted
on at most ``FIT_PASSAGES`` passages (those with the least hashes) and ``MAX_TERMS`` words (the most
frequent in them), one model for the whole evaluation set; statistics and search cover all documents,
all their windows and all evaluation passages.

A word outside the vocabulary counts in the length of a corpus passage with the weight of a word of no
document. So the cosine of a passage is at most the share of its length that lies in the vocabulary, and
passages below the threshold by that bound are not projected; none is lost by it. The evaluation passages
lie in an inverted index: ``LISTS`` times the root of their number of cells around centroids; a corpus passage is
compared with those of its ``PROBES`` nearest cells. Documents with a close passage are then checked for
paraphrases: the longest common subsequence and the figures of the answer.

Runs of ``RUN`` consecutive common words do not depend on the cosine, as a passage may have little in
the latent space: every run of a document whose words all occur in evaluation texts is looked up by its
hash among all runs of the evaluation texts and compared word by word. This way is exact.

The evaluation set is the stated query set; it goes to the tasks in blocks of at most ``MAX_WORDS`` words.
Results do not depend on the number of blocks, but for the cells of the index.

Defined results: null and empty texts leak nothing; fields with fewer than ``RUN`` words can't leak;
a document that holds an item several times gives one row; repeated documents give a row each; empty
tables on either side give no rows; extra columns are dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches

WORD = re.compile(r"[^\W_]+")
RUN, WINDOW, STRIDE = 12, 16, 4
RANK, OVERSAMPLE, POWER_STEPS = 160, 16, 2
COSINE = 0.25
LISTS, PROBES = 1.0, 4
MAX_WORDS, MAX_TERMS, FIT_PASSAGES = 1_000_000, 50_000, 50_000
FIELDS = ("question", "expected_answer")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def windows(n: int) -> range:
    """Starts of the windows over ``n`` words; the last one ends with the text."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else range(0)


class Passages:
    """The evaluation passages of a block of items, and the words in them."""

    def __init__(self, items: list[tuple[int, str | None, str | None]]):
        self.texts = [(item, f, ws) for item, *fields in items for f, ws in enumerate(map(words_of, fields)) if len(ws) >= RUN]
        self.words: dict[str, int] = {}
        for _, _, ws in self.texts:
            for w in ws:
                self.words.setdefault(w, len(self.words))
        self.rows = [(t, s) for t, (_, _, ws) in enumerate(self.texts) for s in windows(len(ws))]
        self.runs = [frozenset(zip(*(ws[i:] for i in range(RUN)))) for _, _, ws in self.texts]
        #: What the paraphrase check needs of each text: its figures and its words as bit rows.
        self.figures = [frozenset(w for w in ws if w[0].isdigit() and len(w) > 2) for _, _, ws in self.texts]
        self.masks = [word_masks(ws) for _, _, ws in self.texts]

    def passages(self) -> list[list[str]]:
        return [self.texts[t][2][s : s + WINDOW] for t, s in self.rows]


def fitting_passages(items: DataFrame, most: int) -> list[list[str]]:
    """The passages with the least hashes, at most ``most``."""

    def work(batch):
        found = Passages([(0, q, a) for q, a in zip(*(column(batch, f) for f in FIELDS))]).passages()
        return {"words": found}

    return [list(r.words) for r in map_batches(items.select(*FIELDS), work, "words array<string>").orderBy(F.xxhash64("words"), "words").limit(most).collect()]


def document_frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> np.ndarray:
    """In how many documents each word of the vocabulary occurs; the last entry counts the documents."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size + 1, dtype=np.int64)
        known = vocabulary.keys()
        for batch in batches:
            for text in column(batch, "text"):
                for w in known & set(words_of(text)):
                    n[vocabulary[w]] += 1
                n[size] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["term", "n"])

    out = np.zeros(size + 1, dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def tfidf(ids: list[list[int]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, value) of the normalised TF-IDF matrix of the given passages."""
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    term = np.concatenate([np.asarray(x, dtype=np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
    value = idf[term]
    # Repeated words add up: the square of a sum needs the merged entries.
    key, inverse = np.unique(row * len(idf) + term, return_inverse=True)
    merged = np.bincount(inverse, value)
    row, term = key // len(idf), key % len(idf)
    norm = np.sqrt(np.bincount(row, merged**2, len(ids)))
    return row, term, merged / np.maximum(norm[row], 1e-12)


def latent_space(spark, ids: list[list[int]], idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """(terms, rank): right singular vectors of the passages by randomised subspace iteration.

    The passages are spread over tasks. In each step a task multiplies its rows A with the basis Q
    and returns its part of A'(AQ), which is summed by blocks of terms.
    """
    terms = len(idf)
    width = min(rank + OVERSAMPLE, terms)
    basis = np.random.default_rng(seed).standard_normal((terms, width))
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i long, ids array<int>").repartition(max(4, len(ids) // 5000), "i")
    block = 512

    for _ in range(POWER_STEPS + 1):
        q, _ = np.linalg.qr(basis)

        def multiply(batches: Iterator[pa.RecordBatch], q=q) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(q)
            for batch in batches:
                r, t, v = tfidf(column(batch, "ids"), idf)
                n = batch.num_rows
                y = np.zeros((n, q.shape[1]))
                np.add.at(y, r, v[:, None] * q[t])
                np.add.at(total, t, v[:, None] * y[r])
            for a in range(0, len(total), block):
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([total[a : a + block].tobytes()], pa.binary())], ["a", "part"])

        def add(parts: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(p) for p in parts["part"])
            return pd.DataFrame({"a": [parts["a"].iloc[0]], "part": [total.tobytes()]})

        parts = rows.mapInArrow(multiply, "a int, part binary").groupBy("a").applyInPandas(add, "a int, part binary").collect()
        basis = np.zeros((terms, width))
        for p in parts:
            got = np.frombuffer(p.part).reshape(-1, width)
            basis[p.a : p.a + len(got)] = got
    # Rayleigh-Ritz: rotate to the singular directions and keep the leading ones.
    q, r = np.linalg.qr(basis)
    u, _, _ = np.linalg.svd(r)
    return (q @ u)[:, :rank].astype(np.float32)


def word_masks(words: list[str]) -> dict[str, int]:
    """word -> its places as bits."""
    masks: dict[str, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def lcs(a: list[str], b: list[str], masks: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, with machine words as bit rows."""
    masks = word_masks(a) if masks is None else masks
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b:
        if w in masks:
            u = row & masks[w]
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


#: Odd factors of the hash of a run; matches are compared word by word.
FACTORS = np.random.default_rng(13).integers(1, 2**63, RUN, dtype=np.uint64) | np.uint64(1)


def run_hashes(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``RUN`` word numbers that begin at the given places."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(RUN):
        out += ids[at + k].astype(np.uint64) * FACTORS[k]
    return out


class Model:
    """The vocabulary of the evaluation set, its weights and its latent space."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, unknown: float, space: np.ndarray):
        self.vocabulary, self.unknown = vocabulary, unknown
        # The last row stands for every other word: it has a length, but no direction.
        self.weights = np.append(idf, unknown).astype(np.float32)
        self.weighted = np.vstack([space * idf[:, None], np.zeros(space.shape[1])]).astype(np.float32)

    def ids(self, words: list[str]) -> list[int]:
        known, other = self.vocabulary.get, len(self.vocabulary)
        return [known(w, other) for w in words]

    def project(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Passages as rows of word numbers, padded with -1, in the latent space."""
        out = np.zeros((len(ids), self.weighted.shape[1]), dtype=np.float32)
        for k in range(ids.shape[1]):
            inside = ids[:, k] >= 0
            out[inside] += self.weighted[ids[inside, k]]
        return out / lengths[:, None]


def fitted(spark, docs: DataFrame, items: DataFrame) -> Model | None:
    """The model of an evaluation set over a corpus; None if no text can leak."""
    passages = fitting_passages(items, FIT_PASSAGES)
    counts = Counter(w for p in passages for w in set(p))
    if not counts:
        return None
    vocabulary = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:MAX_TERMS])}
    df = document_frequencies(docs, vocabulary)
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 0.1
    space = latent_space(spark, [[vocabulary[w] for w in p if w in vocabulary] for p in passages], idf)
    return Model(vocabulary, idf, float(np.log(1.0 + df[-1]) + 0.1), space)


def centroids(vectors: np.ndarray, n: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centroids of spherical k-means."""
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    centre = unit[np.random.default_rng(seed).choice(len(unit), min(n, len(unit)), replace=False)]
    for _ in range(rounds):
        near = (unit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, unit)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 1e-9, total / np.maximum(size, 1e-9), centre)
    return centre.astype(np.float32)


class Search:
    """Compares the passages of documents with the evaluation passages of a block."""

    def __init__(self, passages: Passages, model: Model, probes: int | None = None):
        self.passages, self.model, self.probes = passages, model, probes or PROBES
        ids, lengths = self._padded([model.ids(p) for p in passages.passages()])
        self.queries = model.project(ids, lengths)
        self.text_of = np.array([t for t, _ in passages.rows])
        self.centres = centroids(self.queries, max(1, int(LISTS * len(self.queries) ** 0.5)))
        near = (self.queries @ self.centres.T).argmax(axis=1)
        self.lists = [np.flatnonzero(near == c) for c in range(len(self.centres))]
        hashes, owners = [], []
        for t, (_, _, ws) in enumerate(passages.texts):
            of = np.array([passages.words[w] for w in ws], dtype=np.int64)
            hashes.append(run_hashes(of, np.arange(len(ws) - RUN + 1)))
            owners.append(np.full(len(hashes[-1]), t))
        order = np.argsort(np.concatenate(hashes), kind="stable")
        self.run_hash, self.run_text = np.concatenate(hashes)[order], np.concatenate(owners)[order]

    def _padded(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.full((len(rows), WINDOW), -1, dtype=np.int64)
        for i, x in enumerate(rows):
            ids[i, : len(x)] = x
        lengths = np.sqrt(np.where(ids >= 0, self.model.weights[ids] ** 2, 0).sum(axis=1))
        return ids, np.maximum(lengths, 1e-9)

    def runs(self, ws: list[str], row: np.ndarray) -> dict[int, set[int]]:
        """text -> places of a document where a run of that text begins."""
        hits = np.concatenate([[0], np.cumsum(row >= 0)])
        at = np.flatnonzero(hits[RUN:] - hits[:-RUN] == RUN)
        found: dict[int, set[int]] = {}
        if not len(at):
            return found
        keys = run_hashes(row, at)
        a, b = np.searchsorted(self.run_hash, keys), np.searchsorted(self.run_hash, keys, "right")
        for i in np.flatnonzero(b > a):
            p = int(at[i])
            run = tuple(ws[p : p + RUN])
            for t in self.run_text[a[i] : b[i]].tolist():
                if run in self.passages.runs[t]:
                    found.setdefault(t, set()).add(p)
        return found

    def close(self, docs: list[list[str]], cosine: float) -> dict[int, dict[int, tuple[list[int], set[int]]]]:
        """doc -> text -> (starts of the windows whose cosine to one of its passages reaches the threshold, places of common runs)."""
        found: dict[int, dict[int, tuple[list[int], set[int]]]] = {}
        in_block = self.passages.words.get
        owners, starts, windows_ = [], [], []
        model, other = self.model, len(self.model.vocabulary)
        for d, ws in enumerate(docs):
            if len(ws) < RUN:
                continue
            for t, places in self.runs(ws, np.array([in_block(w, -1) for w in ws], dtype=np.int64)).items():
                found.setdefault(d, {})[t] = ([], places)
            row = np.array(model.ids(ws), dtype=np.int64)
            energy = model.weights[row] ** 2
            whole = np.concatenate([[0], np.cumsum(energy)])
            inside = np.concatenate([[0], np.cumsum(np.where(row < other, energy, 0))])
            at = np.arange(0, max(1, len(ws) - WINDOW + STRIDE), STRIDE)
            end = np.minimum(at + WINDOW, len(ws))
            # No cosine is larger than the share of the length that lies in the vocabulary.
            at = at[inside[end] - inside[at] >= cosine * cosine * (whole[end] - whole[at])]
            if len(at):
                padded = np.append(row, np.full(WINDOW, -1))
                windows_.append(padded[at[:, None] + np.arange(WINDOW)])
                owners.append(np.full(len(at), d))
                starts.append(at)
        if windows_:
            owner, start = np.concatenate(owners), np.concatenate(starts)
            for i, q in self._near(np.concatenate(windows_), cosine):
                found.setdefault(int(owner[i]), {}).setdefault(int(self.text_of[q]), ([], set()))[0].append(int(start[i]))
        return found

    def _near(self, ids: np.ndarray, cosine: float, block: int = 8192) -> Iterator[tuple[int, int]]:
        """(window, evaluation passage) with at least the cosine, from the cells nearest to each window."""
        for a in range(0, len(ids), block):
            part = ids[a : a + block]
            lengths = np.sqrt(np.where(part >= 0, self.model.weights[part] ** 2, 0).sum(axis=1))
            z = self.model.project(part, np.maximum(lengths, 1e-9))
            # Of its direction in the space, too, a window has at most its own length there.
            alive = np.flatnonzero((z * z).sum(axis=1) >= cosine * cosine)
            if not len(alive):
                continue
            z = z[alive]
            score = z @ self.centres.T
            probes = min(self.probes, score.shape[1])
            cells = np.argpartition(-score, probes - 1, axis=1)[:, :probes]
            for c in np.unique(cells):
                rows = np.flatnonzero((cells == c).any(axis=1))
                w, q = np.nonzero(z[rows] @ self.queries[self.lists[c]].T >= cosine)
                yield from zip((alive[rows[w]] + a).tolist(), self.lists[c][q].tolist())

    def judge(self, ws: list[str], text: int, starts: list[int], hits: set[int]) -> tuple[str, int] | None:
        """(kind, words): a run of common words, or a paraphrase by its common subsequence."""
        item, f, want = self.passages.texts[text]
        runs, best = self.passages.runs[text], 0
        size = len(ws)
        if hits:
            # A run that goes on is measured from its first place.
            for p in (p for p in hits if p - 1 not in hits):
                n = RUN
                while p + n < size and tuple(ws[p + n - RUN + 1 : p + n + 1]) in runs:
                    n += 1
                best = max(best, n)
            return ("whole" if best >= len(want) else "part"), best
        a, b = max(0, min(starts) - len(want) // 2), min(size, max(starts) + WINDOW + len(want) // 2)
        span, masks = ws[a:b], self.passages.masks[text]
        # No subsequence is longer than the number of words that occur in both.
        if sum(w in masks for w in span) < 0.7 * len(want) or not self.passages.figures[text] <= set(span):
            return None
        common = lcs(want, span, masks)
        if common >= 0.7 * len(want):
            return "paraphrase", common
        return None


def leaks(docs: DataFrame, items: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, field, kind, n_words): leaked items by document, from docs (doc_id, text) and items
    (item_id, question, expected_answer). ``kind`` is whole, part or paraphrase."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, field string, kind string, n_words int"
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    result = spark.createDataFrame([], schema)
    model = fitted(spark, rows, items)
    if model is None:
        return result
    n_words = items.select(F.sum(F.size(F.split(F.concat_ws(" ", *FIELDS), " "))).alias("n")).first()["n"] or 0
    blocks = -(-int(n_words) // MAX_WORDS)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else items
        passages = Passages([(r.item_id, r.question, r.expected_answer) for r in part.select("item_id", *FIELDS).collect()])
        if passages.texts:
            result = result.unionByName(_search(rows, Search(passages, model), schema, cosine))
    return result


def _search(rows: DataFrame, searched: Search, schema: str, cosine: float) -> DataFrame:
    search = rows.sparkSession.sparkContext.broadcast(searched)

    def work(batch):
        s: Search = search.value
        ids, docs = column(batch, "doc_id"), [words_of(t) for t in column(batch, "text")]
        out = {"doc_id": [], "item_id": [], "field": [], "kind": [], "n_words": []}
        for d, texts in s.close(docs, cosine).items():
            for t, (starts, hits) in texts.items():
                if got := s.judge(docs[d], t, starts, hits):
                    item, f, _ = s.passages.texts[t]
                    for name, value in zip(out, (ids[d], item, FIELDS[f], *got)):
                        out[name].append(value)
        return out

    return map_batches(rows, work, schema)
