"""Near-duplicate records: SuperMinHash signatures, banding, exact verification, grouping.

A text is the set of its word shingles. SuperMinHash gives every shingle a pseudo-random permutation
of the ``m`` signature places; in round ``j`` a shingle offers the value ``j + r`` to the place that
its permutation has at ``j``. Values of later rounds are larger, so a place that was filled in an
earlier round is final, and a text is finished as soon as all its places are filled (early
stopping). Places are correlated through the permutations, which gives the estimate less variance
than independent minima. All texts of a batch go through the rounds together.

Signatures are cut into bands. Exact copies share all bands and are folded into one representative
in the same exchange, before any pair is made. Pairs of representatives that agree in a band are
candidates; they are verified on the texts themselves, so similarity never rests on a hash (copies are
told by their MD5 digest). With 32 bands of 6 places a pair at similarity 0.75 is missed with
probability 0.002, one at 0.8 with 6e-5.

A band with more than ``CHUNK`` members is cut into chunks, and every two of them are paired in a group of
their own, so no task holds more than ``2 * CHUNK`` members of a band. That is for :func:`similar_pairs`, which
must list every pair. :func:`groups` only needs to know what hangs together: a band with more than ``STAR`` members
is compared with one of them, its star. One less the similarity is a metric, so a member whose distance
``d`` from the star is above the limit can be near another only if their distances from the star differ by at
most the limit; such members are paired with those in that ring, the others are done. No link between groups
is lost.

Defined results: null texts and texts with fewer than ``least_words`` words are in no pair; texts
too short for one shingle are never similar; similarity is the size of the intersection over that
of the union of distinct shingles; exact repetitions are pairs; very long texts are used whole; an
empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.session import cut

BREAKS = "\t\n\r\f"
BANDS, ROWS = 32, 6
CHUNK, STAR = 256, 64
#: Shingles whose signatures are made at once; longer texts go through in slices of that length.
AT_ONCE = 40_000
SEED = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: str) -> list[str]:
    """Lower-cased words, separated by blanks, tabs, line breaks or form feeds only."""
    text = text.lower()
    for c in BREAKS:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingles_of(words: list[str], size: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(size))))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x + SEED
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Word hashes, remembered; emptied when it grows beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(docs: list[list[str]], size: int, known: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): one entry per shingle of the concatenated docs."""
    flat = np.fromiter((known[w] for d in docs for w in d), dtype=np.uint64, count=sum(map(len, docs)))
    lengths = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
    counts = np.maximum(lengths - size + 1, 0)
    owner = np.repeat(np.arange(len(docs)), counts)
    starts = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    h = np.zeros(len(owner), dtype=np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0x100000001B3) + flat[starts + i])
    return h, owner


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n, m) of the ``n`` sets whose hashed elements are given; repeats change nothing."""
    sig = np.full(n * m, EMPTY, dtype=np.uint64)
    perm = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(elements), m)).copy()
    at = np.arange(len(elements))
    for j in range(m):
        r = mix(elements ^ np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & 0xFFFFFFFFFFFFFFFF))
        k = j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        place = perm[at, k].astype(np.int64)
        perm[at, k] = perm[at, j]
        np.minimum.at(sig, owner * m + place, (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)))
        open_sets = (sig.reshape(n, m) == EMPTY).any(axis=1)
        keep = open_sets[owner]
        left = int(keep.sum())
        if not left:
            break
        if left < len(elements):
            elements, owner, at = elements[keep], owner[keep], at[keep]
            if left * 4 < len(perm):
                perm, at = perm[at], np.arange(left)
    return sig.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands))
    for i in range(rows):
        h = mix(h * np.uint64(0x100000001B3) + parts[:, :, i])
    return h.view(np.int64)


def _texts(df: DataFrame, least_words: int) -> DataFrame:
    """(tab, rec_id, text, digest) of the rows with enough words; the digest names exact copies."""
    words = F.filter(F.split("text", "[ \t\n\r\f]+"), lambda w: w != "")
    return df.where(F.col("text").isNotNull()).where(F.size(words) >= least_words).select("tab", "rec_id", "text", F.unhex(F.md5("text")).alias("digest"))


def signatures(docs: list[list[str]], size: int, m: int, known: _Hashes) -> np.ndarray:
    """Signatures of word lists, in slices of at most ``AT_ONCE`` shingles; those of a longer text are joined by their minima."""
    out = np.full((len(docs), m), EMPTY, dtype=np.uint64)
    part: list[list[str]] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if part:
            hashes, own = shingle_hashes(part, size, known)
            np.minimum.at(out, owner, superminhash(hashes, own, len(part), m))
        part.clear()
        owner.clear()
        held = 0

    for i, words in enumerate(docs):
        for a in range(0, max(1, len(words) - size + 1), AT_ONCE):
            piece = words[a : a + AT_ONCE + size - 1]
            if held + len(piece) > AT_ONCE + size:
                flush()
            part.append(piece)
            owner.append(i)
            held += len(piece)
    flush()
    return out


def signed(df: DataFrame, size: int, least_words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(tab, rec_id, fold, bands) of each row of df (tab, rec_id, text) that can be in a pair.

    ``fold`` hashes the text; rows are folded only where it and a band agree.
    """
    known = _Hashes()

    def work(batch: pa.RecordBatch):
        out = {"tab": [], "rec_id": [], "fold": [], "bands": []}
        tabs, ids, texts, folds = (column(batch, c) for c in ("tab", "rec_id", "text", "fold"))
        docs, keep = [], []
        for i, text in enumerate(texts):
            words = words_of(text)
            if len(words) >= max(least_words, size):
                docs.append(words)
                keep.append(i)
        if not docs:
            return None
        got = band_hashes(signatures(docs, size, bands * rows, known), bands, rows)
        for name, values in (("tab", tabs), ("rec_id", ids), ("fold", folds)):
            out[name] += [values[i] for i in keep]
        out["bands"] += list(got)
        return out

    return map_batches(_texts(df, least_words).withColumn("fold", F.xxhash64("text")).drop("digest"), work, "tab string, rec_id long, fold long, bands array<long>")


def shared_bands(sigs: DataFrame) -> DataFrame:
    """(tab, h, id, n): the representatives of every band that several of them share, and their number."""
    banded = sigs.select("tab", "rec_id", "fold", F.explode("bands").alias("h"))
    # One exchange serves three steps, which all cluster on (tab, h): copies are folded into their
    # representative, bands that nobody shares are dropped, and what is left is paired.
    folded = banded.repartition("tab", "h").groupBy("tab", "h", "fold").agg(F.min("rec_id").alias("id"))
    return cut(folded.withColumn("n", F.count("*").over(Window.partitionBy("tab", "h"))).where("n > 1").select("tab", "h", "id", "n"))


def paired(shared: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(tab, id_a, id_b): all pairs of the members (tab, h, id, n) of each band, large bands by chunks."""
    few = shared.where(F.col("n") <= chunk)
    a, b = few.alias("a"), few.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("tab", "h")]
    pairs = a.join(b, [*same, F.col("a.id") < F.col("b.id")]).select("a.tab", F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))
    many = shared.where(F.col("n") > chunk).withColumn("parts", F.ceil(F.col("n") / chunk).cast("int"))
    many = many.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # Each member meets its own chunk once and every other chunk once: the group is (lesser, greater) chunk.
    met = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("tab", "h", "id", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    c, d = met.alias("c"), met.alias("d")
    meets = [F.col(f"c.{k}") == F.col(f"d.{k}") for k in ("tab", "h", "x", "y")]
    crossed = c.join(d, [*meets, F.col("c.id") < F.col("d.id")]).where((F.col("c.x") == F.col("c.y")) | (F.col("c.own") != F.col("d.own")))
    return pairs.unionByName(crossed.select("c.tab", F.col("c.id").alias("id_a"), F.col("d.id").alias("id_b"))).distinct()


def candidates(sigs: DataFrame) -> DataFrame:
    """(tab, id_a, id_b): pairs of representatives that agree in at least one band."""
    return paired(shared_bands(sigs))


def verified(pairs: DataFrame, df: DataFrame, size: int, threshold: float) -> DataFrame:
    """(tab, id_a, id_b, similarity) of the pairs whose exact similarity reaches the threshold (0 keeps all)."""
    key = ("tab", "id_a", "id_b")
    ends = pairs.select(*key, F.explode(F.array("id_a", "id_b")).alias("rec_id"))
    texts = df.select("tab", "rec_id", "text")
    both = (
        ends.join(texts, ["tab", "rec_id"]).groupBy(*key)
        .agg(*[F.max(F.when(F.col("rec_id") == F.col(k), F.col("text"))).alias(t) for k, t in (("id_a", "text_a"), ("id_b", "text_b"))])
    )

    def work(batch: pa.RecordBatch):
        out = {"tab": [], "id_a": [], "id_b": [], "similarity": []}
        seen: dict[str, set] = {}

        def shingles(text: str) -> set:
            if text not in seen:
                if len(seen) > 200:
                    seen.clear()
                seen[text] = shingles_of(words_of(text), size)
            return seen[text]

        for tab, a, b, x, y in zip(*(column(batch, c) for c in (*key, "text_a", "text_b"))):
            sx, sy = shingles(x), shingles(y)
            common = len(sx & sy)
            union = len(sx) + len(sy) - common
            if union and common >= threshold * union or not threshold:
                for name, value in zip(out, (tab, a, b, common / union if union else 0.0)):
                    out[name].append(value)
        return out

    return map_batches(both, work, "tab string, id_a long, id_b long, similarity double")


def representative_pairs(df: DataFrame, size: int, threshold: float, least_words: int) -> DataFrame:
    """(tab, id_a, id_b, similarity): similar pairs among the representatives of exact copies."""
    return verified(candidates(signed(df, size, least_words)), df, size, threshold)


def copies(df: DataFrame, least_words: int) -> DataFrame:
    """(tab, rec_id, rep): the rows of every group of two or more exact copies; rep is the least id."""
    rows = _texts(df, least_words).select("tab", "rec_id", "digest")
    groups = rows.groupBy("tab", "digest").agg(F.min("rec_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    return rows.join(groups, ["tab", "digest"]).select("tab", "rec_id", "rep")


def similar_pairs(df: DataFrame, size: int = 3, threshold: float = 0.75, least_words: int = 40) -> DataFrame:
    """(tab, id_a, id_b), id_a < id_b: all similar pairs of rows of df (tab, rec_id, text), copies included."""
    same = cut(copies(df, least_words))
    a, b = same.alias("a"), same.alias("b")
    within = a.join(b, [F.col("a.tab") == F.col("b.tab"), F.col("a.rep") == F.col("b.rep"), F.col("a.rec_id") < F.col("b.rec_id")]).select(
        "a.tab", F.col("a.rec_id").alias("id_a"), F.col("b.rec_id").alias("id_b")
    )
    wide = representative_pairs(df, size, threshold, least_words).select("tab", "id_a", "id_b")
    for end in ("id_a", "id_b"):
        members = same.select("tab", F.col("rep").alias(end), F.col("rec_id").alias("member"))
        wide = wide.join(members, ["tab", end], "left").withColumn(end, F.coalesce("member", end)).drop("member")
    wide = wide.select("tab", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return within.unionByName(wide)


def components(edges: DataFrame) -> DataFrame:
    """(tab, rec_id, class_id): connected components of edges (tab, id_a, id_b); the class is the least id.

    Each round takes the least label among neighbours and then the label of the label (the union and
    find steps), so long chains shrink quickly. Rounds are cut with checkpoints.
    """
    ways = cut(
        edges.select("tab", F.col("id_a").alias("rec_id"), F.col("id_b").alias("other"))
        .unionByName(edges.select("tab", F.col("id_b").alias("rec_id"), F.col("id_a").alias("other")))
    )
    labels = cut(ways.groupBy("tab", "rec_id").agg(F.least(F.col("rec_id"), F.min("other")).alias("class_id")))
    while True:
        offers = ways.join(labels.select("tab", F.col("rec_id").alias("other"), F.col("class_id").alias("offer")), ["tab", "other"]).groupBy("tab", "rec_id").agg(F.min("offer").alias("offer"))
        hooked = labels.join(offers, ["tab", "rec_id"]).select("tab", "rec_id", F.col("class_id").alias("was"), F.least("class_id", "offer").alias("class_id"))
        finds = labels.select("tab", F.col("rec_id").alias("class_id"), F.col("class_id").alias("found"))
        after = cut(
            hooked.join(finds, ["tab", "class_id"], "left")
            .select("tab", "rec_id", "was", F.least("class_id", F.coalesce("found", "class_id")).alias("class_id"))
        )
        labels = after.drop("was")
        if after.where("was <> class_id").isEmpty():
            return labels


def star_links(shared: DataFrame, df: DataFrame, size: int, threshold: float, star: int = STAR) -> DataFrame:
    """(tab, id_a, id_b): similar pairs that connect what the bands (tab, h, id, n) connect, not all of them.

    Small bands are paired; of large ones each member is compared with the least, and again only those
    are paired that its distance leaves open.
    """
    small = paired(shared.where(F.col("n") <= star).select("tab", "h", "id", "n"))
    large = shared.where(F.col("n") > star)
    rays = large.withColumn("star", F.min("id").over(Window.partitionBy("tab", "h"))).where("id <> star")
    pairs = rays.select("tab", F.col("star").alias("id_a"), F.col("id").alias("id_b")).distinct()
    judged = cut(verified(pairs, df, size, 0.0))
    far = rays.join(judged.select("tab", F.col("id_a").alias("star"), F.col("id_b").alias("id"), (1.0 - F.col("similarity")).alias("d")), ["tab", "star", "id"])
    # Rings as wide as the limit: two members can be near only in the same or in neighbouring rings.
    limit = 1.0 - threshold
    far = far.withColumn("ring", F.floor(F.col("d") / limit).cast("int"))
    open_ = far.where(F.col("d") > limit)
    spread = lambda x: x.withColumn("at", F.explode(F.array(F.col("ring"), F.col("ring") + 1)))
    left = spread(open_).select("tab", "h", "at", F.col("id").alias("a"), F.col("d").alias("da"))
    right = spread(far).select("tab", "h", "at", F.col("id").alias("b"), F.col("d").alias("db"))
    again = left.join(right, ["tab", "h", "at"]).where((F.col("a") != F.col("b")) & (F.abs(F.col("da") - F.col("db")) <= limit + 1e-9))
    again = again.select("tab", F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    near = verified(small.unionByName(again).distinct(), df, size, threshold).select("tab", "id_a", "id_b")
    return near.unionByName(judged.where(F.col("similarity") >= threshold).select("tab", "id_a", "id_b")).distinct()


def groups(df: DataFrame, size: int = 3, threshold: float = 0.75, least_words: int = 40) -> DataFrame:
    """(tab, rec_id, class_id, copy_of): one row per record in a group of two or more.

    ``class_id`` is the least id of the group, ``copy_of`` that of the records with exactly the same text. Copies are
    not expanded into pairs.
    """
    pairs = star_links(shared_bands(signed(df, size, least_words)), df, size, threshold)
    same = cut(copies(df, least_words))
    edges = pairs.unionByName(same.where("rec_id <> rep").select("tab", F.col("rep").alias("id_a"), F.col("rec_id").alias("id_b")))
    found = components(edges).join(same, ["tab", "rec_id"], "left")
    return found.select("tab", "rec_id", "class_id", F.coalesce("rep", "rec_id").alias("copy_of"))
