"""Mix sources to target shares of all tokens.

The total is the largest at which every source that has records can give its share without
repeating a record more than its cap allows; shares of sources without records are spread over the
others in proportion. Each record of a source then gets the same expected number of copies. Its
fractional part is rounded by the pivotal method: two records exchange mass, weighted by their sizes
so that the tokens of the source stay what they are, until one of them is integral; the other goes
on. Records meet in blocks of (source, hash), whose residuals are combined through a reduction tree
over tasks; only the last record of a source is rounded without a partner, so the tokens of a source
miss their target by less than one record.

Blocks are formed by hashing ids and sorted inside, and random numbers come from ids, so a task that
runs again after a lost executor gives the same result.

Defined results: null and empty texts have no tokens and are left out; sources are compared without
case and outer blanks; records of sources without a target are left out and reported; a target
without records is reported with share 0; repeated rows are records of their own; empty tables give
an empty mix; extra columns are dropped.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches
from lexquarry.session import cut

TOKENIZER = os.environ.get("LEXQUARRY_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Word splitting of the tokenizer's vocabulary, a fixed value of that public vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK, FAN_IN = 20_000, 64


def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of df (doc_id, source, text), for texts with tokens."""
    made: dict = {}

    def work(batch):
        if not made:
            made["e"] = encoder(path)
        texts = column(batch, "text")
        sizes = [len(x) for x in made["e"].encode_ordinary_batch(texts, num_threads=1)]
        return {"doc_id": column(batch, "doc_id"), "source": column(batch, "source"), "n_tokens": sizes}

    rows = df.where(F.length("text") > 0).select("doc_id", F.lower(F.trim("source")).alias("source"), "text")
    return map_batches(rows, work, "doc_id long, source string, n_tokens long")


def uniform(seed: int, *key) -> float:
    return xxhash.xxh64_intdigest(repr(key), seed) / 2.0**64


def pivotal(ids: list, sizes: list[float], mass: list[float], seed: int) -> tuple[list[float], int | None]:
    """Round masses in [0, 1) to 0 or 1, keeping the size-weighted sum; (masses, index of the residual).

    A running record exchanges mass with the next: with the right odds either one gains what the
    other loses, until one is integral. Expectations are kept.
    """
    out = list(mass)
    run = None
    for i in range(len(ids)):
        if out[i] <= 1e-12 or out[i] >= 1 - 1e-12:
            out[i] = round(out[i])
            continue
        if run is None:
            run = i
            continue
        a, b, sa, sb = out[run], out[i], sizes[run], sizes[i]
        up = min((1 - a) * sa, b * sb)  # run gains
        down = min(a * sa, (1 - b) * sb)  # run loses
        shift = up if uniform(seed, ids[run], ids[i]) * (up + down) < down else -down
        out[run], out[i] = a + shift / sa, b - shift / sb
        for k in (run, i):
            if out[k] < 1e-9 or out[k] > 1 - 1e-9:
                out[k] = round(out[k])
        open_ = [k for k in (run, i) if 0 < out[k] < 1]
        run = open_[0] if open_ else None
    return out, run


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, available, n_records, expected, goal): one row per target; ``expected`` copies a record."""
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_records"))
    wanted = targets.groupBy(F.lower(F.trim("source")).alias("source")).agg(
        F.sum("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")
    )
    rows = wanted.join(have, "source", "left")
    # One row per target; its extremes over all targets are a single row.
    limits = rows.where("available > 0 AND target_share > 0").agg(
        F.sum("target_share").alias("live"), F.min(F.col("max_repeats") * F.col("available") / F.col("target_share")).alias("scale")
    )
    return rows.join(F.broadcast(limits)).select(
        "source", "target_share", F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("n_records", F.lit(0)).alias("n_records"),
        F.when(F.col("available") > 0, F.col("target_share") * F.col("scale") / F.col("available")).otherwise(0.0).alias("expected"),
        (F.when(F.col("available") > 0, F.col("target_share") * F.col("scale")).otherwise(0.0)).alias("goal"),
    )


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 17, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each record appears in the mix.

    There is one row per record with tokens; records that are left out, and those of sources without
    a target, have 0 copies.
    """
    shares = plan(sizes, targets).where("expected > 0").select("source", "expected", "n_records")
    others = sizes.join(shares, "source", "left_anti").select("doc_id", "source", "n_tokens", F.lit(0).alias("copies"))
    rows = sizes.join(shares, "source")
    rows = rows.select(
        "doc_id", "source", "n_tokens", F.floor(F.col("expected") + 1e-12).cast("int").alias("base"),
        F.greatest(F.col("expected") - F.floor(F.col("expected") + 1e-12), F.lit(0.0)).alias("mass"),
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n_records") / block)).cast("int").alias("part"),
    )
    schema = "doc_id long, source string, n_tokens long, copies int, base int, mass double, part int"

    def round_block(pdf: pd.DataFrame) -> pd.DataFrame:
        # Records of like size meet, so little is left over; ids break ties.
        pdf = pdf.sort_values(["n_tokens", "doc_id"])
        mass, left = pivotal(pdf["doc_id"].tolist(), pdf["n_tokens"].astype(float).tolist(), pdf["mass"].tolist(), seed)
        copies = [None if i == left else int(b + m) for i, (b, m) in enumerate(zip(pdf["base"], mass))]
        return pdf.assign(copies=pd.array(copies, dtype="Int32"), mass=mass)[["doc_id", "source", "n_tokens", "copies", "base", "mass", "part"]]

    level = cut(rows.groupBy("source", "part").applyInPandas(round_block, schema))
    done = level.where("copies IS NOT NULL")
    while True:
        rest = level.where("copies IS NULL").withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        widest = rest.agg(F.max("part").alias("m")).first()["m"]
        if widest is None:
            break
        level = cut(rest.groupBy("source", "part").applyInPandas(round_block, schema))
        done = done.unionByName(level.where("copies IS NOT NULL"))
        if widest == 0:
            # One residual per source is left: it is rounded by its own mass.
            draw = F.pmod(F.xxhash64("doc_id", "source", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
            last = level.where("copies IS NULL").withColumn("copies", F.col("base") + (draw < F.col("mass")).cast("int"))
            done = done.unionByName(last)
            break
    return done.select("doc_id", "source", "n_tokens", "copies").unionByName(others)


def report(mixed: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual share of every source, with sources that have records but no target."""
    got = mixed.where("copies > 0").groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("n_used"), F.max("copies").alias("most_copies")
    )
    total = F.broadcast(got.agg(F.sum("tokens").alias("total")))
    rows = plan(sizes, targets).join(
        sizes.groupBy("source").agg(F.sum("n_tokens").alias("held"), F.count("*").alias("n_held")), "source", "full"
    )
    return rows.join(got, "source", "left").join(total).select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("held", F.lit(0)).alias("available"), F.coalesce("n_held", F.lit(0)).alias("n_records"),
        F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )


def within(mixed: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, on_target, in_cap) of every target: whether its tokens miss their goal by less than its largest record,
    and whether no record is repeated more than its cap allows."""
    caps = targets.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.max(F.coalesce("max_repeats", F.lit(1))).alias("cap"))
    largest = sizes.groupBy("source").agg(F.max("n_tokens").alias("largest"))
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most"))
    rows = plan(sizes, targets).join(caps, "source").join(largest, "source", "left").join(got, "source", "left")
    return rows.select("source", (F.abs(F.coalesce("tokens", F.lit(0)) - F.col("goal")) <= F.coalesce("largest", F.lit(0)) + 1e-6).alias("on_target"), (F.coalesce("most", F.lit(0)) <= F.col("cap")).alias("in_cap"))
