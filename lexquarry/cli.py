"""Command line: ``python -m lexquarry.cli COMMAND …``; exits with 1 if anything is wrong."""

from __future__ import annotations

import argparse
import hashlib
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, functions as F

from lexquarry.functions import dates
from lexquarry.functions.text import strip
from lexquarry.operators import manifest, nested, orders, pages, rules, statute, status
from lexquarry.session import local_session
from lexquarry.sources import files, pdf, tools


def texts_of(spark, path: str) -> DataFrame:
    """(doc_id, value, info_title): reviewed texts, or the text of PDF files where the path names such."""
    if path.endswith(".pdf"):
        paged = pdf.pdf_pages(spark, path)
        titles = paged.groupBy("doc_id").agg(F.first(F.try_element_at("info", F.lit("Title"))).alias("info_title"))
        return pdf.pdf_texts(paged).join(titles, "doc_id")
    return files.page_texts(spark, path).withColumn("info_title", F.lit(None).cast("string"))


def full_texts(spark, path: str) -> DataFrame:
    """(doc_id, info_title, text): whole cleaned texts without running lines but for their first mention.

    A word broken over a page is joined, as the pages are cleaned together. A text that has nothing left
    is the text of its first page.
    """
    docs = texts_of(spark, path)
    paged = pages.clean_pages(pages.split_pages(docs))
    running = pages.running_lines(paged, ["doc_id"])
    whole = pages.clean_pages(docs.select("doc_id", "info_title", F.regexp_replace("value", "\f", "").alias("raw"), F.lit(1).alias("page_no")))
    kept = pages.without_running_lines(whole, running, ["doc_id"]).select("doc_id", "info_title", F.col("content").alias("text"))
    first = paged.where("page_no = 1").select("doc_id", F.col("content").alias("first"))
    return kept.join(first, "doc_id", "left").select("doc_id", "info_title", F.when(strip(F.col("text")) == "", F.col("first")).otherwise(F.col("text")).alias("text"))


def _report(name: str, found: DataFrame, kind: str) -> int:
    """Print the problems with their counts; 1 if there are any."""
    found = found.cache()
    found.show(100, False)
    rules.counts(found, kind).show(100, False)
    n = found.count()
    found.unpersist()
    print(f"{name}: {n} problems")
    return int(n > 0)


def parse_orders(spark, args) -> int:
    """Order and section tables of page texts, as Parquet; problems are printed."""
    docs = full_texts(spark, args.source).withColumn("file_name", F.col("doc_id"))
    if args.only:
        docs = docs.where(F.col("doc_id").isin(args.only))
    docs = docs.withColumn("published", dates.given_date(F.lit(args.published_date))).withColumn("effective_given", F.lit(args.effective_date)).withColumn("source_url", F.lit(args.source_url))
    docs = docs.withColumn("order_number", orders.refs.order_number(F.col("text"), F.col("file_name")))
    if args.manifest:
        entries = manifest.chosen(files.manifest(spark, args.manifest), args.only)
        pins = entries.select(F.col("id").alias("entry_id"), F.col("kind").alias("entry_kind"), F.col("source_url").alias("_url"), F.col("published_date").alias("_day"), "superseded_by", "sha256")
        docs = docs.join(pins, docs.order_number == pins.entry_id, "left").withColumn("source_url", F.coalesce("source_url", "_url")).withColumn("published", F.coalesce("published", dates.given_date(F.col("_day")))).drop("_url", "_day")
    else:
        docs = docs.withColumns({"entry_id": F.lit(None).cast("string"), "entry_kind": F.lit(None).cast("string")})
    found, parts = orders.order_records(docs.drop("order_number"))
    found.write.mode("overwrite").parquet(f"{args.target}/orders")
    parts.write.mode("overwrite").parquet(f"{args.target}/sections")
    wrong = orders.problems(docs)
    if args.manifest:
        wrong = wrong.unionByName(docs.where("source_url IS NULL").select("doc_id", F.lit("no_source_url").alias("problem")))
    return _report("orders", wrong, "problem")


def parse_code(spark, args) -> int:
    """Article records of page texts, as Parquet or, for one document, as a sorted JSON array.

    A status review is applied to documents whose hash it names; articles of others have no status.
    """
    docs = pages.clean_pages(pages.split_pages(texts_of(spark, args.source)))
    found = statute.footnotes(docs)
    hashes = files.hashed(spark, args.source).select(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("doc_id"), "sha256")
    texts = found.where("text IS NOT NULL").select("doc_id", "text").join(hashes, "doc_id", "left")
    records = statute.records(texts, found.where("note_number IS NOT NULL"))
    if args.status:
        reviewed, changes, unaffected = files.status_review(spark, args.status)
        mine = records.where(F.col("provenance.source_sha256") == reviewed)
        notes = mine.select("article_number", F.explode(F.concat(F.transform("footnotes", lambda n: F.struct(n["note_number"], n["note_text"])), F.transform("heading_footnotes", lambda n: F.struct(n["note_number"], n["note_text"])))).alias("n"))
        notes = notes.select("article_number", F.col("n.note_number").alias("footnote"), F.col("n.note_text").alias("note_text"))
        if not mine.isEmpty():
            status.reconciled(mine.select("article_number"), notes, changes, unaffected)
        rolled = status.applied(records.select("article_number", F.col("provenance.source_sha256").alias("sha256")), changes, reviewed)
        records = records.withColumn("sha256", F.col("provenance.source_sha256")).join(rolled.select("article_number", "sha256", F.struct("status", "changes").alias("legal_status")), ["article_number", "sha256"], "left").drop("sha256")
    if args.target.endswith(".json"):
        print(files.write_sorted(records, args.target, "article_number"), "articles")
    else:
        records.orderBy("doc_id", "article_number").write.mode("overwrite").parquet(args.target)
    return 0


def validate(spark, args) -> int:
    """Errors of JSON files against a schema."""
    with open(files.find_upward(args.schema) or args.schema, encoding="utf-8") as f:
        schema = json.load(f)
    schema = schema | schema["items"] if schema.get("type") == "array" and "properties" in schema.get("items", {}) else schema
    found = rules.errors(nested.records(files.json_records(spark, args.source).withColumnRenamed("path", "file"), "file"), schema, ["file", "record_path"])
    return _report("validation", found, "message")


def check_manifest(spark, args) -> int:
    """Broken rules of a manifest."""
    return _report("manifest", manifest.problems(manifest.chosen(files.manifest(spark, args.source), args.only)), "problem")


def fetch(spark, args) -> int:
    """Download the files of a manifest and compare their hashes; files that differ from their pin are never replaced."""
    wrong, outcomes = 0, []
    for r in manifest.chosen(files.manifest(spark, args.source), args.only).collect():
        path = Path(args.target) / f"{r.id}.pdf"
        outcome = "verified"
        if not path.exists() and r.download_url:
            try:
                tools.download(r.download_url, str(path))
                outcome = "downloaded"
            except (OSError, ValueError) as e:
                outcome = f"failed: {e}"
        if not path.exists():
            outcome = outcome if outcome.startswith("failed") else f"manual: save {r.source_url} as {path}"
        else:
            found = hashlib.sha256(path.read_bytes()).hexdigest()
            outcome = f"unpinned: {found}" if r.sha256 is None else outcome if r.sha256 == found else f"mismatch: {found}"
        outcomes.append((r.id, outcome))
        wrong += outcome.split(":")[0] in ("failed", "mismatch", "manual")
    for name, outcome in outcomes:
        print(name, outcome)
    print(f"fetch: {wrong} problems")
    return int(wrong > 0)


def ocr(spark, args) -> int:
    """Read the scanned files of a manifest with the scan tools; reviewed texts stay as they are unless --force."""
    wrong = 0
    for r in manifest.chosen(files.manifest(spark, args.source), args.only, scanned=True).collect():
        try:
            tools.recognised(str(Path(args.target) / f"{r.id}.pdf"), str(Path(args.target) / f"{r.id}.txt"), replace=args.force, first_page=r.ocr_first_page)
        except (RuntimeError, FileExistsError) as e:
            print(r.id, e)
            wrong += 1
    print(f"ocr: {wrong} problems")
    return int(wrong > 0)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexquarry", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for name, run, more, options in (
        ("parse-orders", parse_orders, ["target"], ("published-date", "effective-date", "source-url", "manifest")), ("parse-code", parse_code, ["target"], ("status",)),
        ("validate", validate, [], ("schema",)), ("check-manifest", check_manifest, [], ()),
        ("fetch", fetch, ["target"], ()), ("ocr", ocr, ["target"], ()),
    ):
        p = commands.add_parser(name, help=run.__doc__)
        p.add_argument("source")
        for m in more:
            p.add_argument(m)
        for o in options:
            p.add_argument(f"--{o}", required=o == "schema")
        p.add_argument("--only", action="append", help="an id; may be repeated")
        p.add_argument("--force", action="store_true", help="replace reviewed texts")
        p.set_defaults(run=run)
    args = parser.parse_args(argv)
    return args.run(local_session(), args)


def entry() -> None:
    sys.exit(main())


if __name__ == "__main__":
    entry()
