"""Readers and writers: reviewed page text, hashed files, TOML tables, JSON records."""

from __future__ import annotations

import json
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

SOURCES = "id string, kind string, title string, source_url string, download_url string, published_date string, sha256 string, ocr boolean, ocr_first_page int, superseded_by string"
CHANGES = "file_ord int, first int, last int, footnote int, effect string, by string, part string"
UNAFFECTED = "footnote int, reason string"
#: Fixed value: the first bytes of a PDF file.
PDF_MAGIC = "%PDF-"


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, value): whole text files, named by their stems; pages inside are separated by form feeds."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("doc_id"), "value")


def hashed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256, is_pdf) of files."""
    df = spark.read.format("binaryFile").load(path)
    return df.select("path", "length", F.sha2("content", 256).alias("sha256"), (F.decode(F.substring("content", 1, len(PDF_MAGIC)), "ISO-8859-1") == PDF_MAGIC).alias("is_pdf"))


def find_upward(name: str, start: str | None = None) -> Path | None:
    """The path ``name`` in a folder or the nearest one above it that has it."""
    at = Path(start or ".").resolve()
    return next((folder / name for folder in (at, *at.parents) if (folder / name).exists()), None)


def _rows(data: list[dict], columns: str) -> list[tuple]:
    names = [c.split()[0] for c in columns.split(", ")]
    for row in data:
        if unknown := set(row) - set(names):
            raise ValueError(f"unknown fields: {sorted(unknown)}")
    return [tuple(row.get(n) for n in names) for row in data]


def manifest(spark: SparkSession, path: str, table: str = "document") -> DataFrame:
    """The source manifest from TOML; unknown fields are an error, ``ocr`` defaults to false."""
    with open(path, "rb") as f:
        data = [{"ocr": False} | r for r in tomllib.load(f)[table]]
    return spark.createDataFrame(_rows(data, SOURCES), SOURCES)


def status_review(spark: SparkSession, path: str) -> tuple[str, DataFrame, DataFrame]:
    """(hash of the reviewed file, changes, unaffected notes) from TOML; "12-15" is a range of articles."""
    with open(path, "rb") as f:
        data = tomllib.load(f)
    changes = []
    for i, row in enumerate(data.get("change", [])):
        first, _, last = str(row.pop("articles")).partition("-")
        changes.append({"file_ord": i, "first": int(first), "last": int(last or first), **row})
    return data["source_sha256"], spark.createDataFrame(_rows(changes, CHANGES), CHANGES), spark.createDataFrame(_rows(data.get("no_change", []), UNAFFECTED), UNAFFECTED)


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload): whole JSON files, for the VARIANT operators."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def write_pretty(record: dict | list, path: str, replace: bool = True) -> None:
    """One record, or the sorted records of one document, as indented JSON with a final line feed.

    The file is written aside and renamed, so readers never see half of it.
    """
    target = Path(path)
    if target.exists() and not replace:
        raise FileExistsError(path)
    part = target.with_name(target.name + ".part")
    part.write_text(json.dumps(record, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    part.replace(target)


def write_sorted(records: DataFrame, path: str, by: str, replace: bool = True) -> int:
    """The records of one document as an indented JSON array in the order of ``by``; how many there are.

    One document goes to one file, so its records must fit in the driver; write many documents as Parquet.
    """
    rows = [json.loads(r.j) for r in records.orderBy(by).select(F.to_json(F.struct(*records.columns)).alias("j")).toLocalIterator()]
    write_pretty(rows, path, replace)
    return len(rows)


def write_text(text: str, path: str, replace: bool = False) -> None:
    """A reviewed text; an existing file stays as it is unless ``replace``."""
    target = Path(path)
    if target.exists() and not replace:
        raise FileExistsError(path)
    part = target.with_name(target.name + ".part")
    part.write_text(text, encoding="utf-8")
    part.replace(target)
