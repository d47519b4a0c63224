"""Readers, writers and the stream of pages."""

import hashlib
import json

import pytest

from lexquarry.sources import files
from lexquarry.streaming import pages as streaming


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "DO-1-01.txt").write_text("one\ftwo")
    assert [tuple(r) for r in files.page_texts(spark, str(tmp_path / "t")).collect()] == [("DO-1-01", "one\ftwo")]
    row = files.hashed(spark, str(tmp_path / "t")).first()
    assert row.sha256 == hashlib.sha256(b"one\x0ctwo").hexdigest() and not row.is_pdf


def test_toml(spark, tmp_path):
    p = tmp_path / "m.toml"
    p.write_text('[[document]]\nid = "DO-1-01"\nkind = "dole_order"\ntitle = "t"\nsource_url = "https://x.example"\n')
    assert files.manifest(spark, str(p)).first().ocr is False
    p.write_text('[[document]]\nid = "x"\nother = 1\n')
    with pytest.raises(ValueError):
        files.manifest(spark, str(p))
    p.write_text('source_sha256 = "ab"\n[[change]]\narticles = "3-5"\nfootnote = 1\neffect = "repealed"\nby = "RA 1"\n[[no_change]]\nfootnote = 2\nreason = "r"\n')
    sha, changes, free = files.status_review(spark, str(p))
    assert sha == "ab" and tuple(changes.first())[:4] == (0, 3, 5, 1) and free.first().footnote == 2


def test_pretty_json(tmp_path):
    p = tmp_path / "o.json"
    files.write_pretty({"a": ["ñ"]}, str(p))
    assert p.read_text() == '{\n  "a": [\n    "ñ"\n  ]\n}\n' and json.loads(p.read_text()) == {"a": ["ñ"]}
    with pytest.raises(FileExistsError):
        files.write_pretty({}, str(p), replace=False)


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("x  y\f")
    (folder / "b.txt").write_text("z" * 60)
    query = streaming.arriving_pages(spark, str(folder)).writeStream.format("memory").queryName("arrived").trigger(availableNow=True).start()
    query.awaitTermination(60)
    rows = {(r.doc_id, r.page_no): (r.content, r.warning) for r in spark.sql("SELECT * FROM arrived").collect()}
    assert rows == {("a", 1): ("x y", "low_char_count"), ("a", 2): ("", "empty_page"), ("b", 1): ("z" * 60, None)}
    counted = streaming.warnings_by_hour(streaming.arriving_pages(spark, str(folder)))
    query = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sum(r.n_pages for r in spark.sql("SELECT * FROM counted").collect()) == 3


def test_command_line(spark, tmp_path):
    from lexquarry import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "DO-5-01.txt").write_text("DEPARTMENT ORDER NO. 5-01\nRULES ON PAY\nSection 1. Scope. — All.\n\nDone this 2 May 2001.")
    assert cli.main(["parse-orders", str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "orders")).first().title == "RULES ON PAY"
    (tmp_path / "in" / "DO-5-01.txt").write_text("BOOK ONE\nArt. 1. Name — Text.1\n1 As amended by R.A. No. 10.")
    assert cli.main(["parse-code", str(tmp_path / "in"), str(tmp_path / "code")]) == 0
    assert spark.read.parquet(str(tmp_path / "code")).first().content == "Text."
    (tmp_path / "r.json").write_text('{"id": 3}')
    (tmp_path / "s.json").write_text('{"type": "object", "properties": {"id": {"type": "string"}}}')
    assert cli.main(["validate", str(tmp_path / "r.json"), "--schema", str(tmp_path / "s.json")]) == 1
    (tmp_path / "m.toml").write_text('[[document]]\nid = "DO-1-01"\nkind = "dole_order"\ntitle = "t"\nsource_url = "https://x.example"\n')
    assert cli.main(["check-manifest", str(tmp_path / "m.toml")]) == 0
