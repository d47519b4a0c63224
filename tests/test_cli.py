"""The command line over small files, and known records where a folder with them is named."""

import json
import os
from pathlib import Path

import pytest

from lexquarry import cli, session
from lexquarry.sources import files

ORDER = (
    "Republic\nDEPARTMENT ORDER NO. 202-19\nSeries of 2019\n\nRULES ON\nREMOTE WORK\nPursuant to R.A. No. 11165:\nSection 1. Scope. — All.\n"
    "Section 2. Effectivity. — This shall take effect ten (10) days after publi-\n\fcation.\n\nDone this 26 March 2019.\n\nANA B. REYES\nSecretary of Labor"
)


@pytest.fixture
def quiet(monkeypatch, spark):
    monkeypatch.setattr(cli, "local_session", lambda: spark)


def test_orders(quiet, spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "DO-202-19.txt").write_text(ORDER)
    (tmp_path / "in" / "empty.txt").write_text(" ")
    (tmp_path / "m.toml").write_text('[[document]]\nid = "DO-202-19"\nkind = "dole_order"\ntitle = "t"\nsource_url = "https://x.example"\npublished_date = "2019-04-01"\n')
    assert cli.main(["parse-orders", str(tmp_path / "in"), str(tmp_path / "out"), "--manifest", str(tmp_path / "m.toml")]) == 1  # the empty text
    r = spark.read.parquet(str(tmp_path / "out/orders")).first()
    assert (r.order_number, r.source_url, str(r.published_date), str(r.effective_date)) == ("DO-202-19", "https://x.example", "2019-04-01", "2019-04-11")
    assert cli.main(["parse-orders", str(tmp_path / "in"), str(tmp_path / "out"), "--only", "DO-202-19", "--effective-date", "2020-01-02", "--source-url", "https://y.example"]) == 0
    r = spark.read.parquet(str(tmp_path / "out/orders")).first()
    assert (r.source_url, str(r.effective_date)) == ("https://y.example", "2020-01-02") and spark.read.parquet(str(tmp_path / "out/sections")).count() == 2


def test_code(quiet, spark, tmp_path):
    text = "BOOK ONE\nTITLE I – WAGES\nArt. 6. Rest — A day.\nArt. 5. Pay.1 – Workers shall be paid.\n1 Repealed by R.A. No. 1.\n\fArt. 7. More — x."
    (tmp_path / "code.txt").write_text(text)
    sha = files.hashed(spark, str(tmp_path / "code.txt")).first().sha256
    for hash_, want in ((sha, {5: "superseded", 6: "no_change_noted", 7: "no_change_noted"}), ("0" * 64, {5: None, 6: None, 7: None})):
        (tmp_path / "s.toml").write_text(f'source_sha256 = "{hash_}"\n[[change]]\narticles = "5"\nfootnote = 1\neffect = "repealed"\nby = "RA 1"\n')
        assert cli.main(["parse-code", str(tmp_path / "code.txt"), str(tmp_path / "out.json"), "--status", str(tmp_path / "s.toml")]) == 0
        rows = json.loads((tmp_path / "out.json").read_text())
        assert [r["article_number"] for r in rows] == [5, 6, 7] and {r["article_number"]: r.get("legal_status", {}).get("status") for r in rows} == want
        assert rows[0]["provenance"]["source_sha256"] == sha


def test_validate_and_manifest(quiet, tmp_path):
    (tmp_path / "schema.json").write_text(json.dumps({"type": "object", "required": ["order_number"]}))
    for text, code in (({"order_number": "DO-1-01"}, 0), ({"title": "x"}, 1)):
        (tmp_path / "r.json").write_text(json.dumps(text))
        assert cli.main(["validate", str(tmp_path / "r.json"), "--schema", str(tmp_path / "schema.json")]) == code
    (tmp_path / "m.toml").write_text('[[document]]\nid = "bad id"\nkind = "labor_code"\ntitle = "t"\nsource_url = "https://x.example"\n')
    assert cli.main(["check-manifest", str(tmp_path / "m.toml")]) == 1 and cli.main(["check-manifest", str(tmp_path / "m.toml"), "--only", "none"]) == 0


def test_fetch(quiet, tmp_path, capsys):
    import hashlib

    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.pdf").write_bytes(b"%PDF-" + name.encode())
    sha = hashlib.sha256(b"%PDF-a").hexdigest()
    entry = '[[document]]\nid = "{}"\nkind = "labor_code"\ntitle = "t"\nsource_url = "https://x.example"\n'
    (tmp_path / "m.toml").write_text(entry.format("a") + f'sha256 = "{sha}"\n' + entry.format("b") + f'sha256 = "{sha}"\n' + entry.format("c") + entry.format("d"))
    assert cli.main(["fetch", str(tmp_path / "m.toml"), str(tmp_path)]) == 1
    said = dict(line.split(" ", 1) for line in capsys.readouterr().out.splitlines())
    assert said["a"] == "verified" and said["b"].startswith("mismatch") and said["c"].startswith("unpinned: ") and said["d"].startswith("manual") and said["fetch:"] == "2 problems"
    assert cli.main(["fetch", str(tmp_path / "m.toml"), str(tmp_path), "--only", "a"]) == 0


def test_paths_and_texts(tmp_path, monkeypatch):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "m.toml").write_text("")
    assert files.find_upward("m.toml", str(tmp_path / "a/b")) == tmp_path / "m.toml" and files.find_upward("no-such-file", str(tmp_path)) is None
    files.write_text("one", str(tmp_path / "t.txt"))
    with pytest.raises(FileExistsError):
        files.write_text("two", str(tmp_path / "t.txt"))
    files.write_text("two", str(tmp_path / "t.txt"), replace=True)
    assert (tmp_path / "t.txt").read_text() == "two"


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(RuntimeError):
        session.cut(Frame())


GOLDEN = os.environ.get("LEXQUARRY_GOLDEN")


@pytest.mark.skipif(not GOLDEN, reason="LEXQUARRY_GOLDEN names no folder with texts/*.txt and records/*.json")
@pytest.mark.parametrize("name", ["DO-202-19", "DO-230-21"])
def test_known_records(spark, name):
    known = json.loads((Path(GOLDEN) / "records" / f"{name}.json").read_text())
    docs = cli.full_texts(spark, str(Path(GOLDEN) / "texts" / f"{name}.txt"))
    from lexquarry.operators import orders
    from pyspark.sql import functions as F

    docs = docs.withColumn("file_name", F.col("doc_id")).withColumn("published", F.lit(known["metadata"].get("published_date")).cast("date"))
    found, parts = orders.order_records(docs)
    r, meta = found.first(), known["metadata"]
    got = {
        "order_number": r.order_number, "title": r.title, "authority": r.issuing_authority, "supersedes": r.supersedes, "laws": r.related_laws, "tags": r.tags, "clause": r.effectivity_clause,
        "signed": str(r.signed_date), "effective": str(r.effective_date),
    }
    assert got == {
        "order_number": known["order_number"], "title": known["title"], "authority": meta["issuing_authority"], "supersedes": meta["supersedes"], "laws": meta["related_laws"], "tags": meta["tags"],
        "clause": meta.get("effectivity_clause"), "signed": str(meta.get("signed_date")), "effective": str(known.get("effective_date")),
    }

    def flat(items, above=None):
        for i in items:
            path = i["label"] if above is None else f"{above}/{i['label']}"
            yield path, i["content"]
            yield from flat(i.get("subsections", []), path)

    own = [(s.section_number, s.title, s.content, [(i.path, i.content) for i in s.subsections]) for s in parts.orderBy("ord").collect()]
    assert own == [(s["section_number"], s.get("title"), s["content"], list(flat(s.get("subsections", [])))) for s in known["sections"]]
