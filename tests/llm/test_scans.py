"""Scans with known noise are made from clean text; the operator must find what was put in."""

import random

from lexquarry.llm import scans

WORDS = "the licensed contractor shall provide protective clothing and report each accident within three days to field office before expiry of registration".split()


def made(seed=1, orders=6, pages=8):
    rnd = random.Random(seed)
    rows, want, rec = [], set(), 0
    for o in range(orders):
        for p in range(1, pages + 1):
            rec += 1
            lines = [f"Bureau of Field Standards | DO-{400 + o}-17", ""]
            if p % 3 == 0:
                lines[0] = lines[0].replace("Field", "F|eld")
            want.add((rec, 0, "header"))
            for _ in range(14):
                start = rnd.randrange(len(WORDS) - 9)
                line = " ".join(WORDS[start : start + 9])
                if rnd.random() < 0.1 and "accident" in line:
                    line = line.replace("accident", "acc1dent")
                    want.add((rec, len(lines), "misread"))
                lines.append(line)
            if p < pages:
                lines.append("the licensed contrac-")
                want.add((rec, len(lines) - 1, "hyphen"))
            if p > 1:
                lines[2] = "tor " + lines[2]
            lines += ["^", f"Page {p} of {pages}"]
            want |= {(rec, len(lines) - 2, "speck"), (rec, len(lines) - 1, "page_number")}
            rows.append(("scan_pages", rec, f"DO-{400 + o}-17", 1, p, "\n".join(lines), "x"))
    return rows, want


SCHEMA = "tab string, rec_id long, doc string, scan_no int, page_no int, text string, kind string"


def test_finds_what_was_put_in(spark):
    rows, want = made()
    got = {(r.rec_id, r.line_no, r.kind) for r in scans.noise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_repairs(spark):
    rows, _ = made()
    text = "\n".join(r.paragraph for r in scans.paragraphs(spark.createDataFrame(rows, SCHEMA)).collect())
    assert "Standards" not in text and "Page" not in text and "acc1dent" not in text and "contrac-" not in text
    assert "licensed contractor" in text


def test_edges(spark):
    rows = [("t", 1, None, None, None, None, ""), ("t", 2, "d", None, None, "", ""), ("t", 2, "d", None, None, "\n\n", ""), ("t", 3, "d", 1, None, "word-", ""), ("scan_pages", 4, None, None, 1, "a " * 100_000, "")]
    got = {tuple(r) for r in scans.noise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("t", 3, 0, "hyphen")}
    assert scans.noise(spark.createDataFrame([], SCHEMA)).count() == 0
    assert scans.paragraphs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_skeletons():
    for a, b in [("clinic", "chnic"), ("accident", "accldent"), ("hearing", "heanng"), ("autorizado", "aiitorizado"), ("human", "hurnan"), ("until", "unt|l"), ("percent", "pcrcent")]:
        assert scans.skeleton(a) == scans.skeleton(b)


def test_same_rows_in_a_larger_corpus_and_over_blocks_of_templates(spark, monkeypatch):
    rows, _ = made(orders=4)
    # A header that only one scan has, on pages of its own.
    rows += [("scan_pages", 900 + p, "DO-9-99", 1, p, f"Harbour Tally Annexe\n\nthe licensed contractor shall provide protective {w}\nclothing and report each accident within three days", "x") for p, w in ((1, "and"), (2, "of"), (3, "to"))]
    found = lambda rs: {(r.rec_id, r.line_no, r.kind) for r in scans.noise(spark.createDataFrame(rs, SCHEMA)).collect()}
    small = found(rows)
    assert {(900 + p, 0, "header") for p in (1, 2, 3)} <= small
    more = [(t, 1000 + 1000 * k + r, f"{d}{k}", s, p, x, y) for k in range(10) for t, r, d, s, p, x, y in rows]
    ids = {r[1] for r in rows}
    large = found(rows + more)
    assert {x for x in large if x[0] in ids} == small
    monkeypatch.setattr(scans, "TEMPLATE_BYTES", 100)
    assert found(rows) == small


def test_paragraphs_run_on_across_pages(spark):
    rows = [("scan_pages", p, "DO-1-01", 1, p, t, "x") for p, t in ((1, "One sentence ends here.\n\nAnother one is broken at the contrac-\n^"), (2, "tor and goes on\nto its end.\n\n(a) an item"))]
    got = [(r.rec_id, r.par_no, r.paragraph) for r in scans.paragraphs(spark.createDataFrame(rows, SCHEMA)).orderBy("par_no").collect()]
    assert got == [(1, 0, "One sentence ends here."), (1, 1, "Another one is broken at the contractor and goes on to its end."), (2, 2, "(a) an item")]
