import pytest

from lexquarry.llm.pii import Finder, personal_spans, redact, redacted

FINDER = Finder()


def found(text):
    return {(k, text[a:b]) for k, a, b in FINDER.spans(text)}


@pytest.mark.parametrize("text,want", [
    ("Witness Ilecio Begusil (SSS No. 2016-0331-4434) signed in front of Atty. Ysetzita D. Sasaras-Wenta.", {("name", "Ilecio Begusil"), ("id_number", "2016-0331-4434"), ("name", "Ysetzita D. Sasaras-Wenta")}),
    ("Contact: SELCESIL, Salavlda <s+work@office.dan.example>; (02) 8914-0236 loc. 12", {("name", "SELCESIL, Salavlda"), ("email", "s+work@office.dan.example"), ("phone", "(02) 8914-0236")}),
    ("Write to jane [at] mail [dot] test or b.lee at post dot example today.", {("email", "jane [at] mail [dot] test"), ("email", "b.lee at post dot example")}),
    ("See item 25 at 3 @ P76,051.56 each; follow @Norfigan.", set()),
    ("Complainant Oremvara Talpata of Rm. 221, Junvor Bldg., 28 Santa Fen Blvd., San Ficaras, Lutazo 6103 may be reached at 0902/5990114.", {("name", "Oremvara Talpata"), ("address", "Rm. 221, Junvor Bldg., 28 Santa Fen Blvd., San Ficaras, Lutazo 6103"), ("phone", "0902/5990114")}),
    ("Mail to P.O. Box 708, Ulviza City 9004. The board met.", {("address", "P.O. Box 708, Ulviza City 9004")}),
    ("although Jituven-Griran had moved to 36-A Fenkel Ext., San Beguso Subd., Renkadel, Opidel 9210.", {("name", "Jituven-Griran"), ("address", "36-A Fenkel Ext., San Beguso Subd., Renkadel, Opidel 9210")}),
    ("La Sra. De La Torusil vive en Avda. de Zivator, n.º 53, Tumelven City 2001 y su teléfono es +44 7700 900432.", {("name", "De La Torusil"), ("address", "Avda. de Zivator, n.º 53, Tumelven City 2001"), ("phone", "+44 7700 900432")}),
    ("投诉人Belinvara Cabaven的证件号码为248 870 816。请寄至沐安县远沐路232号9室。联系电话：11040774107，邮箱：a.b@c.example。", {("name", "Belinvara Cabaven"), ("id_number", "248 870 816"), ("address", "沐安县远沐路232号9室"), ("phone", "11040774107"), ("email", "a.b@c.example")}),
    ("住所は谷宮村野森町9丁目25-14です。連絡先は０９０－７７４４－１３６０、メールは", {("address", "谷宮村野森町9丁目25-14"), ("phone", "０９０－７７４４－１３６０")}),
    ("ऐसा डॉ. करुनाथ ने लिखा।", {("name", "करुनाथ")}),
    ("ويبلغ د. دلفي دلفاني بذلك. للتواصل: ٠٥٩ ٨٣١ ١٩١٩", {("name", "دلفي دلفاني"), ("phone", "٠٥٩ ٨٣١ ١٩١٩")}),
    ("Prepared by:\nKarita Ulavmar Jr.\nUnit 21A, 84 Jihelra Avenue, Vamel City\nTel. 632.8854.5428", {("name", "Karita Ulavmar Jr."), ("address", "Unit 21A, 84 Jihelra Avenue, Vamel City"), ("phone", "632.8854.5428")}),
    ("Invoice 2083-3414-1024 and SKU 1449-25-3882; Form version 54.81.27.7; NLRC Case No. RAB-35-8906-4; lot of 3630-1243 meters.", set()),
    ("Si\nG. Tatirtan at si Bb.\nUlcorven; ni G.\nPijunva.", {("name", "Tatirtan"), ("name", "Ulcorven"), ("name", "Pijunva")}),
    ("Mail to 341 Viwennor\nSt., Brgy. Cadamor, Santa\nUlkifa, Zivorro.", {("address", "341 Viwennor\nSt., Brgy. Cadamor, Santa\nUlkifa, Zivorro")}),
    ("Tadelra Manufacturing, Inc. posted a bond. The Cecara Doctrine holds. Pay P45,210.05.", set()),
])
def test_spans(text, want):
    assert found(text) == want


@pytest.mark.parametrize("text,want", [
    ("The letter was signed by Pedro Cruz and Ana Lim.", {("name", "Pedro Cruz"), ("name", "Ana Lim")}), ("Call 212-555-0199 or (415) 555-2671.", {("phone", "212-555-0199"), ("phone", "(415) 555-2671")}),
    ("SSN 123-45-6789", {("id_number", "123-45-6789")}), ("Ship to Block 5 Lot 3 Phase 2, Camella Homes, Bacoor, Cavite 4102.", {("address", "Block 5 Lot 3 Phase 2, Camella Homes, Bacoor, Cavite 4102")}),
    ("Hans Müller, Hauptstraße 5, 10115 Berlin", {("name", "Hans Müller"), ("address", "Hauptstraße 5, 10115 Berlin")}), ("He lives at 12 Rizal Street, Barangay Uno, Quezon City.", {("address", "12 Rizal Street, Barangay Uno, Quezon City")}),
    ("Write to 350 Fifth Avenue, New York, NY 10118 or phone +49 30 901820.", {("address", "350 Fifth Avenue, New York, NY 10118"), ("phone", "+49 30 901820")}),
    ("x" * 300 + "@mail.example and " + "y" * 200 + " at post dot example", {("email", "x" * 300 + "@mail.example"), ("email", "y" * 200 + " at post dot example")}),
    ("Prepared by " + "Bartholomew" * 9 + " Cruz.", set()), ("prepared by " + "Abcdefghij" * 9 + " Cruz.", set()), ("prepared by Maria Clara de la Cruz-Santos.", {("name", "Maria Clara de la Cruz-Santos")}),
    ("P1234567A and 12-3456789-0 are shapes; 1-2345 is none.", {("id_number", "P1234567A"), ("id_number", "12-3456789-0")}), ("Lot 212-555-0199 of 3,630.", set()),
])
def test_general_forms(text, want):
    assert found(text) == want


def test_many_spans_take_linear_time():
    import time

    took = []
    for n in (5_000, 20_000):
        began = time.perf_counter()
        assert len(FINDER.spans("Mr. Cruz left a@b.example. " * n)) == 2 * n
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0]


def test_redaction_leaves_the_rest():
    text = "Mr. Cruz (TIN 12-8112190-5) left."
    assert redact(text, FINDER.spans(text)) == "Mr. [NAME] (TIN [ID_NUMBER]) left."


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Mr.", "x"), (4, "@", "x"), (5, "Mr. Cruz left. " * 20_000, "x"), (6, "Mr. Cruz", "x"), (6, "Mr. Cruz", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    counts = {}
    for r in personal_spans(df).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {5: 20_000, 6: 2}
    assert {r.doc_id for r in redacted(df).collect()} == {2, 3, 4, 5, 6}
    assert personal_spans(df.limit(0)).count() == 0
