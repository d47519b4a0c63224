import pytest

from lexquarry.llm.encoding import garble
from lexquarry.llm.sentences import sentence_spans, sentence_units, stored_spans


def units(text):
    return [text[a:b] for a, b in sentence_spans(text)]


@pytest.mark.parametrize("parts", [
    ["Dr. Reyes met Atty. Cruz at 5:30 p.m.", "They left."],
    ["Payment of P5,389.34 is due to Acme Mfg. Co.", "Except where noted, see Sec. 4, Art. 5 and Nos. 2 and 3."],
    ["The sign reads: “Stop. Show it. Wait.”", "Next one!", "Is it (Sec. 3.) so?"],
    ["(See Rule X, Sec. 74.)", "Every unit counts."],
    ["The offer was posted ... and then withdrawn; it lapsed.", "eServices opened.", "v2.1 is used."],
    ["«No se puede», dijo la Sra. Paz.", "¡Nadie está en la Avda. Sol n.º 7!", "¿Está obligado?"],
    ["“用人单位不得拒绝。”主管这样写道。", "工会是否有权？", "严禁擅自……但须通知！"],
    ["「掲示してはならない。」と通知に書かれている。", "第3.5条（別紙No. 12を参照。）により提出します。"],
    ["“वह नहीं करेगा।” ऐसा डॉ. मति ने लिखा।", "क्या वह रखे?"],
    ["يلتزم د. دلفي بذلك.", "هل يحق له؟", "ممنوع!"],
    ["ตามข้อ 61.69 ของประกาศให้แจ้งโดยเร็ว", "ถ้าเกิน PHP 52,625.02 ให้ระงับไว้ก่อน"],
])
def test_joined_units_come_back(parts):
    glue = "" if any(c in parts[0] for c in "。！？") else " "
    assert units(glue.join(parts)) == parts
    assert units("\n\n".join(parts)) == parts


@pytest.mark.parametrize("text,lang,want", [
    ("Is it allowed? No. The board refused.", None, ["Is it allowed?", "No.", "The board refused."]), ("He got a G. It was final.", "en", ["He got a G.", "It was final."]),
    ("See Docket No. AF-7 and Nos. 2 and Sec. IV.", "en", ["See Docket No. AF-7 and Nos. 2 and Sec. IV."]), ("Ang sabi ni G. Cruz ay oo. Umalis na.", "fil", ["Ang sabi ni G. Cruz ay oo.", "Umalis na."]),
    ("La Sra. Paz salió. Llegó tarde.", "es", ["La Sra. Paz salió.", "Llegó tarde."]), ("The flight to Av. It left.", "en", ["The flight to Av.", "It left."]), ("Vive en la Av. Sol de Paz.", None, ["Vive en la Av. Sol de Paz."]),
    ("W. T. Cruz and Ana D. Lim met.", "en", ["W. T. Cruz and Ana D. Lim met."]), ("Supercalifragilisticexpialidociousness. It ended.", "xx", ["Supercalifragilisticexpialidociousness.", "It ended."]),
])
def test_abbreviations_by_language(text, lang, want):
    assert [text[a:b] for a, b in sentence_spans(text, lang)] == want


def test_enumeration():
    text = "The board shall, if asked, do the following:\n(i) keep it;\n\n(ii) send it; and\n(iii) close it.\nThen it\nends."
    assert units(text) == ["The board shall, if asked, do the following:", "(i) keep it;", "(ii) send it; and", "(iii) close it.", "Then it\nends."]


def test_edges(spark):
    assert units(None) == units("") == units(" \n\n ") == []
    assert units("no end") == ["no end"]
    assert units("a “open quote. Next one.") == ["a “open quote.", "Next one."]
    long = "One two. " * 50_000
    assert len(units(long)) == 50_000
    df = spark.createDataFrame([("t", 1, "A b. C d.", 5), ("t", 1, "A b. C d.", 6), ("t", 2, None, 7), ("t", 3, "", 8)], "tab string, rec_id long, text string, start_pos int")
    assert sorted(map(tuple, sentence_units(df).collect())) == [("t", 1, 0, 4)] * 2 + [("t", 1, 5, 9)] * 2
    assert sentence_units(df.limit(0)).count() == 0


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp1251"])
@pytest.mark.parametrize("parts", [["用人单位不得拒绝。", "工会是否有权？"], ["“Stop. Wait.”", "Señor Paz left — “so.”"], ["क्या वह रखे?", "धारा 4.71 के अनुसार दे।"], ["ตามข้อ 61.69 ของประกาศ", "ถ้าเกิน 5 ให้ระงับ"]])
def test_garbled_text_keeps_its_units(parts, wrong):
    bad = [garble(p, "utf-8", wrong) for p in parts]
    text = "\n\n".join(bad) + "\n\n" + ("" if "。" in parts[0] else " ").join(bad)
    assert [text[a:b] for a, b in stored_spans(text)] == bad * 2
