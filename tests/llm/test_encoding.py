import pytest

from lexquarry.llm import encoding
from lexquarry.llm.encoding import garble, ungarbled

CLEAN = [
    "La señora pidió al almacén de Peñas — “piece rate” de ₱45.10 según el Art. 5.", "SÃO TELMIRO ± 16 days, CONVENÇÃO DE Âncora", "¼ load lifts 3 kg., n.º 7, «No se puede», ¿Está? ¡Nadie!",
    "用人单位应当在36日内退还被扣留的证件。“是否有权？”第1602号表格……但须", "使用者は、26日以内に掲示しなければならない。", "ตามข้อ 61.69 ของประกาศให้แจ้ง", "नियोक्ता को चाहिए कि वह सूची 7730 दिन तक रखे।", "يجب على صاحب العمل دفع الفرق",
]
LONG = [CLEAN[0], *CLEAN[3:]]


def frame(spark, texts):
    return spark.createDataFrame([("t", i, "f", t, "x") for i, t in enumerate(texts)], "tab string, rec_id long, field string, text string, form string")


def restored(spark, texts):
    return {r.rec_id: r.restored for r in encoding.restored(frame(spark, texts)).collect()}


def test_round_trip_alone_and_among_clean_texts(spark):
    bad = {(i, w): garble(t, "utf-8", w) for i, t in enumerate(LONG) for w in ("cp1252", "latin-1", "mac_roman", "cp1251", "cp437")}
    got = restored(spark, [*bad.values()])
    assert [got.get(k) for k in range(len(bad))] == [LONG[i] for i, _ in bad]
    got = restored(spark, [*CLEAN * 3, *bad.values()])
    assert set(got) == set(range(3 * len(CLEAN), 3 * len(CLEAN) + len(bad)))
    assert [got[3 * len(CLEAN) + k] for k in range(len(bad))] == [LONG[i] for i, _ in bad]


def test_twice():
    assert ungarbled(garble(garble("ñ", "utf-8", "cp1252"), "utf-8", "cp1252"), True) == "ñ"


def test_phrase_inside_clean_east_asian_text(spark):
    phrase, clean = "必须在港泽镇厂内", "用人单位应当保存值班表"
    texts = [CLEAN[3], CLEAN[4], clean, f"工会的{phrase}证件是"]
    for wrong in ("gb18030", "big5"):
        bad = garble(phrase, "utf-8", wrong)
        texts += [clean[:n] + bad + clean[:3] for n in (0, 1, 5, 8)] + ["字" * 60 + bad]
    got = restored(spark, texts)
    assert set(got) == set(range(4, len(texts)))
    assert got[4] == phrase + clean[:3] and got[6] == clean[:5] + phrase + clean[:3] and got[8] == "字" * 60 + phrase


def test_nothing_is_too_long(spark):
    word = "señalado" + "ísimamente" * 9
    texts = [f"Lo {word} aquí", f"Es {word} hoy", f"muy {garble(word, 'cp1252', 'cp850')}", "nota " + "x" * 60 + garble("señor", "utf-8", "cp1252"), "día 5 días-7años", "día 5 " + garble("días-7años", "cp1252", "mac_roman")]
    got = restored(spark, texts)
    assert set(got) == {2, 3, 5} and got[2] == f"muy {word}" and got[3] == "nota " + "x" * 60 + "señor" and got[5] == "día 5 días-7años"


def test_words_that_occur_garbled_only(spark):
    texts = [garble(f"a {w} rule", "utf-8", wrong) for w in ("½-day", "35°") for wrong in ("cp1252", "mac_roman", "cp437")] + [garble("one ½-day", "cp1252", "mac_roman"), garble("at 17° now", "cp1252", "cp437")]
    got = restored(spark, texts)
    assert set(got) == set(range(8)) and got[6] == "one ½-day" and got[7] == "at 17° now"


def test_masked_digits_are_those_of_the_text(spark):
    texts = ["artículo1234º", "artículo9º", garble("artículo77º", "cp1252", "cp437")]
    assert restored(spark, texts) == {2: "artículo77º"}


def test_records(spark):
    bad = {
        len(CLEAN) * 3 + 0: garble("La señora pidió", "cp1252", "mac_roman"), len(CLEAN) * 3 + 1: "lost � here", len(CLEAN) * 3 + 2: "odd \x93quote\x94",
        len(CLEAN) * 3 + 3: garble("el almacén", "cp1252", "cp850"), len(CLEAN) * 3 + 4: garble("Café señora", "utf-8", "gb18030"),
    }
    got = restored(spark, CLEAN * 3 + list(bad.values()) + [None, ""])
    assert set(got) == set(bad)
    first = len(CLEAN) * 3
    assert got[first] == "La señora pidió" and got[first + 3] == "el almacén" and "señora" in got[first + 4]


def test_edges(spark):
    assert encoding.garbled(frame(spark, [None, "", "plain " * 50_000])).count() == 0
    assert encoding.garbled(spark.createDataFrame([], "tab string, rec_id long, field string, text string")).count() == 0


def test_copies_do_not_vote(spark):
    bad = garble("Aviso señalado", "cp1252", "cp437")
    texts = ["Lo señalado aquí", "Plazo señalado hoy", *[bad] * 30]
    assert {r.rec_id for r in encoding.garbled(frame(spark, texts)).collect()} == set(range(2, 32))


@pytest.mark.parametrize("form", ["a", "ñé", "鐢ㄤ汉"])
def test_places_agree(form):
    import numpy as np

    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in encoding.points_of(form).astype(np.uint64):
            h = h * encoding.FACTOR + p
    assert int(h >> np.uint64(40)) == encoding.place(form)
