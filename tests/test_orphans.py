import datetime as dt

from pyspark.sql import functions as F

from lexquarry.functions.keys import order_key
from lexquarry.operators import orphans

T = [dt.datetime(2024, m, 1) for m in range(1, 7)]


def test_keys(spark):
    forms = {
        "DO-174-17": "DO-174-17", "do-018-a-11": "DO-18-A-11", "D.O. No. 413-B, Series of 2013": "DO-413-B-13",
        "Department Order No. 402 (2012)": "DO-402-12", " DO‑417‑A‑18\t": "DO-417-A-18", "DO 404-C-00": "DO-404-C-00",
        "": None, "RA 7641": None, "DO-1": None,
    }
    rows = spark.createDataFrame(list(forms.items()), "s string, e string").select("s", "e", order_key(F.col("s")).alias("k")).collect()
    assert all(r.k == r.e for r in rows), rows


def parents(spark, rows):
    return orphans.lives(spark.createDataFrame(rows, "k string, d boolean, loaded_at timestamp_ntz, rec_id long, tab string"), "k", "d", "loaded_at", "rec_id")


def refs(spark, rows):
    return spark.createDataFrame(rows, "tab string, rec_id long, order_key string, loaded_at timestamp_ntz, born string")


def test_reasons(spark):
    p = parents(spark, [
        ("a", False, T[0], 1, ""), ("b", False, T[0], 2, ""), ("b", True, T[2], 3, ""), ("c", False, T[4], 4, ""),
        ("d", True, T[1], 5, ""), ("d", False, T[1], 6, ""), ("e", None, None, 7, ""), (None, True, T[0], 8, ""),
    ])
    r = refs(spark, [("t", i, k, T[3], "") for i, k in enumerate(["a", "b", "c", "d", "e", "z", None, "z"])] + [("t", 5, "z", T[3], ""), ("t", 9, "c", None, "")])
    got = {(x.rec_id, x.order_key, x.reason, x.load_month) for x in orphans.orphans(r, p).collect()}
    assert got == {(1, "b", "deleted", "2024-04"), (2, "c", "late", "2024-04"), (5, "z", "missing", "2024-04"), (7, "z", "missing", "2024-04")}


def test_hot_key_equals_plain(spark):
    p = parents(spark, [("hot", True, T[0], 1, ""), ("k", False, T[5], 2, "")])
    r = refs(spark, [("t", i, "hot" if i % 3 else "k", T[3], "") for i in range(900)])
    plain = sorted(map(tuple, orphans.orphans(r, p).collect()))
    salted = sorted(map(tuple, orphans.orphans(r.repartition(4), p, hot_share=3, spread=5, least=1).collect()))
    assert plain == salted and len(plain) == 900


def test_empty(spark):
    assert orphans.orphans(refs(spark, []), parents(spark, [])).count() == 0
    assert orphans.orphans(refs(spark, [("t", 1, "a", T[0], "")]), parents(spark, [])).first().reason == "missing"
