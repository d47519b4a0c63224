"""Column functions on literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexquarry.functions import dates, refs, text


def one(spark, column, *values):
    names = [f"v{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {'date' if isinstance(v, dt.date) else 'string'}" for n, v in zip(names, values))
    return spark.createDataFrame([tuple(values)], schema).select(column(*map(F.col, names)).alias("r")).first().r


@pytest.mark.parametrize("raw,want", [
    ("The emplo-\nyer pays", "The employer pays"), ("Order 174-\n17", "Order 174-\n17"), ("a\r\nb\rc", "a\nb\nc"), ("Page 3 of 12\nBody\n- 4 -\n2/9", "Body"),
    ("Body\n\n7\n\nmore", "Body\n\nmore"), ("Body\n7\nmore", "Body\n7\nmore"), ("Coverage ........ 3\nBody", "Body"), ("x  y\t\tz   \n  indented", "x y z\n  indented"), ("a\n\n\n\nb", "a\n\nb"),
    ("NiÃ±o â€œsaidâ€\x9d Â§ 3", "Niño “said” § 3"), ("bell\x07", "bell"), ("Pay . . . . . 12\nx", "x"), ("." * 60_000 + " end", "." * 60_000 + " end"), ("", ""), (None, None),
])
def test_clean(spark, raw, want):
    assert one(spark, text.clean, raw) == want


@pytest.mark.parametrize("raw,want", [("", "empty_page"), (" \n\t", "empty_page"), ("x" * 49, "low_char_count"), ("ñ" * 50, None), (None, None)])
def test_page_warning(spark, raw, want):
    assert one(spark, text.page_warning, raw) == want


def test_capitals(spark):
    assert one(spark, text.mostly_capitals, "RULES ON Pay") and not one(spark, text.mostly_capitals, "Rules on Pay") and not one(spark, text.mostly_capitals, "123 -")
    assert one(spark, text.capital_heading, "NIGHT WORK") and not one(spark, text.capital_heading, "Ñ" * 41)


@pytest.mark.parametrize("values,want", [([3, 1, 2], 2), ([4, 1, 3, 2], 3), ([], None)])
def test_upper_median(spark, values, want):
    df = spark.createDataFrame([(values,)], "v array<int>")
    assert df.select(text.upper_median(F.col("v")).alias("m")).first().m == want


@pytest.mark.parametrize("raw,want", [
    ("Done this 16th day of March, 2017, see May 1, 2020", dt.date(2017, 3, 16)), ("26 MAR, 2019", dt.date(2019, 3, 26)), ("Sept 5 2001", dt.date(2001, 9, 5)),
    ("February 30, 2020 or March 1, 2020", None), ("February 30, 2020 or 2 March 2020", dt.date(2020, 3, 2)), ("no date", None), ("", None), (None, None),
])
def test_first_date(spark, raw, want):
    assert one(spark, dates.first_date, raw) == want


P, S = dt.date(2019, 4, 25), dt.date(2019, 3, 26)


@pytest.mark.parametrize("clause,published,signed,want", [
    ("effect fifteen (15) days after its publication", P, S, dt.date(2019, 5, 10)), ("effect fifteen (15) days after its publication", None, S, None),
    ("effect ten working days after publication", P, S, None), ("effect immediately", P, S, S), ("effect upon publication", P, S, P), ("effect 10 days from approval", P, S, dt.date(2019, 4, 5)),
    ("effect on June 1, 2020, ten working days hence", P, S, dt.date(2020, 6, 1)), ("effect 10 days after filing", P, S, None), (None, P, S, None),
])
def test_effective_date(spark, clause, published, signed, want):
    df = spark.createDataFrame([(clause, published, signed)], "c string, p date, s date")
    assert df.select(dates.effective_date(F.col("c"), F.col("p"), F.col("s")).alias("r")).first().r == want


@pytest.mark.parametrize("body,name,want", [
    ("DEPARTMENT ORDER NO. 018-A-11 and D.O. No. 5, Series of 2001", "x", "DO-018-A-11"), ("Department Order No. 219, Series of 2021", "x", "DO-219-21"), ("none", "DO_18-A_2011.pdf", "DO-18-A-11"), ("none", "x", None), (None, "x", None),
])
def test_order_number(spark, body, name, want):
    assert one(spark, refs.order_number, body, name) == want


def test_references(spark):
    assert one(spark, refs.laws, "P.D. No. 442, R.A. 11058 and Republic Act No. 11165; RA 11058; the Labor Code") == ["RA 11058", "RA 11165", "PD 442", "PD 442 (Labor Code)"]
    assert one(spark, refs.tags, "wages, minimum wage, wages", "Telecommuting rules") == ["telecommuting", "wages"]
    assert one(spark, refs.tags, "wages and wages", None) == []
    assert one(spark, refs.cited_laws, "As amended by Section 3, R.A. No. 6715, P.D. 570-A, B.P. Blg. 130, E.O. No. 111 and P.D. 442; RA 6715") == ["RA 6715", "PD 570-A", "BP 130", "EO 111"]
    assert one(spark, refs.order_ids, "D.O. No. 018-A-11, DO No. 18-A, Series of 2011; Department Order No. 40 (2003)") == ["DO-18-A-11", "DO-40-03"]
    df = spark.createDataFrame([("Articles 106 to 109, Art. 5 and 7 of this Code, Article 1700 of the Civil Code, Articles 1 to 300", 7)], "t string, n int")
    assert df.select(refs.related_articles(F.col("t"), F.col("n")).alias("r")).first().r == [1, 5, 106, 107, 108, 109, 300]
