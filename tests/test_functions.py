"""Subjects, numbers, dates and names."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import actions, text

V3 = {
    "Fv Splt Frm Rs 10 To Re 1": 0.1, "Fv Spl-Rs10tors5/Bon-2:1": 0.5 / 3, "Face Value Split Rs.10/- To Re.1/- Per Share": 0.1, "Bonus 2:1/Dividend- Rs 1.60 Per Share": 1 / 3,
    "Bonus 1:1 And Face Value Split From Rs.10 To Re.1": 0.05, "Consolidation Of Equity Shares From Re 1 Per Share To Rs 10 Per Share": 10.0,
    "Div-Fin Rs.5+Spl Rs.10   Purpose Revised": None, "Demerger": None, "Rights 2:1 @ Premium Rs 2/-": None, "Capital Reduction Rs 10 To Rs 3.30": None, "Bon 1 Dvr : 20 Eq Shares": None, "Bonus Preference Shares 21:1": None, "": None,
}


def column(spark, values, *columns):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [tuple(r)[1:] for r in df.select("k", *[c.alias(f"c{j}") for j, c in enumerate(columns)]).orderBy("k").collect()]


def classified(spark, policy, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, subject string")
    return policy(df).orderBy("k").collect()


def test_policy_v3(spark):
    got = classified(spark, actions.classify_v3, list(V3))
    assert [g["price_factor"] for g in got] == [pytest.approx(v) if v else None for v in V3.values()]


def test_policies_differ_where_they_should(spark):
    s = ["Bonus 2:1/Dividend- Rs 1.60 Per Share", "Bonus 1:1 And Face Value Split From Rs.10 To Re.1", "Annual General Meeting", "Merger Of A And B", "Face Value Split From Rs 1 To Rs 10", None]
    v1, v2 = classified(spark, actions.classify_v1, s), classified(spark, actions.classify_v2, s)
    got = [(a["action_type"], a["price_factor"], a["parse_status"], b["action_type"], b["price_factor"]) for a, b in zip(v1, v2)]
    assert got[0] == ("DIVIDEND", 1.0, "NO_ADJUST", "BONUS", pytest.approx(1 / 3))
    assert got[1] == ("BONUS", 0.5, "PARSED", "BONUS_AND_SPLIT", pytest.approx(0.05))
    assert got[2] == ("OTHER", None, "REVIEW", "OTHER_INFORMATIONAL", 1.0)
    assert got[3][0] == "MERGER" and got[3][3] == "MERGER_OR_AMALGAMATION"
    assert got[4] == ("SPLIT", None, "REVIEW", "CONSOLIDATION", 10.0)
    assert got[5][0] == "OTHER"


def test_demerger(spark):
    df = spark.createDataFrame([("Demerger", 50.0, 100.0), ("Demerger", 99.0, 100.0), ("Scheme Of Arrangement", 80.0, 100.0), ("Scheme Of Arrangement", 50.0, 100.0), ("Rights / Demerger", 50.0, 100.0), ("Demerger", 0.0, 100.0), ("Demerger", None, 1.0)], "s string, o double, c double")
    assert [r[0] for r in df.select(actions.demerger_factor(F.col("s"), F.col("o"), F.col("c"))).collect()] == [0.5, None, None, 0.5, None, None, None]


def test_numbers_and_dates(spark):
    assert [r[0] for r in column(spark, ["1,234.5", "-", "", " 7 ", None, "x"], text.number(F.col("v")))] == [1234.5, None, None, 7.0, None, None]
    got = column(spark, ["02-Jan-2020", "2020-01-02", "02-01-2020", "02/01/2020", "soon", None], text.date(F.col("v")))
    assert [str(r[0]) for r in got] == ["2020-01-02"] * 4 + ["None"] * 2


def test_names(spark):
    got = column(spark, ["The  A&B Co. Ltd", "Tata Motors Limited", None], text.company_name(F.col("v")), text.name_aliases(F.col("v")))
    assert got[0] == ("THE A AND B", ["THE A AND B", "A AND B", "AANDB"]) and got[1][0] == "TATA MOTORS" and got[2][0] is None
    text.register(spark)
    assert spark.sql("SELECT name_ratio('abcd', 'abce') > 0.7, name_ratio(NULL, 'a') IS NULL").first() == (True, True)
