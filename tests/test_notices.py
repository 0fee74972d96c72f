import datetime

from pyspark.sql import functions as F

from tidemark.operators import notices

TEXT = """PRESS RELEASE                                   August 1, 2012
Changes will become effective from September 28, 2012.
A) S&P CNX 500
The following companies are being excluded:
1 Alpha Limited   ALPHA
2 Beta Company (BETA),
The following companies are being included:
1 Gamma GAMMA
2 Unknown Words NOPE
3 Gamma GAMMA
4 Delta  DELTA;
CNX Midcap
The following companies are being excluded:
1 Other OTHER
"""
LATER = TEXT.replace("A) S&P CNX 500", "NIFTY 500 Index:").replace("Changes will become effective from September 28, 2012.", "w.e.f. 3rd March 2013").replace("4 Delta  DELTA;", "")


def test_parse(spark):
    df = spark.createDataFrame([("a", TEXT), ("b", LATER), ("c", "nothing here"), ("d", TEXT.replace("effective from September 28, 2012", "known")), ("e", None)], "source_file string, text string")
    symbols = spark.createDataFrame([(s,) for s in ("ALPHA", "BETA", "gamma", "DELTA", "OTHER")], "symbol string")
    got = {r["source_file"]: r for r in notices.parse(df, symbols).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["effective_date"], got["a"]["exclusions"], got["a"]["inclusions"], got["a"]["confidence"]) == (datetime.date(2012, 9, 28), ["ALPHA", "BETA"], ["GAMMA", "DELTA"], "PARSED_BALANCED")
    assert (got["b"]["effective_date"], got["b"]["inclusions"], got["b"]["confidence"]) == (datetime.date(2013, 3, 3), ["GAMMA"], "PARSED_UNBALANCED_REVIEW")


def test_names(spark):
    names = spark.createDataFrame([("Tata Motors Limited", "TATA"), ("Housing Development Finance Corporation", "HDFC"), ("Twin A", "T1"), ("TwinA", "T2")], "name string, symbol string")
    rows = spark.createDataFrame([("TATA MOTORS LTD.",), ("TataMotors",), ("Housing Developmnt Finance Corp",), ("Twin  A",), ("Nobody",), (None,)], "name string")
    got = {r["name"]: (r["symbol"], r["method"]) for r in notices.resolve_names(rows, names).collect()}
    assert got["TATA MOTORS LTD."] == ("TATA", "NAME_EXACT") and got["TataMotors"] == ("TATA", "NAME_SUFFIX") and got["Housing Developmnt Finance Corp"] == ("HDFC", "NAME_ALIKE")
    assert got["Twin  A"] == ("T1", "NAME_EXACT") and got["Nobody"] == (None, "REVIEW") and got[None] == (None, "REVIEW")


def test_snapshots_and_anchors(spark):
    s = spark.createDataFrame([(1, f"S{k}") for k in range(3)] + [(2, "S1")], "date long, symbol string")
    assert {r["date"]: r["accepted"] for r in notices.accepted_snapshots(s, (3,)).collect()} == {1: True, 2: False}
    a, b = notices.accepted_snapshots(s, (3,)).where("accepted"), spark.createDataFrame([(1, ["X"]), (3, ["Y"])], "date long, members array<string>")
    assert {r["date"]: r["members"] for r in notices.anchors(a, b).collect()} == {1: ["S0", "S1", "S2"], 3: ["Y"]}
    e = spark.createDataFrame([(["A", "B"], ["B", "C"])], "a array<string>, b array<string>").select(notices.equivalent("a", "b", F.create_map(F.lit("C"), F.lit("A"))).alias("e"))
    assert e.first()["e"]
