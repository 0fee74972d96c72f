"""Joins, adjustment, repair, universes, signals and identities on small fixtures."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adjust, capping, identity, joins, quality

D = lambda s: datetime.date.fromisoformat(s)
DAYS = [datetime.date(2020, 1, 1) + datetime.timedelta(k) for k in range(40)]


def bars(spark, closes, sec=1):
    rows = [(sec, d, float(c), float(c), float(c), float(c), 1000) for d, c in zip(DAYS, closes)]
    return spark.createDataFrame(rows, "sec long, d date, open double, high double, low double, close double, volume long").withColumn("turnover", F.col("close") * F.col("volume"))


def test_asof_against_brute_force(spark):
    rng = random.Random(0)
    left = [(k, rng.randrange(5), DAYS[rng.randrange(40)]) for k in range(200)]
    right = [(s, d, float(k)) for s in range(4) for k, d in enumerate(rng.sample(DAYS, 12))]
    l_, r_ = spark.createDataFrame(left, "id long, sec long, t date"), spark.createDataFrame(right, "sec long, d date, v double")
    for f, strict, days in ((joins.asof_prior, True, None), (joins.asof_prior, False, 3), (joins.asof_next, False, None), (joins.asof_next, True, 5)):
        back = f is joins.asof_prior
        got = {r["id"]: r[4] for r in f(l_, r_, "sec", "t", "d", ["v"], within_days=days, strict=strict, prefix="m_").collect()}
        for k, s, t in left:
            ok = [(d, v) for x, d, v in right if x == s and ((d < t or (d == t and not strict)) if back else (d > t or (d == t and not strict))) and (days is None or abs((d - t).days) <= days)]
            want = (max(ok) if back else min(ok))[1] if ok else None
            assert got[k] == want


def test_or_keys_make_each_pair_once(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, "z", 9)], "i long, p string, q long")
    b = spark.createDataFrame([(10, "x", 1), (11, "y", 1), (12, None, 5)], "j long, r string, s long")
    got = joins.or_key_join(a, b, [("p", "r"), ("q", "s")]).select("i", "j").collect()
    assert sorted(map(tuple, got)) == [(1, 10), (1, 11), (2, 10), (2, 11)]
    assert [r["i"] for r in joins.or_key_anti(a, b, [("p", "r"), ("q", "s")]).collect()] == [3]


def test_interval_join_is_half_open(spark):
    p = spark.createDataFrame([(d,) for d in DAYS], "d date")
    s = spark.createDataFrame([("a", DAYS[3], DAYS[7]), ("empty", DAYS[5], DAYS[5]), ("long", DAYS[0], D("2030-01-01"))], "n string, a date, b date")
    got = joins.interval_join(p, s, "d", "a", "b", 4).groupBy("n").agg(F.count("*").alias("c"), F.max("d").alias("m"))
    assert {r["n"]: (r["c"], r["m"]) for r in got.collect()} == {"a": (4, DAYS[6]), "long": (40, DAYS[-1])}


def test_assignment_is_one_to_one(spark):
    m = spark.createDataFrame([(DAYS[0], "A", "I1"), (DAYS[0], "B", "I2"), (DAYS[0], "C", "I2"), (DAYS[0], "E", "I9")], "d date, symbol string, isin string")
    r = spark.createDataFrame([(DAYS[0], "A", "I1"), (DAYS[0], "X", "I2"), (DAYS[0], "Y", "I2"), (DAYS[0], "Z", "I1")], "d date, symbol string, isin string")
    got = sorted(tuple(x)[1:] for x in joins.assign(m, r, "d", "symbol", "isin").collect())
    assert got == [("A", "A", "SYMBOL"), ("B", "X", "ISIN"), ("C", "Y", "ISIN")]


def test_adjustment(spark):
    b = bars(spark, [100, 100, 50, 50, 25])
    e = spark.createDataFrame([(1, DAYS[2], "a", 0.5), (1, DAYS[2], "a", 0.5), (1, DAYS[4], "b", 0.5)], "sec long, ex date, subject string, price_factor double")
    got = adjust.adjusted(b, e).orderBy("d").collect()
    assert [r["adj_close"] for r in got] == pytest.approx([25] * 5) and [r["adj_volume"] for r in got] == [4000, 4000, 2000, 2000, 1000]
    direct = adjust.adjusted_through(b.withColumn("adjusted_through", F.lit(None).cast("date")), e).orderBy("d").collect()
    assert [r["adj_close"] for r in direct] == pytest.approx([25] * 5)
    bound = adjust.adjusted_through(b.withColumn("adjusted_through", F.lit(DAYS[2])), e).orderBy("d").collect()
    assert [r["adj_close"] for r in bound] == pytest.approx([50, 50, 25, 25, 25])


def test_repair(spark):
    b = bars(spark, [200, 202, 204, 103, 104]).withColumn("isin", F.lit("INE1")).withColumn("ret", F.lit(None).cast("double"))
    from tidemark.operators.bars import by_security

    p = b.withColumn("ret", F.col("close") / F.lag("close").over(by_security()) - 1)
    e = spark.createDataFrame([(7, 9, "INE1", DAYS[3], 0.5), (8, 1, "INE1", DAYS[3], 0.5)], "event_id long, sec long, isin string, ex date, price_factor double")
    found = adjust.detect(p, e)
    assert [(r["kind"], r["event_id"]) for r in found.collect()] == [("MECHANICAL", 7)]
    fixed = adjust.apply_repair(p, found).orderBy("d").collect()
    assert [r["adj_close"] for r in fixed] == pytest.approx([100, 101, 102, 103, 104]) and fixed[3]["ret"] == pytest.approx(103 / 102 - 1)
    again = spark.createDataFrame([(r["sec"], r["isin"], r["d"], r["ret"]) for r in fixed], "sec long, isin string, d date, ret double")
    assert adjust.detect(again, e).count() == 0
    wrong = e.withColumn("price_factor", F.lit(0.55))
    assert {r["kind"] for r in adjust.detect(p, wrong).collect()} <= {"MECHANICAL", "RESIDUAL"}
    assert [r["kind"] for r in adjust.detect(p, e.withColumn("price_factor", F.lit(None).cast("double"))).collect()] == ["NON_MECHANICAL"] * 2
    jump = bars(spark, [100, 105, 525]).withColumn("isin", F.lit("INE1")).withColumn("ret", F.col("close") / F.lag("close").over(by_security()) - 1)
    assert [r["kind"] for r in adjust.detect(jump, e.where("sec = 3")).collect()] == ["UNEXPLAINED"]


def test_capped_weights():
    w = capping.capped([5, 4, 3, 2, 1, 1, 1, 1, 1, 1])
    assert sum(w) == pytest.approx(100, abs=0.05) and max(w) <= 15.0
    assert capping.capped([0, 0, -1, 0] * 3) == [8.33] * 12


def test_lineage(spark):
    s = [("A", "INE000A01011", D("2020-01-01"), D("2020-02-01")), ("A", "INE000A01029", D("2020-02-03"), D("2020-03-01")), ("A", "INE000A01037", D("2020-03-15"), D("2020-04-01")), ("A", "INE000A01045", D("2020-06-01"), D("2020-07-01")), ("B", "INE111A01011", D("2020-01-01"), D("2020-02-01")), ("B", "INE222A01011", D("2020-02-02"), D("2020-03-01"))]
    df = spark.createDataFrame(s, "symbol string, isin string, first_d date, last_d date")
    got = {r["isin"]: r["canonical"] for r in identity.lineage(df).collect()}
    assert [got[x[1]] for x in s] == [s[0][1]] * 3 + [s[3][1], s[4][1], s[5][1]]
    known = spark.createDataFrame([(s[0][1], "INE999A01011")], "isin string, canonical string")
    assert {r["canonical"] for r in identity.lineage(df, known).where("isin like 'INE000A0102%'").collect()} == {"INE999A01011"}


def test_timeline(spark):
    c = spark.createDataFrame([(DAYS[5], ["OLD"], ["NEW"]), (DAYS[9], ["NOBODY"], ["KEEP"])], "effective_date date, exclusions array<string>, inclusions array<string>")
    anchor = spark.createDataFrame([(["KEEP", "NEW"],)], "members array<string>")
    got = {(r["symbol"], r["valid_from"], r["valid_to"]) for r in identity.timeline(c, anchor, DAYS[20]).collect()}
    assert ("OLD", None, DAYS[5]) in got and ("NEW", DAYS[5], DAYS[21]) in got


def test_resolution_falls_back_to_all_spans(spark):
    h = spark.createDataFrame([("A", "I1", DAYS[0], DAYS[5]), ("A", "I2", DAYS[6], DAYS[9]), ("B", "I3", DAYS[0], DAYS[1])], "symbol string, isin string, first_d date, last_d date")
    e = spark.createDataFrame([(1, "A", D("2019-12-28")), (2, "B", D("2024-01-01")), (3, "A", D("2024-01-01")), (4, "Z", DAYS[0])], "event_id long, symbol string, ex date")
    got = {r["event_id"]: (r["isin"], r["match_status"]) for r in identity.resolve(e, h).collect()}
    assert got == {1: ("I1", "MATCHED_UNIQUE_ISIN"), 2: ("I3", "MATCHED_UNIQUE_ISIN"), 3: (None, "AMBIGUOUS_SYMBOL"), 4: (None, "UNMATCHED_SYMBOL")}


def test_parity_sees_what_xor_misses(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "x long"), spark.createDataFrame([(1,), (1,), (2,)], "x long")
    assert tuple(quality.parity(a, b).first()) == (1, 1) and tuple(quality.parity(a, a).first()) == (0, 0)
    assert quality.verdict({"a": 0}) == "PASS" and quality.verdict({"a": 1}, {"a"}) == "WARN" and quality.verdict({"a": 1, "b": 2}, {"a"}) == "FAIL"
