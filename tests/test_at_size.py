"""What made queries fail on larger tables, shown on small ones."""

import datetime

import pytest

from tidemark.operators import identity
from tidemark.plans import catalog


def joined_rows(df):
    """The most rows that a join of the plan made, after it ran."""
    df.collect()

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(p.plan())
        else:
            if "Join" in name:
                yield p.metrics().apply("numOutputRows").value()
            for k in range(p.children().size()):
                yield from walk(p.children().apply(k))

    return max(walk(df._jdf.queryExecution().executedPlan()), default=0)


@pytest.fixture
def busy_day(spark, tmp_path):
    """A day on which 1,500 securities trade, many of them the same volume, and one with a single security."""
    line = lambda sec, day: (sec, sec, sec, 1, float(sec % 11 + 1), 10.0, datetime.datetime(1998, 1, day))
    rows = [line(sec, 5) for sec in range(1500)] + [line(3, 6)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_alias_join_makes_no_pairs(spark, busy_day):
    df = catalog.queries()["alias_join"](spark, busy_day)
    assert joined_rows(df) <= 4 * 1500
    best = lambda a: min((-(q % 11), q) for q in range(1500) if q != a and (q % 7 == a % 7 or q % 5 == a % 5))[1]
    assert sorted((r["sec"], r["q_sec"]) for r in df.collect()) == [(a, best(a)) for a in range(1500)]


def walked(rows, members, as_of):
    """The timeline by walking whole sets; rows in order."""
    state = set(members)
    for _, gone, come in reversed(rows):
        state = (state - set(come)) | set(gone)
    since, out = dict.fromkeys(state), []
    for d, gone, come in rows:
        out += [(s, since.pop(s), d) for s in set(gone) & since.keys()]
        since |= {s: d for s in set(come) - since.keys()}
    return sorted(out + [(s, d, as_of + datetime.timedelta(1)) for s, d in since.items()], key=repr)


def test_timeline_by_symbols(spark):
    random = __import__("random").Random(5)
    end = datetime.date(2001, 1, 1)
    some = lambda: random.sample("ABCDEFGH", random.randrange(4))
    rows = [(datetime.date(2000, 1, 1 + k // 5), some(), some()) for k in range(60)]
    shape = "effective_date date, exclusions array<string>, inclusions array<string>, no int"
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)][::-1], shape)  # changes of a date go by number, not as they lie
    anchor = spark.createDataFrame([(["A", "B", "STAYS"],)], "members array<string>")
    got = sorted(map(tuple, identity.timeline(df, anchor, end, ["no"]).collect()), key=repr)
    assert got == walked(rows, ["A", "B", "STAYS"], end)
    assert sorted(map(tuple, identity.timeline(df.limit(0), anchor, end).collect())) == [(s, None, datetime.date(2001, 1, 2)) for s in ("A", "B", "STAYS")]


def test_timeline_is_not_one_group(spark, sf_dir):
    df = catalog.queries()["membership_timeline"](spark, sf_dir)
    assert "FlatMapGroups" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_lineage_of_an_isin_in_several_chains(spark):
    at = lambda *d: [datetime.date(*x) for x in d]
    rows = []
    for k in range(20):
        isin = [f"INE{k:06}{n:03}" for n in range(3)]
        rows += [(f"S{k}", isin[0], *at((2000, 1, 1), (2000, 1, 9))), (f"S{k}", isin[1], *at((2000, 1, 11), (2000, 1, 19)))]
        rows += [(f"S{k}", isin[2], *at((2005, 1, 1), (2005, 1, 9))), (f"S{k}", isin[1], *at((2005, 1, 11), (2005, 1, 19))), (f"S{k}", isin[1], *at((2009, 1, 1), (2009, 1, 9)))]
    got = {r["isin"]: r["canonical"] for r in identity.lineage(spark.createDataFrame(rows, "symbol string, isin string, first_d date, last_d date")).collect()}
    assert [got[f"INE{k:06}001"] for k in range(20)] == [f"INE{k:06}000" for k in range(20)]
