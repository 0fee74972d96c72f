"""Queries that once ran over a year or a slice of the securities, against plain versions over all bars."""

import datetime
from collections import defaultdict

import pytest

from tidemark.plans import catalog
from tidemark.plans import driver_tables as t


@pytest.fixture(scope="module")
def bars(spark, sf_dir):
    return [(r["sec"], r["d"], r["volume"]) for r in t.bars(spark, sf_dir).collect()]


@pytest.fixture(scope="module")
def sparse(spark, sf_dir):
    return [(r["sec"], r["d"]) for r in t.bars(spark, sf_dir, "l_partkey").select("sec", "d").collect()]


def got(spark, sf_dir, name, *columns):
    return sorted(map(tuple, catalog.queries()[name](spark, sf_dir).select(*columns).collect()), key=repr)


def by_day(bars):
    days = defaultdict(list)
    for sec, d, volume in bars:
        days[d].append((sec, volume))
    return days


def test_alias_join(spark, sf_dir, bars):
    want = []
    for d, rows in by_day(bars).items():
        for sec, _ in rows:
            others = [(-v, q) for q, v in rows if q != sec and (q % 7 == sec % 7 or q % 5 == sec % 5)]
            if others:
                want.append((sec, d, min(others)[1]))
    assert got(spark, sf_dir, "alias_join", "sec", "d", "q_sec") == sorted(want, key=repr)


def test_greedy_assignment(spark, sf_dir, bars):
    result = got(spark, sf_dir, "greedy_assignment", "d", "member", "row_symbol", "how")
    days, found = by_day(bars), defaultdict(list)
    for d, *row in result:
        found[d].append(row)
    for d, rows in days.items():
        symbols, isins = {f"S{s}" for s, _ in rows}, {f"S{s}": s // 2 for s, _ in rows}
        claims = defaultdict(set)  # a member symbol may be spelled by several securities, of which any one's ISIN may stay
        for s, _ in rows:
            claims[f"S{s + s % 3}"].add(s // 2)
        assert sorted(m for m, _, how in found[d] if how == "SYMBOL") == sorted(claims.keys() & symbols)
        free = symbols - claims.keys()
        extra = [(m, r) for m, r, how in found[d] if how == "ISIN"]
        assert len({m for m, _ in extra}) == len({r for _, r in extra}) == len(extra)
        assert all(m in claims and m not in symbols and r in free and isins[r] in claims[m] for m, r in extra)
        # Greedy: of a member with one claim and a free row of its ISIN, one has found a partner.
        taken, served = {r for _, r in extra}, {m for m, _ in extra}
        assert not any(len(claims[m]) == 1 and isins[r] in claims[m] for m in claims.keys() - symbols - served for r in free - taken)


def test_calendar_non_trading(spark, sf_dir, sparse):
    sessions = {d for _, d in sparse}
    every = [min(sessions) + datetime.timedelta(k) for k in range((max(sessions) - min(sessions)).days + 1)]
    assert got(spark, sf_dir, "calendar_non_trading", "d") == sorted([(d,) for d in every if d not in sessions], key=repr)


def test_membership_diff(spark, sf_dir, sparse):
    years = defaultdict(set)
    for sec, d in sparse:
        years[d.replace(month=1, day=1)].add(sec)
    text = lambda s: ",".join(map(str, sorted(s)))
    order = sorted(years)
    want = [(b, text(years[b] - years[a]), text(years[a] - years[b])) for a, b in zip(order, order[1:])]
    assert got(spark, sf_dir, "membership_diff", "d", "joined", "gone") == sorted(want, key=repr)


def test_union_by_name(spark, sf_dir, bars):
    rows = got(spark, sf_dir, "union_by_name", "sec", "d", "volume")
    assert [r for r in rows if r[2] is not None] == sorted(bars, key=repr)
