"""Joins that the planner has no operator for, as compositions of those it has."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_prior(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: list[str], within_days: int | None = None, strict: bool = True, prefix: str = "prior_") -> DataFrame:
    """Each left row with *columns* of the last right row of its key before (or, not strict, at) its time.

    Both sides meet in one sort by (key, time): the last right row so far is carried along by a running window, so no
    pair but the matched one is ever made.
    """
    return _asof(left, right, key, left_time, right_time, columns, within_days, strict, prefix, True)


def asof_next(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: list[str], within_days: int | None = None, strict: bool = False, prefix: str = "next_") -> DataFrame:
    """Each left row with *columns* of the first right row of its key at (or, strict, after) its time."""
    return _asof(left, right, key, left_time, right_time, columns, within_days, strict, prefix, False)


def _asof(left, right, key, left_time, right_time, columns, within_days, strict, prefix, back) -> DataFrame:
    mine = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_l"), F.lit(None).alias("_r"))
    carried = F.struct(F.col(right_time).alias("_at"), *columns)
    theirs = right.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(None).alias("_l"), carried.alias("_r"))
    both = mine.unionByName(theirs)
    # At equal times a left row comes before the right ones if they must not match, behind them if they may.
    right_first = F.col("_l").isNotNull() if not strict else F.col("_l").isNull()
    time = F.col("_t").asc() if back else F.col("_t").desc()
    w = Window.partitionBy("_k").orderBy(time, right_first.asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where(F.col("_l").isNotNull())
    if within_days is not None:
        gap = F.datediff("_t", "_m._at") if back else F.datediff("_m._at", "_t")
        seen = seen.withColumn("_m", F.when(gap <= within_days, F.col("_m")))
    return seen.select("_l.*", F.col("_m._at").alias(f"{prefix}{right_time}"), *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in columns])


def or_key_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], also: list[tuple[str, str]] = (), residual: Column | None = None) -> DataFrame:
    """Pairs that agree on any of *keys* (and on all of *also*): a union of equi-joins, each pair once.

    Columns of the sides must have different names.  A pair is made by the first key it agrees on, so no distinct is needed.
    """
    joins, before = [], None
    for a, b in keys:
        on = reduce(lambda x, y: x & y, [F.col(p) == F.col(q) for p, q in [(a, b), *also]])
        made = left.join(right, on)
        if before is not None:
            made = made.where(~F.coalesce(before, F.lit(False)))
        joins.append(made if residual is None else made.where(residual))
        hit = F.col(a).eqNullSafe(F.col(b)) & F.col(a).isNotNull()
        before = hit if before is None else before | hit
    return reduce(DataFrame.unionByName, joins)


def or_key_anti(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], residual: Column | None = None) -> DataFrame:
    """Left rows that no right row agrees with on any of *keys*: anti-joins one after the other."""
    for a, b in keys:
        on = F.col(a) == F.col(b)
        left = left.join(right, on if residual is None else on & residual, "left_anti")
    return left


def interval_join(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, bin_days: int = 64) -> DataFrame:
    """Pairs of a date and a half-open span [start, end) that holds it, by bins of days: an equi-join with a residual."""
    binned = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.unix_date(start) / bin_days), F.floor((F.unix_date(end) - 1) / bin_days)))).where(F.col(start) < F.col(end))
    return points.withColumn("_bin", F.floor(F.unix_date(point) / bin_days)).join(binned, "_bin").where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_bin")


def with_next_date(dates: DataFrame, column: str, alias: str) -> DataFrame:
    """Distinct dates with the one after each; the dates of a calendar are few, and meet in one task."""
    return dates.select(column).distinct().withColumn(alias, F.lead(column).over(Window.orderBy(column)))


def point_in_time(rows: DataFrame, members: DataFrame, key: str, date: str, snapshot: str) -> DataFrame:
    """Rows with the snapshot in force: after its date, up to and with the next snapshot's date."""
    spans = members.join(F.broadcast(with_next_date(members, snapshot, "next_snapshot")), snapshot)
    return rows.join(spans, key).where((F.col(date) > F.col(snapshot)) & (F.col("next_snapshot").isNull() | (F.col(date) <= F.col("next_snapshot"))))


def nearest_interval(rows: DataFrame, spans: DataFrame, key: str, date: str, start: str, end: str, order: list[str], row_id: list[str]) -> DataFrame:
    """Each row with one span of its key: one that covers it first, else the one whose end is nearest, ties by *order*."""
    joined = rows.join(spans, key)
    covers = F.col(date).between(F.col(start), F.col(end))
    w = Window.partitionBy(*row_id).orderBy(covers.desc(), F.abs(F.datediff(date, end)).asc(), *order)
    return joined.withColumn("covered", covers).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def alias_join(left: DataFrame, right: DataFrame, left_aliases: str, right_aliases: str, date: str, key: tuple[str, str], order: list[Column], few: bool = False) -> DataFrame:
    """Each left row with the first right row, by *order* of the right's columns, of its date that shares an alias and has another key.

    Right rows are unique by (date, key).  No pairs are made: of each (date, alias) the two first right rows stay, of each date
    and array of left aliases the two first of those, and a left row takes the one that isn't its own.  *few*: dates and arrays
    are so few that their rows may be sent to every task.
    """
    mine, theirs = key
    kept = [c for c in right.columns if c not in (date, right_aliases)]
    in_order = lambda *part: F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    best = right.select(F.col(date).alias("_d"), F.explode(F.array_distinct(right_aliases)).alias("_a"), *kept).withColumn("_n", in_order("_d", "_a")).where("_n <= 2").drop("_n")
    arrays = left.select(F.col(date).alias("_d"), F.col(left_aliases).alias("_l")).distinct()
    met = arrays.select("_d", "_l", F.explode("_l").alias("_a")).join(best, ["_d", "_a"]).drop("_a").dropDuplicates(["_d", "_l", theirs])
    row = F.struct(*kept)
    nth = lambda n: F.max(F.when(F.col("_n") == n, row)).alias(f"_{n}")
    two = met.withColumn("_n", in_order("_d", "_l")).where("_n <= 2").groupBy("_d", "_l").agg(nth(1), nth(2))
    found = left.join(F.broadcast(two) if few else two, (F.col(date) == F.col("_d")) & (F.col(left_aliases) == F.col("_l")))
    other = lambda n: F.when(F.col(f"_{n}.{theirs}") != F.col(mine), F.col(f"_{n}"))
    return found.withColumn("_r", F.coalesce(other(1), other(2))).where("_r is not null").select(*left.columns, *[F.col(f"_r.{c}") for c in kept])


def assign(members: DataFrame, rows: DataFrame, date: str, symbol: str, isin: str) -> DataFrame:
    """(date, member, row symbol, how) one-to-one: by symbol first, then unused rows by ISIN, first member by symbol wins."""
    m = members.select(F.col(date).alias("_d"), F.col(symbol).alias("member"), F.col(isin).alias("_mi"))
    r = rows.select(F.col(date).alias("_rd"), F.col(symbol).alias("row_symbol"), F.col(isin).alias("_ri"))
    exact = m.join(r, (F.col("_d") == F.col("_rd")) & (F.col("member") == F.col("row_symbol")))
    exact = exact.select("_d", "member", "row_symbol", F.lit("SYMBOL").alias("how"))
    used = exact.select(F.col("_d").alias("_ud"), F.col("row_symbol").alias("_us"))
    left = m.join(exact.select(F.col("_d").alias("_ed"), F.col("member").alias("_em")), (F.col("_d") == F.col("_ed")) & (F.col("member") == F.col("_em")), "left_anti")
    free = r.join(used, (F.col("_rd") == F.col("_ud")) & (F.col("row_symbol") == F.col("_us")), "left_anti")
    # Both sides are numbered in order within (date, ISIN): equal numbers take each other.
    nth = lambda df, part, order: df.withColumn("_n", F.row_number().over(Window.partitionBy(*part).orderBy(order)))
    left, free = nth(left, ["_d", "_mi"], "member"), nth(free, ["_rd", "_ri"], "row_symbol").withColumnRenamed("_n", "_rn")
    other = left.join(free, (F.col("_d") == F.col("_rd")) & (F.col("_mi") == F.col("_ri")) & (F.col("_n") == F.col("_rn"))).select("_d", "member", "row_symbol", F.lit("ISIN").alias("how"))
    return exact.unionByName(other).withColumnRenamed("_d", date)
