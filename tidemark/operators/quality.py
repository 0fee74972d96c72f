"""Checks of published data, each a DataFrame of counts or of offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bars import by_security, valid_ohlc


def shape(bars: DataFrame) -> DataFrame:
    """Rows, securities, sessions and span of each year."""
    return bars.groupBy(F.year("d").alias("year")).agg(F.count("*").alias("n_rows"), F.countDistinct("sec").alias("securities"), F.countDistinct("d").alias("sessions"), F.min("d").alias("first_d"), F.max("d").alias("last_d"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has; null keys don't count."""
    whole = rows
    for k in keys:
        whole = whole.where(F.col(k).isNotNull())
    return whole.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def bar_sanity(bars: DataFrame) -> DataFrame:
    """One row of counters of what bars must not be."""
    c = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    return bars.agg(
        F.count("*").alias("n_rows"), c(F.col("close").isNull()).alias("null_close"), c(F.col("open") <= 0).alias("open_not_positive"), c(F.col("close") <= 0).alias("close_not_positive"), c(F.col("high") < F.col("low")).alias("high_below_low"),
        c(F.col("high") < F.greatest("open", "close")).alias("high_too_low"), c(F.col("low") > F.least("open", "close")).alias("low_too_high"), c(F.col("volume") < 0).alias("volume_negative"), c(F.col("volume") == 0).alias("volume_zero"),
        c(F.col("high") == F.col("low")).alias("frozen"), c(~valid_ohlc()).alias("invalid"), c(F.dayofweek("d").isin(1, 7)).alias("weekend"),
    )


def rank_integrity(members: DataFrame, snapshot: str, rank: str, key: str) -> DataFrame:
    """Snapshots whose ranks aren't 1..n, once each, with no key twice."""
    per = members.groupBy(snapshot).agg(F.count("*").alias("n"), F.countDistinct(rank).alias("ranks"), F.countDistinct(key).alias("keys"), F.min(rank).alias("low"), F.max(rank).alias("high"))
    return per.withColumn("is_valid", (F.col("n") == F.col("ranks")) & (F.col("n") == F.col("keys")) & (F.col("low") == 1) & (F.col("high") == F.col("n")))


def survivorship(bars: DataFrame, probe) -> DataFrame:
    """(alive, gone, late, share_gone): securities that traded by a probe date, and how many of them are not there at the end."""
    per = bars.groupBy("sec").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    end = bars.agg(F.date_sub(F.max("d"), 30).alias("end"))
    return per.join(F.broadcast(end)).agg(
        F.count_if((F.col("a") <= probe) & (F.col("b") >= probe)).alias("alive"), F.count_if((F.col("a") <= probe) & (F.col("b") >= probe) & (F.col("b") < F.col("end"))).alias("gone"), F.count_if(F.col("a") > probe).alias("late")
    ).withColumn("share_gone", F.round(F.col("gone") / F.nullif(F.col("alive"), F.lit(0)), 6))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(both, only_a, only_b) of two key sets."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    j = x.join(y, key, "full")
    return j.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"), F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))


def member_coverage(panel: DataFrame, bars: DataFrame, era) -> DataFrame:
    """(era, members, priced, share): member days with a bar, by era."""
    have = bars.select("sec", "d", F.lit(True).alias("priced"))
    per = panel.join(have, ["sec", "d"], "left").groupBy(era.alias("era")).agg(F.count("*").alias("members"), F.count("priced").alias("priced_days"))
    return per.withColumn("share", F.round(F.col("priced_days") / F.col("members"), 6))


def tradability(bars: DataFrame) -> DataFrame:
    """(bucket, n_rows): bars by turnover."""
    t = F.col("turnover")
    bucket = F.when(F.col("volume") == 0, "0 NOT_TRADED").when(t < 1e5, "1 BELOW_1E5").when(t < 1e6, "2 BELOW_1E6").when(t < 1e7, "3 BELOW_1E7").otherwise("4 FROM_1E7")
    return bars.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("high") == F.col("low")).alias("frozen"))


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """(only_a, only_b): rows by which two multisets differ; both 0 if they are equal."""
    x = a.exceptAll(b).agg(F.count("*").alias("only_a"))
    return x.join(b.exceptAll(a).agg(F.count("*").alias("only_b")))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).withColumn("side", F.lit("A")).unionByName(b.subtract(a).withColumn("side", F.lit("B")))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, attribute: str) -> DataFrame:
    """(key, change): added, removed, or changed attribute."""
    o, n = old.select(F.col(key).alias("key"), F.col(attribute).alias("a")), new.select(F.col(key).alias("key"), F.col(attribute).alias("b"))
    j = o.withColumn("_o", F.lit(1)).join(n.withColumn("_n", F.lit(1)), "key", "full")
    change = F.when(F.col("_o").isNull(), "ADDED").when(F.col("_n").isNull(), "REMOVED").when(~F.col("a").eqNullSafe(F.col("b")), "CHANGED")
    return j.withColumn("change", change).where("change is not null").select("key", "change")


def ex_date_moves(bars: DataFrame, events: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """(event_id, sec, ex, ret, is_suspect): the move at each event's ex-date, in one join."""
    ret = bars.select("sec", "d", (F.col("close") / F.nullif(F.lag("close").over(by_security()), F.lit(0.0)) - 1).alias("ret"))
    at = events.join(ret, (events["sec"] == ret["sec"]) & (F.col("ex") == F.col("d"))).select("event_id", events["sec"], "ex", F.round("ret", 9).alias("ret"))
    return at.withColumn("is_suspect", F.coalesce(F.abs("ret") > tolerance, F.lit(False)))


def agreement(ours: DataFrame, theirs: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """(sec, sessions, upper_median_diff, share_within): our returns against another source's."""
    j = ours.join(theirs.withColumnRenamed("ret", "other"), ["sec", "d"]).where("ret is not null and other is not null").withColumn("diff", F.abs(F.col("ret") - F.col("other")))
    per = j.groupBy("sec").agg(F.count("*").alias("sessions"), F.array_sort(F.collect_list("diff")).alias("all"), F.count_if(F.col("diff") <= tolerance).alias("within"))
    return per.select("sec", "sessions", F.round(F.element_at("all", (F.floor(F.size("all") / 2) + 1).cast("int")), 9).alias("upper_median_diff"), F.round(F.col("within") / F.col("sessions"), 6).alias("share_within"))


def stratified_sessions(sessions: DataFrame, strata: int, per_stratum: int, seed: int) -> DataFrame:
    """(stratum, d): so many sessions of each of equal stretches of the calendar, drawn by hash."""
    t = sessions.select("d").distinct().withColumn("stratum", F.ntile(strata).over(Window.orderBy("d")))
    w = Window.partitionBy("stratum").orderBy(F.xxhash64(F.lit(seed), F.unix_date("d")), "d")
    return t.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_stratum).drop("_n")


def verdict(counts: dict[str, int], warn: set[str] = frozenset()) -> str:
    """FAIL if a counter that must be 0 isn't, WARN if only tolerated ones aren't, else PASS."""
    bad = {k for k, v in counts.items() if v}
    return "FAIL" if bad - set(warn) else "WARN" if bad else "PASS"
