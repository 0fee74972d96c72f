"""Trading calendars from the presence of data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(bars: DataFrame) -> DataFrame:
    """(d, weekday, securities, is_weekend_session) of each session."""
    per = bars.groupBy("d").agg(F.countDistinct("sec").alias("securities"))
    return per.select("d", F.date_format("d", "EEEE").alias("weekday"), "securities", F.dayofweek("d").isin(1, 7).alias("is_weekend_session"))


def days(bars: DataFrame) -> DataFrame:
    """Every day from the first session to the last."""
    return bars.agg(F.min("d").alias("a"), F.max("d").alias("b")).select(F.explode(F.sequence("a", "b")).alias("d"))


def non_trading(bars: DataFrame) -> DataFrame:
    """(d, weekday, reason): days without a session: weekends, and holidays inferred."""
    gone = days(bars).join(bars.select("d").distinct(), "d", "left_anti")
    return gone.select("d", F.date_format("d", "EEEE").alias("weekday"), F.when(F.dayofweek("d").isin(1, 7), "WEEKEND").otherwise("INFERRED_HOLIDAY").alias("reason"))


def missing_sessions(bars: DataFrame, minimum: int) -> DataFrame:
    """(sec, d): sessions between a security's first and last bar that it lacks, for securities with *minimum* bars."""
    secs = bars.groupBy("sec").agg(F.min("d").alias("a"), F.max("d").alias("b"), F.count("*").alias("n")).where(F.col("n") >= minimum)
    calendar = bars.select("d").distinct().agg(F.array_sort(F.collect_set("d")).alias("all"))
    expected = secs.join(F.broadcast(calendar)).select("sec", F.explode(F.filter("all", lambda d: (d >= F.col("a")) & (d <= F.col("b")))).alias("d"))
    return expected.join(bars.select("sec", "d").distinct(), ["sec", "d"], "left_anti")


def year_labels(per_year: DataFrame, safe: float = 0.99, partial: float = 0.9) -> DataFrame:
    """(year, coverage, label): whether a year's data serves a back-test."""
    return per_year.withColumn("label", F.when(F.col("coverage") >= safe, "BACKTEST_SAFE").when(F.col("coverage") >= partial, "PARTIAL").otherwise("PRICE_DATA_ONLY"))


def chunks(start, end, days_: int = 90):
    """Contiguous windows of at most so many days: (start, end) columns of an exploded sequence."""
    first = F.explode(F.sequence(start, end, F.expr(f"interval {days_} days"))).alias("start")
    return first, lambda s: F.least(end, F.date_add(s, days_ - 1))
