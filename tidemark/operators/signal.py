"""The ranked momentum signal over dense sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bars import by_security, rows, sum_over
from tidemark.operators.capping import capped
from tidemark.plans.runtime import ship

# Lookbacks in sessions, gates and limits of the signal.
YEAR, HALF, QUARTER, SKIP = 252, 126, 63, 5
MAX_STALE, MAX_FROZEN, VOL_SHARE, HOLDINGS = 5, 0.2, 0.9, 20


def scores(dense: DataFrame) -> DataFrame:
    """Returns, volatility, liquidity, frozen rate, stale gap and score of each security and session."""
    lag = lambda n: F.lag("close", n).over(by_security())
    over = lambda a, b: a / F.nullif(b, F.lit(0.0))
    t = dense.withColumn("_lr", F.when((F.col("close") > 0) & (lag(1) > 0), F.ln(F.col("close") / lag(1)))).withColumn("_k", F.row_number().over(by_security()))
    known = F.coalesce("_lr", F.lit(0.0))
    t = t.withColumns({"_n": sum_over(F.when(F.col("_lr").isNotNull(), 1.0).otherwise(0.0), YEAR), "_s1": sum_over(known, YEAR), "_s2": sum_over(known * known, YEAR)})
    t = t.withColumn("_seen", F.max(F.when(F.col("traded"), F.col("_k"))).over(by_security().rowsBetween(Window.unboundedPreceding, 0)))
    t = t.select(
        "sec", "d", "close", "traded",
        (over(F.col("close"), lag(YEAR)) - 1).alias("r12"), (over(lag(SKIP), lag(YEAR + SKIP)) - 1).alias("r12_skip"), (over(F.col("close"), lag(HALF)) - 1).alias("r6"), (over(F.col("close"), lag(QUARTER)) - 1).alias("r3"),
        F.when(F.col("_n") == YEAR, F.sqrt(F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * F.col("_s1") / YEAR) / (YEAR - 1)) * F.sqrt(F.lit(float(YEAR)))).alias("vol"),
        F.avg("turnover").over(rows(QUARTER)).alias("adtv"),
        over(sum_over(F.when(F.col("frozen") & F.col("traded"), 1.0).otherwise(0.0), HALF), sum_over(F.when(F.col("traded"), 1.0).otherwise(0.0), HALF)).alias("frozen_rate"),
        (F.col("_k") - (YEAR + SKIP) - F.lag("_seen", YEAR + SKIP).over(by_security())).alias("stale"),
    )
    agree = F.when(F.col("r6").isNotNull() & F.col("r12").isNotNull(), ((F.col("r6") > 0).cast("double") + (F.col("r12") > 0).cast("double")) / 2)
    return t.withColumn("agree", agree).withColumn("vam", F.col("r12_skip") / F.nullif("vol", F.lit(0.0))).withColumn("score", F.col("vam") * F.col("agree"))


def rank_table(scored: DataFrame, min_adtv: float, member: str | None = None, series: str | None = None, max_frozen: float = MAX_FROZEN) -> DataFrame:
    """Rows of one or more sessions with gates, the volatility rank among the eligible, and a total rank.

    Gates compare rounded columns; the most volatile tenth of the eligible goes; ranks order by score (to 9 places,
    so engines agree), then security, and never tie.
    """
    ok = (F.round("adtv", 2) >= min_adtv) & (F.col("stale") <= MAX_STALE) & (F.coalesce(F.round("frozen_rate", 3), F.lit(0.0)) <= max_frozen) & F.col("score").isNotNull() & F.col("traded")
    for gate in (member and F.col(member), series and F.coalesce(F.col(series), F.lit("EQ")) == "EQ"):
        ok = ok if gate is None else ok & gate
    t = scored.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_v", F.round(F.col("vol") * 100, 3))
    inside = Window.partitionBy("d", "_ok")
    ties = F.count("*").over(Window.partitionBy("d", "_ok", "_v"))
    pct = (F.rank().over(inside.orderBy("_v")) + (ties - 1) / 2) / F.count("*").over(inside)
    t = t.withColumn("vol_rank_pct", F.when(F.col("_ok"), pct)).withColumn("eligible", F.col("_ok") & F.coalesce(F.col("vol_rank_pct") <= VOL_SHARE, F.lit(False)))
    order = Window.partitionBy("d", "eligible").orderBy(F.round("score", 9).desc_nulls_last(), "sec")
    return t.withColumn("rank", F.when(F.col("eligible"), F.row_number().over(order)).cast("long")).drop("_ok", "_v")


def weights(ranked: DataFrame, holdings: int = HOLDINGS) -> DataFrame:
    """(sec, d, rank, weight_pct) of the top names of each session: at most *holdings* rows meet in one group."""

    def one(_, table):
        import pyarrow as pa

        t = table.sort_by("rank")
        return t.append_column("weight_pct", pa.array(capped(t.column("score").to_pylist()), pa.float64())).select(["sec", "d", "rank", "weight_pct"])

    ship(ranked.sparkSession)
    top = ranked.where(F.col("rank") <= holdings).select("sec", "d", "rank", F.round("score", 4).alias("score"))
    return top.groupBy("d").applyInArrow(one, f"sec {top.schema['sec'].dataType.simpleString()}, d date, rank long, weight_pct double")


def all_time_high(bars: DataFrame) -> DataFrame:
    """(sec, ath, ath_date): the highest close and the first day it was reached."""
    best = F.max(F.struct("close", (-F.unix_date("d")).alias("n")))
    return bars.groupBy("sec").agg(best.alias("b")).select("sec", F.col("b.close").alias("ath"), F.date_from_unix_date(-F.col("b.n")).alias("ath_date"))
