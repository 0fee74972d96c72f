"""Backward adjustment of prices for corporate actions, and repair of missed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import asof_next, or_key_anti, or_key_join


def factors(events: DataFrame) -> DataFrame:
    """(sec, ex, factor): the product of a day's distinct factors; repeated notices count once."""
    one = events.where("price_factor is not null and price_factor > 0").select("sec", "ex", "subject", "price_factor").distinct()
    return one.groupBy("sec", "ex").agg(F.exp(F.sum(F.ln("price_factor"))).alias("factor"))


def factor_spans(events: DataFrame) -> DataFrame:
    """(sec, ex, factor, cumulative): the product of all factors from an ex-date on, which holds for the bars before it."""
    later = Window.partitionBy("sec").orderBy(F.col("ex").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return factors(events).withColumn("cumulative", F.exp(F.sum(F.ln("factor")).over(later)))


def adjusted(bars: DataFrame, events: DataFrame) -> DataFrame:
    """Bars with prices times, and volume over, the product of the factors of all later ex-dates.

    The products are made once per event by a running sum of logarithms; a bar takes that of its next ex-date.
    """
    at = asof_next(bars, factor_spans(events), "sec", "d", "ex", ["cumulative"], strict=True)
    f = F.coalesce("next_cumulative", F.lit(1.0))
    scaled = at.withColumn("price_factor", f).withColumns({f"adj_{c}": F.col(c) * f for c in ("open", "high", "low", "close")})
    return scaled.withColumn("adj_volume", F.round(F.col("volume") / f).try_cast("long")).drop("next_ex", "next_cumulative")


def adjusted_through(bars: DataFrame, events: DataFrame, through: str = "adjusted_through") -> DataFrame:
    """Bars times the factors with ex-date after both the bar and the date up to which its source is adjusted (null: never)."""
    keyed = bars.select("sec", "d", through).distinct()
    hit = keyed.join(factors(events), "sec").where((F.col("ex") > F.col("d")) & (F.col(through).isNull() | (F.col("ex") > F.col(through))))
    product = hit.groupBy("sec", "d").agg(F.exp(F.sum(F.ln("factor"))).alias("f"))
    return bars.join(product, ["sec", "d"], "left").withColumn("price_factor", F.coalesce("f", F.lit(1.0))).withColumn("adj_close", F.col("close") * F.col("price_factor")).drop("f")


# When a move counts as an event that was not applied, and when it may be repaired.
MOVE, MATCH, REPAIRED, BREAK, UNEXPLAINED, WINDOW_DAYS = 0.15, 0.10, 0.20, 0.35, 0.50, 5


def detect(prices: DataFrame, events: DataFrame) -> DataFrame:
    """(kind, sec, isin, d, event_id, price_factor, ret): breaks at ex-dates, by ISIN or security.

    MECHANICAL: the move is what the factor would make, and repairing leaves an ordinary one; RESIDUAL: it would
    not; NON_MECHANICAL: a fall at an event without factor; UNEXPLAINED: a move with no event within days of it.
    """
    p = prices.select("sec", "isin", "d", "ret").where("ret is not null")
    e = events.select(F.col("event_id"), F.col("sec").alias("e_sec"), F.col("isin").alias("e_isin"), F.col("ex"), "price_factor")
    at = or_key_join(p, e, [("isin", "e_isin"), ("sec", "e_sec")], also=[("d", "ex")])
    f, r = F.col("price_factor"), F.col("ret")
    scales = f.isNotNull() & (f != 1.0)
    after = (1 + r) / f - 1
    kind = F.when(scales & (F.abs(r) > MOVE) & (F.abs(r - (f - 1)) < MATCH), F.when(F.abs(after) <= REPAIRED, "MECHANICAL").otherwise("RESIDUAL")).when(~scales & (r <= -BREAK), "NON_MECHANICAL")
    found = at.withColumn("kind", kind).where("kind is not null").select("kind", "sec", "isin", "d", "event_id", "price_factor", "ret")
    first = Window.partitionBy("kind", "isin", "d").orderBy("event_id")
    found = found.withColumn("_n", F.row_number().over(first)).where((F.col("_n") == 1) | (F.col("kind") == "NON_MECHANICAL")).drop("_n")
    return found.unionByName(unexplained(p, e).select(F.lit("UNEXPLAINED").alias("kind"), "sec", "isin", "d", F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("double").alias("price_factor"), "ret"))


def unexplained(prices: DataFrame, events: DataFrame, move: float = UNEXPLAINED, days: int = WINDOW_DAYS) -> DataFrame:
    """Large moves with no event of the ISIN or security within days: two anti-joins with the window as residual."""
    large = prices.where(F.abs("ret") > move)
    return or_key_anti(large, events, [("isin", "e_isin"), ("sec", "e_sec")], F.abs(F.datediff("ex", "d")) <= days)


def apply_repair(prices: DataFrame, repairs: DataFrame) -> DataFrame:
    """Prices before each repaired ex-date times its factor, volumes over it, and the return at the boundary mended."""
    r = repairs.where("kind = 'MECHANICAL'").select("sec", F.col("d").alias("ex"), "price_factor", F.lit("").alias("subject")).distinct()
    scaled = adjusted(prices, r)
    mended = scaled.join(r.select(F.col("sec"), F.col("ex").alias("d"), F.col("price_factor").alias("f")), ["sec", "d"], "left")
    return mended.withColumn("ret", F.when(F.col("f").isNotNull(), (1 + F.col("ret")) / F.col("f") - 1).otherwise(F.col("ret"))).drop("f")
