"""Checks before publishing: coverage by spans, source contracts, re-verification, ledgers and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the end of a span that is still open.
FOREVER = "9999-12-31"
#: How far a price may be from the other source's, and the fewest rows of a published session.
PRICE_TOLERANCE, FEWEST = 0.005, 5


def covered(rows: DataFrame, spans: DataFrame, key: str, date: str, start: str, end: str) -> DataFrame:
    """*rows* with is_covered: whether a span of the same key holds the date; a null end is open.

    One pass in order of key and date: of the spans begun so far only the furthest end matters, so no pair is made.
    """
    ends = spans.select(F.col(key).alias("_k"), F.col(start).alias("_at"), F.coalesce(end, F.lit(FOREVER).cast("date")).alias("_end"), F.lit(0).alias("_row"))
    asked = rows.withColumns({"_k": F.col(key), "_at": F.col(date), "_end": F.lit(None).cast("date"), "_row": F.lit(1)})
    w = Window.partitionBy("_k").orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    both = asked.unionByName(ends, allowMissingColumns=True).withColumn("_until", F.max("_end").over(w)).where("_row = 1")
    return both.withColumn("is_covered", F.coalesce(F.col("_until") >= F.col("_at"), F.lit(False))).drop("_k", "_at", "_end", "_row", "_until")


def guarded_join(rows: DataFrame, other: DataFrame, first: str, second: str) -> DataFrame:
    """Inner join by *first*, or by *second* where *other*'s *first* is null: two equi-joins that share no pair."""
    o = other.withColumnsRenamed({first: "_first", second: "_second"})
    by_first = rows.join(o.where("_first is not null"), F.col(first) == F.col("_first"))
    by_second = rows.join(o.where("_first is null"), F.col(second) == F.col("_second"))
    return by_first.unionByName(by_second).drop("_first", "_second")


def optional_join(rows: DataFrame, other: DataFrame | None, on: list[str], columns: dict[str, str]) -> DataFrame:
    """Left join to a table that may not exist: its columns (name -> type) are null then."""
    if other is None:
        return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items()})
    return rows.join(other.select(*on, *columns), on, "left")


def contract(day: DataFrame) -> DataFrame:
    """(d, error, n): how many rows of each session break each rule of the source contract; rules nobody breaks have no row."""
    o, h, low, c, v, t = (F.col(x) for x in ("open", "high", "low", "close", "volume", "turnover"))
    per = Window.partitionBy("d")
    rows = day.withColumns({"_n": F.count("*").over(per), "_same": F.count("*").over(Window.partitionBy("d", "isin"))})
    rules: dict[str, Column] = {
        "NO_ISIN": F.col("isin").isNull(), "BAD_ISIN": ~F.col("isin").startswith("INE"), "NO_PRICE": o.isNull() | h.isNull() | low.isNull() | c.isNull(),
        "PRICE_NOT_POSITIVE": F.least(o, h, low, c) <= 0, "HIGH_BELOW_LOW": h < low, "OPEN_OUTSIDE": (o > h) | (o < low), "CLOSE_OUTSIDE": (c > h) | (c < low),
        "VOLUME_NEGATIVE": v < 0, "VOLUME_ZERO": v == 0, "TURNOVER_OFF": F.abs(t - c * v) > 0.5 * c * v, "DUPLICATE": F.col("_same") > 1, "FEW_ROWS": F.col("_n") < FEWEST,
    }
    counted = rows.groupBy("d").agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counted.unpivot(["d"], list(rules), "error", "n").where("n > 0")


def verify(stored: DataFrame, official: DataFrame, on: list[str]) -> DataFrame:
    """(year, matched, price_off, volume_off, missing, extra): stored rows against the exchange's own, prices within a tolerance, volumes exactly."""
    s = stored.select(*on, F.col("close").alias("_c"), F.col("volume").alias("_v"))
    o = official.select(*on, F.col("close").alias("_oc"), F.col("volume").alias("_ov"))
    both = s.join(o, on, "full")
    there = F.col("_c").isNotNull() & F.col("_oc").isNotNull()
    off, unlike = F.abs(F.col("_c") - F.col("_oc")) > PRICE_TOLERANCE, F.col("_v") != F.col("_ov")
    return both.groupBy(F.year("d").alias("year")).agg(
        F.count_if(there & ~off & ~unlike).alias("matched"), F.count_if(there & off).alias("price_off"), F.count_if(there & unlike).alias("volume_off"),
        F.count_if(F.col("_c").isNull()).alias("missing"), F.count_if(F.col("_oc").isNull()).alias("extra"),
    )


def intake(calendar: DataFrame, day: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(d, n_rows, status) for each expected session: VALIDATED, NOT_PUBLISHED without rows, ERROR with too few or invalid ones."""
    per = day.groupBy("d").agg(F.count("*").alias("n"), F.count_if(F.least("open", "high", "low", "close") <= 0).alias("bad"))
    status = F.when(F.col("n").isNull(), "NOT_PUBLISHED").when((F.col("n") < fewest) | (F.col("bad") > 0), "ERROR").otherwise("VALIDATED")
    return calendar.join(per, "d", "left").select("d", F.coalesce("n", F.lit(0)).alias("n_rows"), status.alias("status"))


def signal_gate(ranked: DataFrame, holdings: int, fewest: int) -> DataFrame:
    """(d, n_ranked, verdict): a session's ranking is published if it has rows enough and ranks 1 to n once each, so the top is exact."""
    per = ranked.where("rank is not null").groupBy("d").agg(F.count("*").alias("n_ranked"), F.countDistinct("rank").alias("k"), F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    fine = (F.col("k") == F.col("n_ranked")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n_ranked"))
    return per.select("d", "n_ranked", F.when(~fine, "FAIL_RANKS").when(F.col("n_ranked") < fewest, "FAIL_FEW_ROWS").when(F.col("n_ranked") < holdings, "WARN_SHORT_TOP").otherwise("PASS").alias("verdict"))
