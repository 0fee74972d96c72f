"""Rolling measures of bars, and their flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def by_security():
    """One order for all windows over a security's own rows: they share one exchange and sort."""
    return Window.partitionBy("sec").orderBy("d")


def rows(n: int):
    """The current row and the n - 1 before it."""
    return by_security().rowsBetween(1 - n, 0)


def spread(bars: DataFrame) -> DataFrame:
    """Securities dealt over all shuffle partitions: adaptive execution would put the few bytes that windows work longest on into one."""
    return bars.repartition(int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sec")


def sum_over(value: Column, n: int) -> Column:
    """The sum of a column without nulls over n rows, from running sums: no frame is added up again for each row."""
    running = F.sum(value).over(by_security().rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum(value).over(by_security().rowsBetween(Window.unboundedPreceding, -n))
    return running - F.coalesce(before, F.lit(0.0))


def base_metrics(bars: DataFrame) -> DataFrame:
    """Previous close, return, gap in days, running count, and the median turnover of 60 rows with its observations."""
    back = F.lag("close").over(by_security())
    return spread(bars).withColumns({"prev_close": back, "prev_d": F.lag("d").over(by_security())}).select(
        "*", (F.col("close") / F.nullif("prev_close", F.lit(0.0)) - 1).alias("return_1d"), F.datediff("d", "prev_d").cast("long").alias("gap_days"),
        F.row_number().over(by_security()).cast("long").alias("history"), F.expr("percentile(turnover, 0.5D)").over(rows(60)).alias("median_turnover60"), F.count("turnover").over(rows(60)).alias("turnover_obs60"),
    ).drop("prev_d")


def anomaly_flags(metrics: DataFrame, warmup_end: str, live_from: str, move: float = 0.2, gap: int = 30) -> DataFrame:
    """Large moves, long gaps, warm-up and back-test periods; a null return is no move."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    return metrics.withColumns({
        "large_return": flag(F.abs("return_1d") > move), "long_gap": flag(F.col("gap_days") > gap), "is_warmup": F.col("d") < F.lit(warmup_end).cast("date"),
        "is_backtest": F.col("d") >= F.lit(warmup_end).cast("date"), "is_live": F.col("d") >= F.lit(live_from).cast("date"),
    })


def valid_ohlc() -> Column:
    return (F.least("open", "high", "low", "close") > 0) & (F.col("volume") >= 0) & (F.col("high") >= F.greatest("open", "low", "close")) & (F.col("low") <= F.least("open", "high", "close"))


def momentum(bars: DataFrame, *lags: int) -> DataFrame:
    """Returns over numbers of a security's own rows."""
    return spread(bars).withColumns({f"return_{n}": F.col("close") / F.nullif(F.lag("close", n).over(by_security()), F.lit(0.0)) - 1 for n in lags})


def trend_r2(bars: DataFrame, n: int = 126, origin: str = "1990-01-01") -> DataFrame:
    """R² of ln(close) on the day number over n rows; day numbers, not seconds, keep the sums exact enough."""
    t = spread(bars).withColumn("_y", F.when(F.col("close") > 0, F.ln("close"))).withColumn("_x", F.datediff("d", F.lit(origin).cast("date")).cast("double"))
    return t.withColumn("r2", F.regr_r2("_y", "_x").over(rows(n))).drop("_x", "_y")


def runs(bars: DataFrame) -> DataFrame:
    """(sec, run, close, first_d, last_d, length): stretches of unchanged closes."""
    changed = F.when(F.col("close").eqNullSafe(F.lag("close").over(by_security())), 0).otherwise(1)
    numbered = spread(bars).withColumn("_c", changed).withColumn("run", F.sum("_c").over(by_security().rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("sec", "run").agg(F.first("close").alias("close"), F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count("*").alias("length"))


def dense(bars: DataFrame) -> DataFrame:
    """Bars on every session of the calendar from a security's first: traded or not, close carried on, turnover 0 without a bar.

    Sessions of a calendar are few thousand and broadcast; the product with securities is the wanted result, made by
    an explode of each security's own sessions.
    """
    sessions = bars.select("d").distinct().agg(F.array_sort(F.collect_set("d")).alias("all"))
    secs = bars.groupBy("sec").agg(F.min("d").alias("first"))
    grid = secs.join(F.broadcast(sessions)).select("sec", F.explode(F.filter("all", lambda d: d >= F.col("first"))).alias("d"))
    full = grid.join(bars.select("sec", "d", F.col("close").alias("_close"), F.col("turnover").alias("_t"), F.col("volume").alias("_v"), F.col("high").alias("_h"), F.col("low").alias("_l")), ["sec", "d"], "left")
    full = spread(full)
    to_now = by_security().rowsBetween(Window.unboundedPreceding, 0)
    return full.select("sec", "d", F.last("_close", ignorenulls=True).over(to_now).alias("close"), F.coalesce("_t", F.lit(0.0)).alias("turnover"), F.coalesce(F.col("_v") > 0, F.lit(False)).alias("traded"), F.coalesce(F.col("_h") == F.col("_l"), F.lit(False)).alias("frozen"))
