"""Queries of the checks before publishing and of small relational steps, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import bars as ops
from tidemark.operators import certify
from tidemark.plans import driver_tables as t
from tidemark.plans.catalog import LIVE, RANKED, START, WITH_BARS, A, B, W, metrics, query, ranked, rounded

SPAN_SUBJECTS = ("Demerger", "Scheme Of Arrangement", "Amalgamation")
_SPANS = f"(SELECT sec, ex AS start, CASE WHEN subject = 'Amalgamation' THEN NULL ELSE ex + 60 END AS until FROM {A} WHERE subject IN {SPAN_SUBJECTS} AND ex >= DATE '{LIVE}')"
_COVERED = f"SELECT b.sec, b.d, coalesce(bool_or(b.d >= s.start AND b.d <= coalesce(s.until, DATE '9999-12-31')), false) AS is_covered FROM {B} b LEFT JOIN {_SPANS} s ON s.sec = b.sec GROUP BY 1, 2"


def spans(spark, sf):
    a = t.actions(spark, sf).where(F.col("subject").isin(*SPAN_SUBJECTS) & (F.col("ex") >= F.lit(LIVE).cast("date")))
    return a.select("sec", F.col("ex").alias("start"), F.when(F.col("subject") != "Amalgamation", F.date_add("ex", 60)).alias("until"))


def _covered(spark, sf):
    return certify.covered(t.bars(spark, sf).select("sec", "d"), spans(spark, sf), "sec", "d", "start", "until")


@query(_COVERED)
def spans_with_open_end(spark, sf):
    return _covered(spark, sf)


@query(f"SELECT sec, d FROM ({_COVERED}) WHERE NOT is_covered")
def not_contained(spark, sf):
    return _covered(spark, sf).where("not is_covered").select("sec", "d")


_NAMED = f"(SELECT event_id, CASE WHEN subject <> 'Demerger' THEN {t.ISIN_SQL} END AS isin, 'SYM' || sec AS symbol FROM {A})"


@query(f"SELECT s.s_suppkey AS sec, n.event_id FROM (SELECT *, s_suppkey AS sec FROM supplier) s JOIN {_NAMED} n ON n.isin = {t.ISIN_SQL.replace('sec', 's.sec')} OR (n.isin IS NULL AND n.symbol = 'SYM' || s.sec)")
def null_guarded_join(spark, sf):
    named = t.actions(spark, sf).select("event_id", F.when(F.col("subject") != "Demerger", t.isin(F.col("sec"))).alias("isin"), F.concat(F.lit("SYM"), "sec").alias("symbol"))
    s = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), t.isin(F.col("s_suppkey")).alias("isin"), F.concat(F.lit("SYM"), "s_suppkey").alias("symbol"))
    return certify.guarded_join(s, named, "isin", "symbol").select("sec", "event_id")


@query(f"SELECT sec, d, volume FROM {B} WHERE (sec, d) IN (SELECT sec, ex FROM {A})")
def tuple_in(spark, sf):
    keys = t.actions(spark, sf).select("sec", F.col("ex").alias("d")).distinct()
    return t.bars(spark, sf).join(keys, ["sec", "d"], "left_semi").select("sec", "d", "volume")


@query(f"SELECT sec, count(*) AS n FROM {B} WHERE d BETWEEN DATE '{START}' AND DATE '{LIVE}' AND volume > 20 GROUP BY 1")
def parameter_query(spark, sf):
    return spark.sql("SELECT sec, count(*) AS n FROM {bars} WHERE d BETWEEN CAST(:from AS DATE) AND CAST(:to AS DATE) AND volume > :volume GROUP BY sec", args={"from": START, "to": LIVE, "volume": 20}, bars=t.bars(spark, sf))


@query("SELECT s_suppkey AS sec, s_name AS name, CAST(NULL AS DATE) AS listed FROM supplier")
def absent_table_join(spark, sf):
    rows = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_name").alias("name"))
    return certify.optional_join(rows, None, ["sec"], {"listed": "date"})


_REFERENCE = "(SELECT s_nationkey AS k, 1 AS priority, s_suppkey AS id, CASE WHEN s_acctbal > 5000 THEN s_name END AS name FROM supplier UNION ALL SELECT c_nationkey, 2, c_custkey, c_name FROM customer)"


@query(f"SELECT k, arg_min(name, (priority, id)) FILTER (WHERE name IS NOT NULL) AS name FROM {_REFERENCE} GROUP BY 1")
def reference_by_priority(spark, sf):
    s = t.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.lit(1).alias("priority"), F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("name"))
    c = t.table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.lit(2).alias("priority"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return s.unionByName(c).where("name is not null").groupBy("k").agg(F.min_by("name", F.struct("priority", "id")).alias("name"))


@query(f"SELECT b.sec, max(b.d) AS last_d, coalesce(any_value(s.s_name), '') AS name FROM {B} b LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = b.sec GROUP BY 1")
def reference_lookup(spark, sf):
    names = t.table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("sec"), F.col("s_name").alias("name"))
    return t.bars(spark, sf).groupBy("sec").agg(F.max("d").alias("last_d")).join(names, "sec", "left").withColumn("name", F.coalesce("name", F.lit("")))


@query(f"SELECT sec, d, max(d) OVER (PARTITION BY year(d)) AS file_end FROM {B}")
def file_end(spark, sf):
    b = t.bars(spark, sf).select("sec", "d", F.year("d").alias("_y"))
    # One row a file, not its rows in one task.
    return b.join(b.groupBy("_y").agg(F.max("d").alias("file_end")), "_y").drop("_y")


@query(f"SELECT year(d) AS year, min(n) AS fewest, max(n) AS most, count(*) AS sessions FROM (SELECT d, count(*) AS n FROM {B} GROUP BY 1) GROUP BY 1")
def daily_counts(spark, sf):
    per = t.bars(spark, sf).groupBy("d").agg(F.count("*").alias("n"))
    return per.groupBy(F.year("d").cast("long").alias("year")).agg(F.min("n").alias("fewest"), F.max("n").alias("most"), F.count("*").alias("sessions"))


@query(f"SELECT d, volume, volume - lag(volume) OVER (ORDER BY d) AS change FROM (SELECT d, CAST(sum(volume) AS BIGINT) AS volume FROM {B} GROUP BY 1)")
def series_lag(spark, sf):
    one = t.bars(spark, sf).groupBy("d").agg(F.sum("volume").alias("volume"))  # one row a session: a few thousand
    return one.withColumn("change", F.col("volume") - F.lag("volume").over(Window.partitionBy(F.lit("market")).orderBy("d")))


@query(f"SELECT subject, count(*) AS n FROM {A} GROUP BY 1 ORDER BY n DESC, subject LIMIT 15")
def top_reasons(spark, sf):
    return t.actions(spark, sf).groupBy("subject").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "subject").limit(15)


@query(f"SELECT year, arg_max(sec, (n, -sec)) AS sec, max(n) AS n FROM (SELECT year(d) AS year, sec, count(*) AS n FROM {B} GROUP BY 1, 2) GROUP BY 1")
def main_identity(spark, sf):
    per = t.bars(spark, sf).groupBy(F.year("d").cast("long").alias("year"), "sec").agg(F.count("*").alias("n"))
    return per.groupBy("year").agg(F.max_by("sec", F.struct("n", -F.col("sec"))).alias("sec"), F.max("n").alias("n"))


_LEDGER = f"SELECT sec, ex AS d, 'ACTION' AS source, subject AS detail FROM {A} UNION ALL SELECT sec, d, 'BAR', NULL FROM {B} WHERE high = low AND volume >= 45"


@query(f"SELECT l.sec, l.d, l.source, l.detail, n.n AS actions_that_day FROM ({_LEDGER}) l LEFT JOIN (SELECT sec, ex, count(*) AS n FROM {A} GROUP BY 1, 2) n ON n.sec = l.sec AND n.ex = l.d")
def ledger_union(spark, sf):
    a = t.actions(spark, sf)
    acts = a.select("sec", F.col("ex").alias("d"), F.lit("ACTION").alias("source"), F.col("subject").alias("detail"))
    still = t.bars(spark, sf).where("high = low and volume >= 45").select("sec", "d", F.lit("BAR").alias("source"))
    per = a.groupBy("sec", F.col("ex").alias("d")).agg(F.count("*").alias("actions_that_day"))
    return acts.unionByName(still, allowMissingColumns=True).join(per, ["sec", "d"], "left")


@query(f"""SELECT sec, d, round(CASE WHEN pd >= make_date(CAST(year(d) AS INTEGER), 1, 1) - 15 THEN close / p - 1 END, 9) AS ret FROM (SELECT sec, d, close, lag(close) OVER ({W}) AS p, lag(d) OVER ({W}) AS pd FROM {B})""")
def year_context(spark, sf):
    """Each year's returns with no more of the year before than its last 15 days: an older close counts as none."""
    b = ops.spread(t.bars(spark, sf)).withColumns({"p": F.lag("close").over(ops.by_security()), "pd": F.lag("d").over(ops.by_security())})
    return b.select("sec", "d", F.round(F.when(F.col("pd") >= F.date_sub(F.trunc("d", "year"), 15), F.col("close") / F.col("p") - 1), 9).alias("ret"))


@query(f"SELECT sec, max(history) AS history FROM (SELECT sec, d, row_number() OVER ({W}) AS history FROM {B}) WHERE d < DATE '{LIVE}' GROUP BY 1")
def history_seed(spark, sf):
    return metrics(spark, sf).where(F.col("d") < F.lit(LIVE).cast("date")).groupBy("sec").agg(F.max("history").alias("history"))


_DAY = f"(SELECT sec, CASE WHEN sec % 13 = 0 THEN 'DUMMY' || sec ELSE {t.ISIN_SQL} END AS isin, d, CASE WHEN volume % 7 = 0 THEN high * 1.5 ELSE open END AS open, high, low, CASE WHEN volume % 11 = 0 THEN 0.0 ELSE close END AS close, volume, turnover FROM {B})"


def _day(spark, sf):
    b = t.bars(spark, sf)
    return b.select(
        "sec", F.when(F.col("sec") % 13 == 0, F.concat(F.lit("DUMMY"), "sec")).otherwise(t.isin(F.col("sec"))).alias("isin"), "d", F.when(F.col("volume") % 7 == 0, F.col("high") * 1.5).otherwise(F.col("open")).alias("open"),
        "high", "low", F.when(F.col("volume") % 11 == 0, 0.0).otherwise(F.col("close")).alias("close"), "volume", "turnover",
    )


_RULES = {
    "NO_ISIN": "isin IS NULL", "BAD_ISIN": "NOT starts_with(isin, 'INE')", "NO_PRICE": "open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL", "PRICE_NOT_POSITIVE": "least(open, high, low, close) <= 0",
    "HIGH_BELOW_LOW": "high < low", "OPEN_OUTSIDE": "open > high OR open < low", "CLOSE_OUTSIDE": "close > high OR close < low", "VOLUME_NEGATIVE": "volume < 0", "VOLUME_ZERO": "volume = 0",
    "TURNOVER_OFF": "abs(turnover - close * volume) > 0.5 * close * volume", "DUPLICATE": "same > 1", "FEW_ROWS": f"n_day < {certify.FEWEST}",
}
_RULED = f"(SELECT *, count(*) OVER (PARTITION BY d) AS n_day, count(*) OVER (PARTITION BY d, isin) AS same FROM {_DAY})"


@query(f"WITH ruled AS MATERIALIZED (SELECT * FROM {_RULED}) " + " UNION ALL ".join(f"SELECT d, '{k}' AS error, count(*) AS n FROM ruled WHERE {v} GROUP BY 1" for k, v in _RULES.items()))
def source_contract(spark, sf):
    return certify.contract(_day(spark, sf))


@query(f"SELECT sec, isin, d, volume FROM {_DAY} WHERE isin NOT LIKE 'INE%' OR isin LIKE 'DUMMY%'")
def placeholder_rows(spark, sf):
    return _day(spark, sf).where("isin NOT LIKE 'INE%' OR isin LIKE 'DUMMY%'").select("sec", "isin", "d", "volume")


_OFFICIAL = f"(SELECT sec, d, close + CASE WHEN volume % 5 = 0 THEN 0.01 ELSE 0.001 END AS close, CASE WHEN volume = 50 THEN 49 ELSE volume END AS volume FROM {B} WHERE volume <> 1)"


@query(f"""SELECT year(coalesce(s.d, o.d)) AS year, count(*) FILTER (WHERE abs(s.close - o.close) <= 0.005 AND s.volume = o.volume) AS matched, count(*) FILTER (WHERE abs(s.close - o.close) > 0.005) AS price_off,
  count(*) FILTER (WHERE s.volume <> o.volume) AS volume_off, count(*) FILTER (WHERE s.sec IS NULL) AS missing, count(*) FILTER (WHERE o.sec IS NULL) AS extra
  FROM (SELECT * FROM {B} WHERE volume <> 2) s FULL JOIN {_OFFICIAL} o ON o.sec = s.sec AND o.d = s.d GROUP BY 1""")
def exchange_verify(spark, sf):
    b = t.bars(spark, sf)
    official = b.where("volume <> 1").select("sec", "d", (F.col("close") + F.when(F.col("volume") % 5 == 0, 0.01).otherwise(0.001)).alias("close"), F.when(F.col("volume") == 50, 49).otherwise(F.col("volume")).alias("volume"))
    return certify.verify(b.where("volume <> 2"), official, ["sec", "d"]).withColumn("year", F.col("year").cast("long"))


@query(f"""SELECT year(d) AS year, count(*) AS n_rows, count(DISTINCT (sec, d)) AS n_keys, count(*) FILTER (WHERE sec IS NULL OR d IS NULL) AS no_key,
  count(*) FILTER (WHERE least(open, high, low, close) <= 0 OR open > high OR open < low OR close > high OR close < low) AS bad_prices, min(d) AS first_d, max(d) AS last_d FROM {_DAY} GROUP BY 1""")
def master_validation(spark, sf):
    day = _day(spark, sf)
    bad = (F.least("open", "high", "low", "close") <= 0) | (F.col("open") > F.col("high")) | (F.col("open") < F.col("low")) | (F.col("close") > F.col("high")) | (F.col("close") < F.col("low"))
    return day.groupBy(F.year("d").cast("long").alias("year")).agg(
        F.count("*").alias("n_rows"), F.count_distinct("sec", "d").alias("n_keys"), F.count_if(F.col("sec").isNull() | F.col("d").isNull()).alias("no_key"), F.count_if(bad).alias("bad_prices"), F.min("d").alias("first_d"), F.max("d").alias("last_d"),
    )


@query(f"""SELECT c.d, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'NOT_PUBLISHED' WHEN n < {certify.FEWEST} OR bad > 0 THEN 'ERROR' ELSE 'VALIDATED' END AS status
  FROM (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{LIVE}', INTERVAL 1 DAY)) AS DATE) AS d) c LEFT JOIN (SELECT d, count(*) AS n, count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS bad FROM {_DAY} GROUP BY 1) p ON p.d = c.d""")
def intake_ledger(spark, sf):
    days = spark.range(1).select(F.explode(F.sequence(F.lit(START).cast("date"), F.lit(LIVE).cast("date"))).alias("d"))
    return certify.intake(days, _day(spark, sf))


@query(WITH_BARS + f"""SELECT d, n AS n_ranked, CASE WHEN k <> n OR lo <> 1 OR hi <> n THEN 'FAIL_RANKS' WHEN n < 5 THEN 'FAIL_FEW_ROWS' WHEN n < 20 THEN 'WARN_SHORT_TOP' ELSE 'PASS' END AS verdict
  FROM (SELECT d, count(*) AS n, count(DISTINCT rank) AS k, min(rank) AS lo, max(rank) AS hi FROM {RANKED} WHERE rank IS NOT NULL GROUP BY 1)""")
def signal_gate(spark, sf):
    return certify.signal_gate(ranked(spark, sf), 20, 5)


@query(f"SELECT isin, count(*) AS n_rows, count(DISTINCT d) AS n_days, count(*) - count(DISTINCT (d, volume)) AS repeats FROM {_DAY} GROUP BY 1")
def secondary_profile(spark, sf):
    return _day(spark, sf).groupBy("isin").agg(F.count("*").alias("n_rows"), F.count_distinct("d").alias("n_days"), (F.count("*") - F.count_distinct("d", "volume")).alias("repeats"))


@query(f"SELECT b.sec, b.d, s.series, round(b.close, 9) AS close FROM {B} b JOIN {t.SERIES_SQL} s ON s.sec = b.sec AND s.d = b.d WHERE s.series <> 'EQ'")
def non_equity_facts(spark, sf):
    s = t.series(spark, sf).where("series <> 'EQ'")
    return rounded(t.bars(spark, sf).join(s, ["sec", "d"]).select("sec", "d", "series", "close"), 9, "close")
