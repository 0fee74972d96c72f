"""The registry of queries over the driver tables: each with the DuckDB SQL of the same rows, where SQL has it.

Floats are rounded on both sides where the engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import actions as act
from tidemark.functions import text as txt
from tidemark.operators import adjust, calendar, identity, joins, quality, quarantine, signal, universe
from tidemark.operators import bars as ops
from tidemark.plans import driver_tables as t
from tidemark.sources import readers
from tidemark.streaming import incremental as inc

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        if sql is not None:
            _ORACLES[name or f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


B = t.bars_sql()
SPARSE = t.bars_sql("l_partkey")
A = t.actions_sql()
W = "PARTITION BY sec ORDER BY d"
#: The first and last dates of a back-test over the driver tables, and where "live" data start.
START, END, LIVE = "1997-01-01", "2000-12-31", "1999-07-01"
METRICS = f"""(SELECT * EXCLUDE (prev_d), close / NULLIF(prev_close, 0) - 1 AS return_1d, date_diff('day', prev_d, d) AS gap_days FROM (
  SELECT *, lag(close) OVER ({W}) AS prev_close, lag(d) OVER ({W}) AS prev_d, row_number() OVER ({W}) AS history,
    median(turnover) OVER ({W} ROWS 59 PRECEDING) AS median_turnover60, count(turnover) OVER ({W} ROWS 59 PRECEDING) AS turnover_obs60 FROM {B}))"""


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ops.base_metrics(t.bars(spark, sf))


@query(f"SELECT sec, d, round(open, 9) AS open, round(high, 9) AS high, round(low, 9) AS low, round(close, 9) AS close, volume, turnover FROM {B}")
def bars_ohlcv(spark, sf):
    return rounded(t.bars(spark, sf), 9, "open", "high", "low", "close")


@query(f"""SELECT sec, d, round(close, 9) AS close, round(prev_close, 9) AS prev_close, round(return_1d, 9) AS return_1d, gap_days, history,
  round(median_turnover60, 9) AS median_turnover60, turnover_obs60 FROM {METRICS}""")
def base_metrics(spark, sf):
    m = metrics(spark, sf).select("sec", "d", "close", "prev_close", "return_1d", "gap_days", "history", "median_turnover60", "turnover_obs60")
    return rounded(m, 9, "close", "prev_close", "return_1d", "median_turnover60")


@query(f"""SELECT sec, d, coalesce(abs(return_1d) > 0.2, false) AS large_return, coalesce(gap_days > 30, false) AS long_gap, d < DATE '{START}' AS is_warmup,
  d >= DATE '{START}' AS is_backtest, d >= DATE '{LIVE}' AS is_live FROM {METRICS}""")
def anomaly_flags(spark, sf):
    return ops.anomaly_flags(metrics(spark, sf), START, LIVE).select("sec", "d", "large_return", "long_gap", "is_warmup", "is_backtest", "is_live")


@query(f"SELECT sec, d, round(max(close) OVER ({W} ROWS 251 PRECEDING), 9) AS high252, count(*) OVER ({W} ROWS 251 PRECEDING) AS n FROM {B}")
def rolling_max252(spark, sf):
    return rounded(t.bars(spark, sf).select("sec", "d", F.max("close").over(ops.rows(252)).alias("high252"), F.count("*").over(ops.rows(252)).alias("n")), 9, "high252")


@query(f"SELECT sec, d, round(regr_r2(CASE WHEN close > 0 THEN ln(close) END, date_diff('day', DATE '1990-01-01', d)) OVER ({W} ROWS 125 PRECEDING), 6) AS r2 FROM {B}")
def rolling_regr_r2(spark, sf):
    return rounded(ops.trend_r2(t.bars(spark, sf)).select("sec", "d", "r2"), 6, "r2")


@query("SELECT sec, d, " + ", ".join(f"round(close / NULLIF(lag(close, {n}) OVER ({W}), 0) - 1, 9) AS return_{n}" for n in (5, 63, 126, 252)) + f" FROM {B}")
def momentum_lags(spark, sf):
    m = ops.momentum(t.bars(spark, sf), 5, 63, 126, 252).select("sec", "d", "return_5", "return_63", "return_126", "return_252")
    return rounded(m, 9, "return_5", "return_63", "return_126", "return_252")


@query(f"SELECT sec, d, round(percent_rank() OVER (PARTITION BY d ORDER BY round(return_1d, 9) ASC NULLS FIRST) * 100, 9) AS pct FROM {METRICS}")
def percent_rank_scores(spark, sf):
    m = metrics(spark, sf).withColumn("r", F.round("return_1d", 9))
    return m.select("sec", "d", F.round(F.percent_rank().over(Window.partitionBy("d").orderBy(F.col("r").asc_nulls_first())) * 100, 9).alias("pct"))


@query(f"""SELECT sec, d, CAST(CASE WHEN ok THEN row_number() OVER (PARTITION BY d ORDER BY CASE WHEN ok THEN r END DESC NULLS LAST, turnover DESC NULLS LAST, sec) ELSE 9999 END AS BIGINT) AS final_rank
  FROM (SELECT *, round(return_1d, 9) AS r, coalesce(history >= 5 AND return_1d IS NOT NULL, false) AS ok FROM {METRICS})""")
def conditional_rank(spark, sf):
    m = metrics(spark, sf).withColumn("r", F.round("return_1d", 9)).withColumn("ok", F.coalesce((F.col("history") >= 5) & F.col("return_1d").isNotNull(), F.lit(False)))
    w = Window.partitionBy("d").orderBy(F.when(F.col("ok"), F.col("r")).desc_nulls_last(), F.col("turnover").desc_nulls_last(), "sec")
    return m.select("sec", "d", F.when(F.col("ok"), F.row_number().over(w)).otherwise(9999).cast("long").alias("final_rank"))


DENSE = f"""(SELECT g.sec, g.d, last_value(b.close IGNORE NULLS) OVER (PARTITION BY g.sec ORDER BY g.d ROWS UNBOUNDED PRECEDING) AS close, coalesce(b.turnover, 0.0) AS turnover,
  coalesce(b.volume > 0, false) AS traded, coalesce(b.high = b.low, false) AS frozen
  FROM (SELECT s.sec, c.d FROM (SELECT sec, min(d) AS first FROM bars GROUP BY 1) s JOIN (SELECT DISTINCT d FROM bars) c ON c.d >= s.first) g LEFT JOIN bars b ON b.sec = g.sec AND b.d = g.d)"""
WITH_BARS = f"WITH bars AS MATERIALIZED (SELECT * FROM {B}) "


@query(WITH_BARS + f"SELECT sec, d, round(close, 9) AS close, traded, turnover FROM {DENSE}")
def forward_fill(spark, sf):
    return rounded(ops.dense(t.bars(spark, sf)).select("sec", "d", "close", "traded", "turnover"), 9, "close")


@query(WITH_BARS + f"SELECT sec, d, max(CASE WHEN traded THEN d END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS last_traded, date_diff('day', max(CASE WHEN traded THEN d END) OVER ({W} ROWS UNBOUNDED PRECEDING), d) AS days_since FROM {DENSE}")
def last_traded(spark, sf):
    last = F.max(F.when(F.col("traded"), F.col("d"))).over(ops.by_security().rowsBetween(Window.unboundedPreceding, 0))
    return ops.dense(t.bars(spark, sf)).select("sec", "d", last.alias("last_traded"), F.datediff("d", last).cast("long").alias("days_since"))


RUNS = f"""(SELECT sec, CAST(sum(c) OVER ({W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run, close, d FROM (SELECT *, CASE WHEN close IS NOT DISTINCT FROM lag(close) OVER ({W}) THEN 0 ELSE 1 END AS c FROM
  (SELECT sec, d, round(close / 500, 0) AS close FROM {B})))"""


@query(f"SELECT sec, run, any_value(close) AS close, min(d) AS first_d, max(d) AS last_d, count(*) AS length FROM {RUNS} GROUP BY 1, 2")
def run_lengths(spark, sf):
    return ops.runs(t.bars(spark, sf).withColumn("close", F.round(F.col("close") / 500, 0))).withColumn("run", F.col("run").cast("long"))


@query(f"SELECT max(length) AS longest, CAST(sum(length) AS BIGINT) AS n_rows, count(*) AS n_runs FROM (SELECT count(*) AS length FROM {RUNS} GROUP BY sec, run)")
def run_length_summary(spark, sf):
    return ops.runs(t.bars(spark, sf).withColumn("close", F.round(F.col("close") / 500, 0))).agg(F.max("length").alias("longest"), F.sum("length").cast("long").alias("n_rows"), F.count("*").alias("n_runs"))


@query(f"""SELECT sec, d, round((rank() OVER (PARTITION BY d ORDER BY v) + (count(*) OVER (PARTITION BY d, v) - 1) / 2.0) / count(*) OVER (PARTITION BY d), 9) AS pct FROM (SELECT sec, d, round(close, 0) AS v FROM {B})""")
def pct_rank_avg_ties(spark, sf):
    b = t.bars(spark, sf).select("sec", "d", F.round("close", 0).alias("v"))
    day = Window.partitionBy("d")
    return b.select("sec", "d", F.round((F.rank().over(day.orderBy("v")) + (F.count("*").over(Window.partitionBy("d", "v")) - 1) / F.lit(2.0)) / F.count("*").over(day), 9).alias("pct"))


SCORES = f"""(SELECT *, vam * agree AS score FROM (SELECT *, r12_skip / NULLIF(vol, 0) AS vam,
  CASE WHEN r6 IS NOT NULL AND r12 IS NOT NULL THEN (CASE WHEN r6 > 0 THEN 1.0 ELSE 0.0 END + CASE WHEN r12 > 0 THEN 1.0 ELSE 0.0 END) / 2 END AS agree FROM (
  SELECT sec, d, close, traded, close / NULLIF(lag(close, 252) OVER w, 0) - 1 AS r12, lag(close, 5) OVER w / NULLIF(lag(close, 257) OVER w, 0) - 1 AS r12_skip, close / NULLIF(lag(close, 126) OVER w, 0) - 1 AS r6,
    close / NULLIF(lag(close, 63) OVER w, 0) - 1 AS r3,
    CASE WHEN count(lr) OVER (w ROWS 251 PRECEDING) = 252 THEN stddev_samp(lr) OVER (w ROWS 251 PRECEDING) * sqrt(252.0) END AS vol, avg(turnover) OVER (w ROWS 62 PRECEDING) AS adtv,
    sum(CASE WHEN frozen AND traded THEN 1.0 ELSE 0.0 END) OVER (w ROWS 125 PRECEDING) / NULLIF(sum(CASE WHEN traded THEN 1.0 ELSE 0.0 END) OVER (w ROWS 125 PRECEDING), 0) AS frozen_rate,
    k - 257 - lag(seen, 257) OVER w AS stale
  FROM (SELECT *, max(CASE WHEN traded THEN k END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS seen FROM (SELECT *, CASE WHEN close > 0 AND lag(close) OVER ({W}) > 0 THEN ln(close / lag(close) OVER ({W})) END AS lr, row_number() OVER ({W}) AS k FROM {DENSE})) WINDOW w AS ({W}))))"""


def scores(spark, sf):
    return signal.scores(ops.dense(t.bars(spark, sf)))


@query(WITH_BARS + f"SELECT sec, d, round(vol, 3) AS vol FROM {SCORES}")
def realised_vol(spark, sf):
    return rounded(scores(spark, sf).select("sec", "d", "vol"), 3, "vol")


@query(WITH_BARS + f"SELECT sec, d, round(adtv + 1e-7, 5) AS adtv FROM {SCORES}")
def adtv63(spark, sf):
    return scores(spark, sf).select("sec", "d", F.round(F.col("adtv") + 1e-7, 5).alias("adtv"))  # ties go up in both engines


@query(WITH_BARS + f"SELECT sec, d, round(frozen_rate, 6) AS frozen_rate, CAST(stale AS BIGINT) AS stale FROM {SCORES}")
def frozen_rate_and_stale_gap(spark, sf):
    return rounded(scores(spark, sf).select("sec", "d", "frozen_rate", F.col("stale").cast("long").alias("stale")), 6, "frozen_rate")


@query(WITH_BARS + f"SELECT sec, d, round(r12_skip, 6) AS r12_skip, agree, round(score, 3) + 0.0 AS score FROM {SCORES}")
def score_rank(spark, sf):
    s = scores(spark, sf).select("sec", "d", F.round("r12_skip", 6).alias("r12_skip"), "agree", F.round("score", 3).alias("score"))
    return s.withColumn("score", F.col("score") + 0.0)  # no negative zeros


RANKED = f"""(SELECT *, CASE WHEN eligible THEN row_number() OVER (PARTITION BY d, eligible ORDER BY round(score, 9) DESC NULLS LAST, sec) END AS rank FROM (
  SELECT *, ok AND coalesce(vol_rank_pct <= 0.9, false) AS eligible FROM (SELECT *, CASE WHEN ok THEN (rank() OVER (PARTITION BY d, ok ORDER BY v) + (count(*) OVER (PARTITION BY d, ok, v) - 1) / 2.0) / count(*) OVER (PARTITION BY d, ok) END AS vol_rank_pct
  FROM (SELECT *, coalesce(round(adtv, 2) >= 1000 AND stale <= 5 AND coalesce(round(frozen_rate, 3), 0) <= 0.9 AND score IS NOT NULL AND traded, false) AS ok, round(vol * 100, 3) AS v FROM {SCORES}))))"""


def ranked(spark, sf):
    return signal.rank_table(scores(spark, sf), 1000.0, max_frozen=0.9)  # the driver's bars are mostly of one trade, so frozen


@query(WITH_BARS + f"SELECT sec, d, eligible, round(vol_rank_pct, 6) AS vol_rank_pct, CAST(rank AS BIGINT) AS rank FROM {RANKED}")
def vol_filter(spark, sf):
    return rounded(ranked(spark, sf).select("sec", "d", "eligible", "vol_rank_pct", "rank"), 6, "vol_rank_pct")


@query(WITH_BARS + f"SELECT sec, d, CAST(rank AS BIGINT) AS rank FROM {RANKED} WHERE rank <= 20")
def signal_top20(spark, sf):
    return ranked(spark, sf).where(F.col("rank") <= 20).select("sec", "d", "rank")


@query()
def capped_weights(spark, sf):
    return signal.weights(ranked(spark, sf))


@query(f"SELECT sec, round(ath, 9) AS ath, ath_date FROM (SELECT sec, max(close) AS ath, min(d) FILTER (WHERE close = m) AS ath_date FROM (SELECT *, max(close) OVER (PARTITION BY sec) AS m FROM {B}) GROUP BY 1)")
def all_time_high(spark, sf):
    return rounded(signal.all_time_high(t.bars(spark, sf)), 9, "ath")


# Corporate actions.

_U = "upper(subject)"


def _has(words, text="u"):
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _is_word(words, text):
    return f"list_has_any(regexp_split_to_array({text}, '[^A-Z0-9]+'), [{', '.join(repr(w) for w in words)}])"


def _read_sql(rows, text="u"):
    """The rows with numbers n and gaps g of a text: number k stands between gaps k and k + 1."""
    return f"(SELECT *, list_transform(regexp_extract_all({text}, '{act.NUMBER}'), lambda x: CAST(x AS DOUBLE)) AS n, regexp_split_to_array({text}, '{act.NUMBER}') AS g FROM {rows})"


def _ratio_sql(named, start="1"):
    k = f"list_filter(range({start}, len(n)), lambda k: {named} AND trim(g[k + 1]) = ':')[1]"
    return f"CASE WHEN n[{k}] > 0 AND n[{k} + 1] > 0 THEN n[{k} + 1] / (n[{k} + 1] + n[{k}]) END"


def _bare_sql(gap):
    return f"rtrim(CASE WHEN right(rtrim({gap}, ' .'), 2) IN ('RS', 'RE') THEN left(rtrim({gap}, ' .'), -2) ELSE rtrim({gap}, ' .') END, ' .')"


def _face_sql(*rules):
    found = []
    for rule in rules:
        if rule == "words":
            k = "list_filter(range(1, len(n) + 1), lambda k: contains(g[k], 'FROM'))[1]"
            found.append((f"n[{k}]", f"n[list_filter(range({k} + 1, len(n) + 1), lambda j: contains(g[j], 'TO'))[1]]"))
        else:
            holds = f"right({_bare_sql('g[k + 1]')}, 2) = 'TO'"
            if rule == "near":
                holds = f"({holds} OR right({_bare_sql('g[k + 1]')}, 3) = 'TOR') AND length({_bare_sql("regexp_replace(ltrim(g[k + 1]), '^/-', '')")}) <= {act.REACH + 2}"
            else:
                holds = f"{holds} AND rtrim(g[k], ' .') <> {_bare_sql('g[k]')}"
            k = f"list_filter(range(1, len(n)), lambda k: {holds})[1]"
            found.append((f"n[{k}]", f"n[{k} + 1]"))
    o, w = "coalesce(" + ", ".join(f"CASE WHEN {w} IS NOT NULL THEN {o} END" for o, w in found) + ")", "coalesce(" + ", ".join(w for _, w in found) + ")"
    return f"CASE WHEN {o} > 0 AND {w} > 0 THEN {w} / {o} END"


_BONUS_WORD = _is_word(("BON", "BONUS"), "(CASE WHEN k > 1 THEN '0' ELSE '' END || g[k] || '0')")
V1 = f"""(SELECT *, CASE WHEN kind IN ('BUYBACK', 'DIVIDEND') THEN 1.0 WHEN kind = 'BONUS' THEN bonus WHEN kind = 'SPLIT' AND face < 1 THEN face END AS factor FROM (SELECT *, {_ratio_sql("contains(g[k], 'BONUS')")} AS bonus, {_face_sql("words")} AS face,
  CASE WHEN {_has(('DEMERGER', 'DE-MERGER'))} THEN 'DEMERGER' WHEN {_has(('MERGER', 'AMALGAM'))} THEN 'MERGER' WHEN contains(u, 'RIGHT') THEN 'RIGHTS' WHEN {_has(('BUY BACK', 'BUYBACK'))} THEN 'BUYBACK'
    WHEN {_has(('DIVIDEND', 'DISTRIBUTION'))} THEN 'DIVIDEND' WHEN contains(u, 'BONUS') THEN 'BONUS' WHEN {_has(('SPLIT', 'SUB-DIVISION', 'SUB DIVISION'))} THEN 'SPLIT' ELSE 'OTHER' END AS kind FROM {_read_sql(f'(SELECT *, {_U} AS u FROM {A})')}))"""
V3 = f"""(SELECT *, CASE WHEN blocked OR odd OR (has_bonus AND bonus IS NULL) OR (faced AND part IS NULL) THEN NULL WHEN has_bonus OR faced THEN CASE WHEN has_bonus THEN bonus ELSE 1.0 END * CASE WHEN faced THEN part ELSE 1.0 END END AS factor3 FROM (
  SELECT *, CASE WHEN shrinks THEN CASE WHEN face3 > 1 THEN face3 END WHEN splits THEN CASE WHEN face3 < 1 THEN face3 END END AS part, shrinks OR splits AS faced, has_bonus AND {_has(act.NON_EQUITY)} AS odd FROM (
  SELECT *, {_is_word(("BON", "BONUS"), "u")} AS has_bonus, contains(u, 'CONSOLIDAT') AS shrinks, {_has(act.SPLIT_WORDS)} AS splits, {_has(act.BLOCKERS)} AS blocked, {_ratio_sql(_BONUS_WORD)} AS bonus3, {_face_sql("words", "marks")} AS face3 FROM {V1})) )"""
V3 = V3.replace("(has_bonus AND bonus IS NULL)", "(has_bonus AND bonus3 IS NULL)").replace("CASE WHEN has_bonus THEN bonus ELSE", "CASE WHEN has_bonus THEN bonus3 ELSE")
EVENT_FACTOR = f"""(SELECT event_id, sec, ex, subject, CASE WHEN factor3 IS NULL AND NOT blocked AND NOT odd AND NOT (has_bonus AND bonus3 IS NULL) AND NOT (faced AND part IS NULL) AND NOT has_bonus AND NOT faced AND kind IN ('DIVIDEND', 'BUYBACK') THEN 1.0 ELSE factor3 END AS price_factor FROM {V3})"""


def events(spark, sf):
    return act.events(t.actions(spark, sf))


@query(f"SELECT event_id, subject, kind AS action_type, round(factor, 9) AS price_factor, round(1 / factor, 9) AS volume_factor, CASE WHEN kind IN ('BUYBACK', 'DIVIDEND') THEN 'NO_ADJUST' WHEN factor IS NOT NULL THEN 'PARSED' ELSE 'REVIEW' END AS parse_status FROM {V1}")
def ca_parse_v1(spark, sf):
    c = act.classify_v1(t.actions(spark, sf))
    return rounded(c.select("event_id", "subject", "action_type", "price_factor", "volume_factor", "parse_status"), 9, "price_factor", "volume_factor")


_BON = "(contains(g[s], 'BONUS') OR len(list_filter(regexp_split_to_array(g[s] || '0', '[^A-Z0-9]+'), lambda w: ends_with(w, 'BON'))) > 0)"
_TAIL = "coalesce(substr(u, list_min(list_filter([" + ", ".join(f"instr(u, '{w}')" for w in act.FACE_WORDS_V2) + "], lambda x: x > 0))), '')"
_READ2 = _read_sql(f"(SELECT *, trim(regexp_replace({_U}, '\\s+', ' ', 'g')) AS u FROM {A})")
_TAILS = f"(SELECT * EXCLUDE (n, g), {_TAIL} AS tail, {_has(act.NON_EQUITY_V2)} AS excluded, {_ratio_sql('true', f'list_filter(range(1, len(n)), lambda s: {_BON})[1]')} AS ratio FROM {_READ2})"
V2 = f"""(SELECT *, coalesce(b2, 1.0) * coalesce(f2, 1.0) AS product, b2 IS NOT NULL OR f2 IS NOT NULL AS found FROM (SELECT *, CASE WHEN NOT excluded THEN ratio END AS b2, CASE WHEN fv <> 1 THEN fv END AS f2 FROM (
  SELECT *, {_face_sql("near")} AS fv FROM {_read_sql(_TAILS, "tail")})))"""
KIND2 = f"""CASE WHEN {_has(('DEMERG', 'DE-MERG'))} THEN 'DEMERGER' WHEN contains(u, 'AMALGAM') OR {_is_word(("MERGER",), "u")} THEN 'MERGER_OR_AMALGAMATION' WHEN {_is_word(("RIGHT", "RIGHTS"), "u")} THEN 'RIGHTS'
  WHEN found AND product < 100 THEN concat_ws('_AND_', CASE WHEN b2 IS NOT NULL THEN 'BONUS' END, CASE WHEN f2 < 1 THEN 'SPLIT' WHEN f2 > 1 THEN 'CONSOLIDATION' END) WHEN found THEN 'MECHANICAL_UNPARSED'
  WHEN {_has(act.MECHANICAL_V2)} AND NOT excluded THEN 'MECHANICAL_UNPARSED' WHEN contains(u, 'DIVIDEND') OR {_is_word(("DIV",), "u")} THEN 'DIVIDEND' WHEN {_has(('BUYBACK', 'BUY BACK'))} THEN 'BUYBACK' ELSE 'OTHER_INFORMATIONAL' END"""


@query(f"""SELECT event_id, subject, kind AS action_type, round(CASE WHEN kind IN ('DIVIDEND', 'BUYBACK', 'OTHER_INFORMATIONAL') THEN 1.0 WHEN kind NOT IN ('DEMERGER', 'MERGER_OR_AMALGAMATION', 'RIGHTS', 'MECHANICAL_UNPARSED') THEN product END, 9) AS price_factor,
  CASE WHEN kind IN ('DEMERGER', 'MERGER_OR_AMALGAMATION', 'RIGHTS', 'MECHANICAL_UNPARSED') THEN 'REVIEW' WHEN kind IN ('DIVIDEND', 'BUYBACK', 'OTHER_INFORMATIONAL') THEN 'NO_ADJUST' ELSE 'PARSED' END AS parse_status FROM (SELECT *, {KIND2} AS kind FROM {V2})""")
def ca_parse_v2(spark, sf):
    c = act.classify_v2(t.actions(spark, sf))
    return rounded(c.select("event_id", "subject", "action_type", "price_factor", "parse_status"), 9, "price_factor")


@query(f"SELECT event_id, subject, round(price_factor, 9) AS price_factor, round(1 / price_factor, 9) AS volume_factor, CASE WHEN price_factor IS NOT NULL THEN 'PARSED' ELSE 'REVIEW' END AS parse_status FROM {EVENT_FACTOR}")
def ca_parse_v3(spark, sf):
    return rounded(events(spark, sf).select("event_id", "subject", "price_factor", "volume_factor", "parse_status"), 9, "price_factor", "volume_factor")


FACTORS = f"(SELECT sec, ex, exp(sum(ln(price_factor))) AS factor FROM (SELECT DISTINCT sec, ex, subject, price_factor FROM {EVENT_FACTOR} WHERE price_factor > 0) GROUP BY 1, 2)"


@query(f"SELECT sec, ex, round(factor, 9) AS factor FROM {FACTORS}")
def ca_compound_factor(spark, sf):
    return rounded(adjust.factors(events(spark, sf)), 9, "factor")


@query(f"SELECT b.sec, b.d, round(coalesce(exp(sum(ln(f.factor))), 1.0), 9) AS price_factor FROM {B} b LEFT JOIN {FACTORS} f ON f.sec = b.sec AND f.ex > b.d GROUP BY 1, 2")
def factor_product(spark, sf):
    return rounded(adjust.adjusted(t.bars(spark, sf), events(spark, sf)).select("sec", "d", "price_factor"), 9, "price_factor")


ADJUSTED = f"(SELECT b.sec, b.d, b.close, b.volume, coalesce(exp(sum(ln(f.factor))), 1.0) AS f FROM {B} b LEFT JOIN {FACTORS} f ON f.sec = b.sec AND f.ex > b.d GROUP BY ALL)"


@query(f"SELECT sec, d, round(close * f + 1e-9, 7) AS adj_close, CASE WHEN round(f, 9) > 0 THEN CAST(floor(volume / f * (1 + 1e-11) + 0.5) AS BIGINT) END AS adj_volume FROM {ADJUSTED}")
def adjusted_bars(spark, sf):
    a = adjust.adjusted(t.bars(spark, sf), events(spark, sf))
    return a.select("sec", "d", F.round(F.col("adj_close") + 1e-9, 7).alias("adj_close"), F.when(F.round("price_factor", 9) > 0, F.floor(F.col("volume") / F.col("price_factor") * (1 + 1e-11) + 0.5)).cast("long").alias("adj_volume"))


@query(f"""SELECT b.sec, b.d, round(coalesce(exp(sum(ln(f.factor))), 1.0), 9) AS price_factor FROM (SELECT *, CASE WHEN sec % 2 = 0 THEN DATE '{LIVE}' END AS thru FROM {B}) b
  LEFT JOIN {FACTORS} f ON f.sec = b.sec AND f.ex > b.d AND (b.thru IS NULL OR f.ex > b.thru) GROUP BY 1, 2""")
def adjusted_through(spark, sf):
    b = t.bars(spark, sf).withColumn("adjusted_through", F.when(F.col("sec") % 2 == 0, F.lit(LIVE).cast("date")))
    return rounded(adjust.adjusted_through(b, events(spark, sf)).select("sec", "d", "price_factor"), 9, "price_factor")


# As-of and other joins.


@query(f"SELECT a.event_id, a.sec, a.ex, max(b.d) AS prior_d, round(arg_max(b.close, b.d), 9) AS prior_close FROM {A} a LEFT JOIN {B} b ON b.sec = a.sec AND b.d < a.ex AND b.d >= a.ex - 15 GROUP BY 1, 2, 3")
def asof_prior(spark, sf):
    j = joins.asof_prior(t.actions(spark, sf).select("event_id", "sec", "ex"), t.bars(spark, sf), "sec", "ex", "d", ["close"], within_days=15)
    return rounded(j, 9, "prior_close")


@query(f"SELECT a.event_id, a.sec, a.ex, min(b.d) AS next_d, round(arg_min(b.close, b.d), 9) AS next_close FROM {A} a LEFT JOIN {B} b ON b.sec = a.sec AND b.d >= a.ex AND b.d <= a.ex + 15 GROUP BY 1, 2, 3")
def asof_next(spark, sf):
    j = joins.asof_next(t.actions(spark, sf).select("event_id", "sec", "ex"), t.bars(spark, sf), "sec", "ex", "d", ["close"], within_days=15)
    return rounded(j, 9, "next_close")


@query(f"SELECT sec, d, lead(d, 251) OVER ({W}) AS d251 FROM {B}")
def nth_next(spark, sf):
    return t.bars(spark, sf).select("sec", "d", F.lead("d", 251).over(ops.by_security()).alias("d251"))


BRIDGE = f"""(SELECT a.*, (SELECT max(d) FROM bars b WHERE b.sec = a.sec AND b.d < a.ex) AS pre_d, (SELECT arg_max(close, d) FROM bars b WHERE b.sec = a.sec AND b.d < a.ex) AS pre_close,
  (SELECT min(d) FROM bars b WHERE b.sec = a.sec AND b.d >= a.ex) AS post_d, (SELECT arg_min(close, d) FROM bars b WHERE b.sec = a.sec AND b.d >= a.ex) AS post_close FROM {V1} a)"""


def bridge(spark, sf):
    e = act.classify_v1(t.actions(spark, sf))
    pre = joins.asof_prior(e, t.bars(spark, sf), "sec", "ex", "d", ["close"], prefix="pre_")
    post = joins.asof_next(pre, t.bars(spark, sf), "sec", "ex", "d", ["close"], prefix="post_")
    return post.withColumn("gap", F.when(F.col("price_factor") > 0, F.col("post_close") / F.nullif(F.col("pre_close") * F.col("price_factor"), F.lit(0.0)) - 1))


@query(WITH_BARS + f"SELECT event_id, pre_d, round(pre_close, 9) AS pre_close, post_d, round(post_close, 9) AS post_close, round(CASE WHEN factor > 0 THEN post_close / NULLIF(pre_close * factor, 0) - 1 END, 9) AS gap FROM {BRIDGE}")
def ca_bridge(spark, sf):
    return rounded(bridge(spark, sf).select("event_id", "pre_d", "pre_close", "post_d", "post_close", "gap"), 9, "pre_close", "post_close", "gap")


@query(WITH_BARS + f"""SELECT event_id, CASE WHEN kind IN ('BUYBACK', 'DIVIDEND') THEN 'INFORMATIONAL_NO_PRICE_ADJUSTMENT' WHEN kind NOT IN ('SPLIT', 'BONUS') OR factor IS NULL THEN 'REVIEW_COMPLEX_OR_UNPARSED' WHEN gap IS NULL THEN 'REVIEW_MISSING_PRICE_BRIDGE'
  WHEN abs(gap) <= 0.35 THEN 'AUTO_READY_SPLIT_BONUS' ELSE 'REVIEW_PRICE_BRIDGE' END AS decision FROM (SELECT *, round(CASE WHEN factor > 0 THEN post_close / NULLIF(pre_close * factor, 0) - 1 END, 9) AS gap FROM {BRIDGE})""")
def ca_decision(spark, sf):
    b = bridge(spark, sf)
    return b.select("event_id", act.decision_v1(F.col("parse_status"), F.col("action_type"), F.lit("MATCHED_UNIQUE_ISIN"), F.round("gap", 9)).alias("decision"))


@query(WITH_BARS + f"""SELECT decision, count(*) AS n FROM (SELECT CASE WHEN ex NOT BETWEEN lo AND hi THEN 'OUTSIDE_PIT_OBSERVATION' WHEN kind IN ('BUYBACK', 'DIVIDEND') THEN 'INFORMATIONAL_NO_PRICE_ADJUSTMENT' WHEN factor IS NULL THEN 'REVIEW_COMPLEX_OR_UNPARSED'
  WHEN gap IS NULL THEN CASE WHEN (pre_d IS NULL AND date_diff('day', lo, ex) <= 15) OR (post_d IS NULL AND date_diff('day', ex, hi) <= 15) THEN 'NO_PIT_CROSS_EVENT_BRIDGE_REQUIRED' ELSE 'REVIEW_MISSING_PRICE_BRIDGE' END
  WHEN abs(gap) <= 0.35 THEN CASE WHEN round(cf, 9) <> round(factor, 9) THEN 'AUTO_READY_VERIFIED_MECHANICAL_COMPOUND' ELSE 'AUTO_READY_VERIFIED_MECHANICAL' END ELSE 'REVIEW_PRICE_BRIDGE' END AS decision FROM (
  SELECT b.*, lo, hi, cf, round(CASE WHEN cf > 0 THEN post_close / NULLIF(pre_close * cf, 0) - 1 END, 9) AS gap FROM (SELECT *, CASE WHEN factor IS NOT NULL THEN exp(sum(ln(factor)) OVER (PARTITION BY sec, ex)) END AS cf FROM {BRIDGE}) b
  JOIN (SELECT sec, min(d) AS lo, max(d) AS hi FROM bars GROUP BY 1) s ON s.sec = b.sec)) GROUP BY 1""")
def ca_decision_pit(spark, sf):
    span = t.bars(spark, sf).groupBy("sec").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    b = bridge(spark, sf).join(span, "sec").withColumn("cf", F.when(F.col("price_factor").isNotNull(), F.exp(F.sum(F.ln("price_factor")).over(Window.partitionBy("sec", "ex")))))
    gap = F.round(F.when(F.col("cf") > 0, F.col("post_close") / F.nullif(F.col("pre_close") * F.col("cf"), F.lit(0.0)) - 1), 9)
    edge = (F.col("pre_d").isNull() & (F.datediff("ex", "lo") <= 15)) | (F.col("post_d").isNull() & (F.datediff("hi", "ex") <= 15))
    status = F.when(F.col("price_factor").isNull(), "REVIEW").otherwise(F.col("parse_status"))
    d = act.decision_v2(status, F.col("ex").between(F.col("lo"), F.col("hi")), gap, edge, F.round("cf", 9) != F.round("price_factor", 9))
    return b.select(d.alias("decision")).groupBy("decision").agg(F.count("*").alias("n"))


SPANS = f"(SELECT event_id, sec, ex AS a, ex + CAST(event_id % 90 + 1 AS INTEGER) AS b FROM {A})"


@query(f"SELECT e.event_id, p.d, count(*) AS n FROM (SELECT DISTINCT d FROM {B}) p JOIN {SPANS} e ON p.d >= e.a AND p.d < e.b GROUP BY 1, 2")
def interval_join(spark, sf):
    e = t.actions(spark, sf).select("event_id", F.col("ex").alias("a"), F.date_add("ex", (F.col("event_id") % 90 + 1).cast("int")).alias("b"))
    return joins.interval_join(t.bars(spark, sf).select("d").distinct(), e, "d", "a", "b").groupBy("event_id", "d").agg(F.count("*").alias("n"))


@query(f"""SELECT event_id, first_d, last_d, covered FROM (SELECT e.event_id, s.first_d, s.last_d, e.ex BETWEEN s.first_d AND s.last_d AS covered, row_number() OVER (PARTITION BY e.event_id ORDER BY (e.ex BETWEEN s.first_d AND s.last_d) DESC, abs(date_diff('day', s.last_d, e.ex)), s.first_d) AS n
  FROM {A} e JOIN (SELECT sec, year(d) AS y, min(d) AS first_d, max(d) AS last_d FROM {B} GROUP BY 1, 2) s ON s.sec = e.sec) WHERE n = 1""")
def nearest_interval(spark, sf):
    s = t.bars(spark, sf).groupBy("sec", F.year("d").alias("y")).agg(F.min("d").alias("first_d"), F.max("d").alias("last_d"))
    return joins.nearest_interval(t.actions(spark, sf).select("event_id", "sec", "ex"), s, "sec", "ex", "first_d", "last_d", ["first_d"], ["event_id"]).select("event_id", "first_d", "last_d", "covered")


_PRICES = f"(SELECT sec, {t.ISIN_SQL} AS isin, d, close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS ret, close, volume FROM {B})"
#: Events are filed under the ISIN of the security before every other one: the OR of both keys matters.
_EVENTS = f"(SELECT event_id, sec AS e_sec, {t.ISIN_SQL.replace('sec', '(sec + event_id % 2)')} AS e_isin, ex, price_factor FROM {EVENT_FACTOR})"


def prices(spark, sf):
    b = t.bars(spark, sf)
    return b.select("sec", t.isin(F.col("sec")).alias("isin"), "d", (F.col("close") / F.nullif(F.lag("close").over(ops.by_security()), F.lit(0.0)) - 1).alias("ret"), "open", "high", "low", "close", "volume")


def filed(spark, sf):
    return events(spark, sf).select("event_id", "sec", t.isin(F.col("sec") + F.col("event_id") % 2).alias("isin"), "ex", "price_factor")


@query(f"SELECT p.sec, p.d, e.event_id FROM {_PRICES} p JOIN {_EVENTS} e ON p.d = e.ex AND (p.isin = e.e_isin OR p.sec = e.e_sec)")
def or_key_join(spark, sf):
    e = filed(spark, sf).select("event_id", F.col("sec").alias("e_sec"), F.col("isin").alias("e_isin"), "ex")
    return joins.or_key_join(prices(spark, sf), e, [("isin", "e_isin"), ("sec", "e_sec")], also=[("d", "ex")]).select("sec", "d", "event_id")


@query(f"SELECT sec, d FROM {_PRICES} p WHERE NOT EXISTS (SELECT 1 FROM {_EVENTS} e WHERE (e.e_isin = p.isin OR e.e_sec = p.sec) AND abs(date_diff('day', e.ex, p.d)) <= 5)")
def or_key_anti(spark, sf):
    e = filed(spark, sf).select(F.col("sec").alias("e_sec"), F.col("isin").alias("e_isin"), "ex")
    return joins.or_key_anti(prices(spark, sf), e, [("isin", "e_isin"), ("sec", "e_sec")], F.abs(F.datediff("ex", "d")) <= 5).select("sec", "d")


@query(f"""SELECT sec, d, q_sec FROM (SELECT b.sec, b.d, q.sec AS q_sec, row_number() OVER (PARTITION BY b.sec, b.d ORDER BY q.volume DESC, q.sec) AS n FROM {B} b JOIN {B} q ON q.d = b.d AND (b.sec % 7 = q.sec % 7 OR b.sec % 5 = q.sec % 5) AND q.sec <> b.sec) WHERE n = 1""")
def alias_join(spark, sf):
    b = t.bars(spark, sf)
    al = lambda c: F.array(F.concat(F.lit("A"), c % 7), F.concat(F.lit("B"), c % 5))
    left = b.select("sec", "d", al(F.col("sec")).alias("la"))
    right = b.select(F.col("sec").alias("q_sec"), "d", F.col("volume").alias("q_volume"), al(F.col("sec")).alias("ra"))
    # Arrays are the remainders by 35, dates those of the calendar.
    return joins.alias_join(left, right, "la", "ra", "d", ("sec", "q_sec"), [F.col("q_volume").desc(), F.col("q_sec")], few=True).select("sec", "d", "q_sec")


@query()
def greedy_assignment(spark, sf):
    b = t.bars(spark, sf)
    m = b.select("d", F.concat(F.lit("S"), F.col("sec") + F.col("sec") % 3).alias("symbol"), t.isin(F.floor(F.col("sec") / 2)).alias("isin"))
    r = b.select("d", F.concat(F.lit("S"), F.col("sec")).alias("symbol"), t.isin(F.floor(F.col("sec") / 2)).alias("isin"))
    return joins.assign(m.dropDuplicates(["d", "symbol"]), r, "d", "symbol", "isin")


@query(f"""SELECT s.sec, c.d FROM (SELECT sec, min(d) AS a, max(d) AS b, count(*) AS n FROM {B} GROUP BY 1) s JOIN (SELECT DISTINCT d FROM {B}) c ON c.d BETWEEN s.a AND s.b ANTI JOIN {B} x ON x.sec = s.sec AND x.d = c.d WHERE s.n >= 10""")
def anti_missing_sessions(spark, sf):
    return calendar.missing_sessions(t.bars(spark, sf), 10)


@query(f"SELECT sec, d, volume FROM {B} WHERE d IN (SELECT DISTINCT d FROM {B} ORDER BY d DESC LIMIT 500)")
def semi_retention(spark, sf):
    return inc.retained(t.bars(spark, sf).select("sec", "d", "volume"), "d", 500)


@query(f"SELECT b.sec, b.d, b.volume, q.delivered, round(q.delivered / NULLIF(b.volume, 0), 9) AS share FROM {B} b LEFT JOIN {t.DELIVERY_SQL} q USING (sec, d)")
def delivery_join(spark, sf):
    return t.bars(spark, sf).join(t.delivery(spark, sf), ["sec", "d"], "left").select("sec", "d", "volume", "delivered", F.round(F.col("delivered") / F.nullif("volume", F.lit(0)), 9).alias("share"))


# Quarantine and repair.

REVIEW = f"(SELECT event_id, sec, ex FROM {EVENT_FACTOR} WHERE price_factor IS NULL)"
REVIEW_SESSIONS = f"(SELECT sec, d, event_id FROM (SELECT b.sec, b.d, e.event_id, row_number() OVER (PARTITION BY e.event_id ORDER BY b.d) AS n FROM {REVIEW} e JOIN {B} b ON b.sec = e.sec AND b.d >= e.ex) WHERE n <= 252)"


def review(spark, sf):
    return events(spark, sf).where("price_factor is null").select("event_id", "sec", "ex")


@query(f"SELECT sec, d, count(*) AS n_events FROM {REVIEW_SESSIONS} GROUP BY 1, 2")
def quarantine_review(spark, sf):
    return quarantine.sessions_after(t.bars(spark, sf), review(spark, sf)).groupBy("sec", "d").agg(F.count("*").alias("n_events"))


RELISTED = f"(SELECT sec, d AS ex FROM (SELECT sec, d, close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS r, date_diff('day', lag(d) OVER ({W}), d) AS g FROM {SPARSE}) WHERE g > 30 AND abs(r) > 0.2)"


@query(f"SELECT sha256(concat_ws('|', sec, ex)) AS event_id, sec, ex FROM {RELISTED}")
def quarantine_relisting(spark, sf):
    b = t.bars(spark, sf, "l_partkey")
    m = b.select("sec", "d", (F.col("close") / F.nullif(F.lag("close").over(ops.by_security()), F.lit(0.0)) - 1).alias("return_1d"), F.datediff("d", F.lag("d").over(ops.by_security())).alias("gap_days"))
    return quarantine.relistings(m)


@query(f"SELECT event_id, sec, min(d) AS start, max(d) AS end FROM {REVIEW_SESSIONS} GROUP BY 1, 2")
def quarantine_intervals(spark, sf):
    return quarantine.intervals(t.bars(spark, sf), review(spark, sf))


@query(f"""SELECT sec, d, string_agg(DISTINCT reason, '|' ORDER BY reason) AS reason FROM (SELECT sec, d, 'REVIEW_CORPORATE_ACTION' AS reason FROM {REVIEW_SESSIONS} UNION ALL SELECT sec, d, 'LARGE_MOVE' FROM {METRICS} WHERE abs(return_1d) > 2 UNION ALL SELECT sec, d, 'ONE_PRICE' FROM {B} WHERE high = low) GROUP BY 1, 2""")
def quarantine_reason(spark, sf):
    b = t.bars(spark, sf)
    return quarantine.reasons((quarantine.sessions_after(b, review(spark, sf)), "REVIEW_CORPORATE_ACTION"), (metrics(spark, sf).where(F.abs("return_1d") > 2), "LARGE_MOVE"), (b.where("high = low"), "ONE_PRICE"))


@query(f"""SELECT label AS discontinuity, count(*) AS n FROM (SELECT CASE WHEN r IS NULL THEN 'FIRST_BAR' WHEN abs(r) <= 0.45 THEN 'CONTINUOUS' WHEN g > 10 THEN 'GAP' WHEN frozen THEN 'QUARANTINED' WHEN abs(r - rw) <= 0.05 THEN 'RAW_MOVE' ELSE 'UNRESOLVED' END AS label
  FROM (SELECT close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS r, open / NULLIF(lag(open) OVER ({W}), 0) - 1 AS rw, date_diff('day', lag(d) OVER ({W}), d) AS g, high = low AS frozen FROM {B})) GROUP BY 1""")
def discontinuity(spark, sf):
    b = t.bars(spark, sf).withColumn("quarantined", F.col("high") == F.col("low"))
    return quarantine.discontinuities(b, "open", "quarantined").groupBy("discontinuity").agg(F.count("*").alias("n"))


@query(WITH_BARS + f"SELECT sec, d, CAST(max(CASE WHEN coalesce(abs(r) > 5, false) THEN 1 ELSE 0 END) OVER ({W} ROWS 251 PRECEDING) AS BIGINT) = 1 AS blackout FROM (SELECT *, close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS r FROM {DENSE})")
def blackout(spark, sf):
    d = ops.dense(t.bars(spark, sf)).withColumn("flag", F.coalesce(F.abs(F.col("close") / F.nullif(F.lag("close").over(ops.by_security()), F.lit(0.0)) - 1) > 5, F.lit(False)))
    return quarantine.blackout(d, "flag").select("sec", "d", "blackout")


@query(f"""SELECT b.sec, b.d, round(coalesce(x.close, y.close, b.close), 9) AS close, CASE WHEN x.close IS NOT NULL THEN 'MASTER' WHEN y.close IS NOT NULL THEN 'SECONDARY' ELSE 'RAW' END AS source FROM {B} b
  LEFT JOIN (SELECT * FROM {B} WHERE sec % 3 = 0) x USING (sec, d) LEFT JOIN (SELECT sec, d, open AS close FROM {B} WHERE volume % 2 = 0) y USING (sec, d)""")
def source_precedence(spark, sf):
    b = t.bars(spark, sf)
    x = b.where("sec % 3 = 0").select("sec", "d", F.col("close").alias("x"))
    y = b.where("volume % 2 = 0").select("sec", "d", F.col("open").alias("y"))
    return b.join(x, ["sec", "d"], "left").join(y, ["sec", "d"], "left").select("sec", "d", F.round(F.coalesce("x", "y", "close"), 9).alias("close"), F.when(F.col("x").isNotNull(), "MASTER").when(F.col("y").isNotNull(), "SECONDARY").otherwise("RAW").alias("source"))


_AT = f"(SELECT p.*, e.event_id, e.price_factor AS f FROM {_PRICES} p JOIN {_EVENTS} e ON p.d = e.ex AND (p.isin = e.e_isin OR p.sec = e.e_sec) WHERE ret IS NOT NULL)"
_UNEXPLAINED = f"(SELECT * FROM {_PRICES} p WHERE ret IS NOT NULL AND abs(ret) > 0.5 AND NOT EXISTS (SELECT 1 FROM {_EVENTS} e WHERE (e.e_isin = p.isin OR e.e_sec = p.sec) AND abs(date_diff('day', e.ex, p.d)) <= 5))"
DETECTED = f"""(SELECT kind, sec, isin, d, event_id, price_factor, ret FROM (SELECT *, row_number() OVER (PARTITION BY kind, isin, d ORDER BY event_id) AS n FROM (SELECT CASE WHEN f IS NOT NULL AND f <> 1 AND abs(ret) > 0.15 AND abs(ret - (f - 1)) < 0.10 THEN CASE WHEN abs((1 + ret) / f - 1) <= 0.2 THEN 'MECHANICAL' ELSE 'RESIDUAL' END
  WHEN (f IS NULL OR f = 1) AND ret <= -0.35 THEN 'NON_MECHANICAL' END AS kind, sec, isin, d, event_id, f AS price_factor, ret FROM {_AT}) WHERE kind IS NOT NULL) WHERE n = 1 OR kind = 'NON_MECHANICAL')"""


@query(f"""SELECT kind, sec, isin, d, event_id, round(price_factor, 9) AS price_factor, round(ret, 9) AS ret FROM {DETECTED} UNION ALL SELECT 'UNEXPLAINED', sec, isin, d, NULL, NULL, round(ret, 9) FROM {_UNEXPLAINED}""")
def repair_detect(spark, sf):
    return rounded(adjust.detect(prices(spark, sf), filed(spark, sf)), 9, "price_factor", "ret")


@query(f"""SELECT p.sec, p.d, round(any_value(p.close) * exp(coalesce(sum(ln(r.f)) FILTER (WHERE r.d > p.d), 0)), 9) AS adj_close, round(CASE WHEN any_value(r.f) FILTER (WHERE r.d = p.d) IS NOT NULL THEN (1 + any_value(p.ret)) / any_value(r.f) FILTER (WHERE r.d = p.d) - 1 ELSE any_value(p.ret) END, 9) AS ret
  FROM {_PRICES} p LEFT JOIN (SELECT DISTINCT sec, d, price_factor AS f FROM {DETECTED} WHERE kind = 'MECHANICAL') r ON r.sec = p.sec AND r.d >= p.d GROUP BY 1, 2""")
def repair_apply(spark, sf):
    p = prices(spark, sf)
    fixed = adjust.apply_repair(p, adjust.detect(p, filed(spark, sf)))
    return fixed.select("sec", "d", F.round("adj_close", 9).alias("adj_close"), F.round("ret", 9).alias("ret"))


@query(f"SELECT sec, d, round(ret, 9) AS ret FROM {_UNEXPLAINED}")
def unexplained_breaks(spark, sf):
    e = filed(spark, sf).select(F.col("sec").alias("e_sec"), F.col("isin").alias("e_isin"), "ex")
    return rounded(adjust.unexplained(prices(spark, sf).where("ret is not null"), e).select("sec", "d", "ret"), 9, "ret")


# Universes and panels.

SIZE = 20
CANDIDATES = f"""(SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY month, ok ORDER BY median_turnover60 DESC NULLS LAST, sec) END AS liquidity_rank FROM (
  SELECT l.*, e.rebalance, coalesce(date_diff('day', l.d, e.rebalance) <= 7 AND history >= 252 AND turnover_obs60 >= 40 AND median_turnover60 > 0 AND series = 'EQ', false) AS ok FROM (
  SELECT *, row_number() OVER (PARTITION BY sec, month ORDER BY d DESC) AS n FROM (SELECT m.*, series, CAST(date_trunc('month', d) AS DATE) AS month FROM metrics m JOIN {t.SERIES_SQL} s USING (sec, d))) l
  JOIN (SELECT CAST(date_trunc('month', d) AS DATE) AS month, max(d) AS rebalance FROM metrics GROUP BY 1) e USING (month) WHERE l.n = 1 AND month < (SELECT CAST(date_trunc('month', max(d)) AS DATE) FROM metrics)))"""
WITH_METRICS = f"WITH metrics AS MATERIALIZED (SELECT * REPLACE (round(median_turnover60, 7) AS median_turnover60) FROM {METRICS}) "


def candidate_rows(spark, sf):
    m = rounded(metrics(spark, sf), 7, "median_turnover60").join(t.series(spark, sf), ["sec", "d"])
    return universe.candidates(m)


@query(WITH_METRICS + f"SELECT rebalance, sec, CAST(liquidity_rank AS BIGINT) AS liquidity_rank, median_turnover60 FROM {CANDIDATES} WHERE liquidity_rank <= {SIZE}")
def month_universe(spark, sf):
    return universe.monthly(candidate_rows(spark, sf), SIZE)


@query(WITH_METRICS + f"SELECT rebalance, count(*) FILTER (WHERE ok) AS eligible, count(*) FILTER (WHERE liquidity_rank <= {SIZE}) AS selected, CASE WHEN count(*) FILTER (WHERE liquidity_rank <= {SIZE}) = {SIZE} THEN 'FULL' WHEN count(*) FILTER (WHERE liquidity_rank <= {SIZE}) > 0 THEN 'PARTIAL' ELSE 'EMPTY' END AS status FROM {CANDIDATES} GROUP BY 1")
def universe_coverage(spark, sf):
    return universe.coverage(candidate_rows(spark, sf), SIZE)


@query(WITH_METRICS + f"SELECT rebalance, count(*) AS n, count(*) = max(liquidity_rank) AND count(DISTINCT liquidity_rank) = count(*) AND count(DISTINCT sec) = count(*) AND min(liquidity_rank) = 1 AS is_valid FROM (SELECT * FROM {CANDIDATES} WHERE liquidity_rank <= {SIZE}) GROUP BY 1")
def rank_integrity(spark, sf):
    return quality.rank_integrity(universe.monthly(candidate_rows(spark, sf), SIZE), "rebalance", "liquidity_rank", "sec").select("rebalance", "n", "is_valid")


MEMBERS = f"(SELECT u.rebalance, n.nxt, u.sec, u.liquidity_rank FROM (SELECT * FROM {CANDIDATES} WHERE liquidity_rank <= {SIZE}) u JOIN (SELECT rebalance, lead(rebalance) OVER (ORDER BY rebalance) AS nxt FROM (SELECT DISTINCT rebalance FROM {CANDIDATES} WHERE liquidity_rank <= {SIZE})) n USING (rebalance))"


@query(WITH_METRICS + f"SELECT m.sec, m.d, u.rebalance, CAST(u.liquidity_rank AS BIGINT) AS liquidity_rank FROM metrics m JOIN {MEMBERS} u ON u.sec = m.sec AND m.d > u.rebalance AND (u.nxt IS NULL OR m.d <= u.nxt)")
def pit_membership(spark, sf):
    members = universe.monthly(candidate_rows(spark, sf), SIZE).select("rebalance", "sec", "liquidity_rank")
    return joins.point_in_time(t.bars(spark, sf).select("sec", "d"), members, "sec", "d", "rebalance").select("sec", "d", "rebalance", "liquidity_rank")


@query(WITH_METRICS + f""", h AS (SELECT sec, d, close, history, median_turnover60, close / NULLIF(lag(close, 252) OVER ({W}), 0) - 1 AS r12, close / NULLIF(lag(close, 126) OVER ({W}), 0) - 1 AS r6, close / NULLIF(lag(close, 63) OVER ({W}), 0) - 1 AS r3,
  close / NULLIF(max(close) OVER ({W} ROWS 251 PRECEDING), 0) - 1 AS below_high, round(regr_r2(CASE WHEN close > 0 THEN ln(close) END, date_diff('day', DATE '1990-01-01', d)) OVER ({W} ROWS 125 PRECEDING), 6) AS r2 FROM metrics),
  b AS (SELECT h.*, u.liquidity_rank, round(0.5 * r12 + 0.3 * r6 + 0.2 * r3, 9) AS momentum FROM h JOIN (SELECT max(d) AS d FROM metrics WHERE d BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY date_trunc('week', d)) w USING (d) JOIN {MEMBERS} u ON u.sec = h.sec AND h.d > u.rebalance AND (u.nxt IS NULL OR h.d <= u.nxt)),
  s AS (SELECT *, coalesce(history >= 252 AND close > 0 AND median_turnover60 > 0 AND below_high >= -0.9 AND r12 IS NOT NULL AND r6 IS NOT NULL AND r3 IS NOT NULL AND r2 IS NOT NULL, false) AS eligible FROM b),
  p AS (SELECT *, round(0.6 * (percent_rank() OVER (PARTITION BY d ORDER BY momentum ASC NULLS FIRST) * 100) + 0.4 * (percent_rank() OVER (PARTITION BY d ORDER BY r2 ASC NULLS FIRST) * 100), 9) AS score FROM s)
  SELECT sec, d, momentum, r2, score, eligible, CAST(CASE WHEN eligible THEN row_number() OVER (PARTITION BY d ORDER BY CASE WHEN eligible THEN score END DESC NULLS LAST, momentum DESC NULLS LAST, r2 DESC NULLS LAST, liquidity_rank, sec) ELSE 9999 END AS BIGINT) AS final_rank,
    count(*) OVER (PARTITION BY d) AS universe_count, count(*) FILTER (WHERE eligible) OVER (PARTITION BY d) AS eligible_count FROM p""")
def weekly_rank(spark, sf):
    m = rounded(metrics(spark, sf), 7, "median_turnover60")
    members = universe.monthly(candidate_rows(spark, sf), SIZE)
    return universe.weekly_ranks(m, members, START, END, max_below_high=0.9).select("sec", "d", "momentum", "r2", "score", "eligible", "final_rank", "universe_count", "eligible_count")


@query(f"SELECT * FROM (SELECT sec, d, round(close / NULLIF(lag(close, 5) OVER ({W}), 0) - 1, 9) AS return_5 FROM {B}) WHERE d BETWEEN DATE '{START}' AND DATE '{END}'")
def return5d(spark, sf):
    m = rounded(ops.momentum(t.bars(spark, sf), 5).select("sec", "d", "return_5"), 9, "return_5")
    return m.where(F.col("d").between(F.lit(START).cast("date"), F.lit(END).cast("date")))


# Quality.


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_groups(spark, sf):
    return quality.duplicates(t.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT count(*) - count(DISTINCT concat(l_orderkey, '|', l_linenumber)) AS repeated FROM lineitem")
def dup_count_by_concat(spark, sf):
    return t.table(spark, sf, "lineitem").agg((F.count("*") - F.countDistinct("l_orderkey", "l_linenumber")).alias("repeated"))


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE close IS NULL) AS null_close, count(*) FILTER (WHERE open <= 0) AS open_not_positive, count(*) FILTER (WHERE close <= 0) AS close_not_positive, count(*) FILTER (WHERE high < low) AS high_below_low,
  count(*) FILTER (WHERE high < greatest(open, close)) AS high_too_low, count(*) FILTER (WHERE low > least(open, close)) AS low_too_high, count(*) FILTER (WHERE volume < 0) AS volume_negative, count(*) FILTER (WHERE volume = 0) AS volume_zero,
  count(*) FILTER (WHERE high = low) AS frozen, count(*) FILTER (WHERE NOT (least(open, high, low, close) > 0 AND volume >= 0 AND high >= greatest(open, low, close) AND low <= least(open, high, close))) AS invalid, count(*) FILTER (WHERE dayofweek(d) IN (0, 6)) AS weekend FROM {B}""")
def bar_sanity(spark, sf):
    return quality.bar_sanity(t.bars(spark, sf))


@query(f"SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS n_rows, count(DISTINCT sec) AS securities, count(DISTINCT d) AS sessions, min(d) AS first_d, max(d) AS last_d FROM {B} GROUP BY 1")
def shape_per_year(spark, sf):
    return quality.shape(t.bars(spark, sf))


@query(f"SELECT alive, gone, late, round(gone / NULLIF(alive, 0), 6) AS share_gone FROM (SELECT count(*) FILTER (WHERE a <= p AND b >= p) AS alive, count(*) FILTER (WHERE a <= p AND b >= p AND b < e) AS gone, count(*) FILTER (WHERE a > p) AS late FROM (SELECT sec, min(d) AS a, max(d) AS b, DATE '{START}' AS p FROM {SPARSE} GROUP BY 1), (SELECT max(d) - 30 AS e FROM {SPARSE}))")
def survivorship_overlap(spark, sf):
    return quality.survivorship(t.bars(spark, sf, "l_partkey"), F.lit(START).cast("date"))


@query(f"SELECT count(*) FILTER (WHERE a AND b) AS \"both\", count(*) FILTER (WHERE b IS NULL) AS only_a, count(*) FILTER (WHERE a IS NULL) AS only_b FROM (SELECT sec, true AS a FROM {SPARSE} WHERE year(d) = 1996 GROUP BY 1) x FULL JOIN (SELECT sec, true AS b FROM {SPARSE} WHERE year(d) = 2000 GROUP BY 1) y USING (sec)")
def membership_overlap(spark, sf):
    b = t.bars(spark, sf, "l_partkey")
    return quality.overlap(b.where(F.year("d") == 1996), b.where(F.year("d") == 2000), "sec")


@query(WITH_BARS + f"SELECT CASE WHEN d < DATE '{START}' THEN 'EARLY' WHEN d < DATE '{LIVE}' THEN 'MIDDLE' ELSE 'LIVE' END AS era, count(*) AS members, count(*) FILTER (WHERE traded) AS priced_days, round(count(*) FILTER (WHERE traded) / count(*), 6) AS share FROM {DENSE} GROUP BY 1")
def member_coverage_era(spark, sf):
    b = t.bars(spark, sf)
    era = F.when(F.col("d") < F.lit(START).cast("date"), "EARLY").when(F.col("d") < F.lit(LIVE).cast("date"), "MIDDLE").otherwise("LIVE")
    return quality.member_coverage(ops.dense(b).select("sec", "d"), b, era)


@query(f"SELECT CASE WHEN volume = 0 THEN '0 NOT_TRADED' WHEN turnover < 1e5 THEN '1 BELOW_1E5' WHEN turnover < 1e6 THEN '2 BELOW_1E6' WHEN turnover < 1e7 THEN '3 BELOW_1E7' ELSE '4 FROM_1E7' END AS bucket, count(*) AS n_rows, count(*) FILTER (WHERE high = low) AS frozen FROM {B} GROUP BY 1")
def tradability(spark, sf):
    return quality.tradability(t.bars(spark, sf))


@query(f"SELECT (SELECT count(*) FROM (SELECT sec, volume FROM {B} EXCEPT ALL SELECT sec, volume FROM {B} WHERE sec % 5 <> 0)) AS only_a, (SELECT count(*) FROM (SELECT sec, volume FROM {B} WHERE sec % 5 <> 0 EXCEPT ALL SELECT sec, volume FROM {B})) AS only_b")
def except_all_parity(spark, sf):
    b = t.bars(spark, sf).select("sec", "volume")
    return quality.parity(b, b.where("sec % 5 <> 0"))


@query(f"SELECT sec, volume, 'A' AS side FROM (SELECT sec, volume FROM {B} WHERE year(d) = 1997 EXCEPT SELECT sec, volume FROM {B} WHERE year(d) = 1998) UNION ALL SELECT sec, volume, 'B' FROM (SELECT sec, volume FROM {B} WHERE year(d) = 1998 EXCEPT SELECT sec, volume FROM {B} WHERE year(d) = 1997)")
def sym_diff(spark, sf):
    b = t.bars(spark, sf)
    year = lambda y: b.where(F.year("d") == y).select("sec", "volume")
    return quality.symmetric_difference(year(1997), year(1998))


@query(f"SELECT sec, d, volume, NULL::BIGINT AS delivered FROM {B} UNION ALL SELECT sec, d, NULL, delivered FROM {t.DELIVERY_SQL}")
def union_by_name(spark, sf):
    return t.bars(spark, sf).select("sec", "d", "volume").unionByName(t.delivery(spark, sf), allowMissingColumns=True)


@query(f"SELECT coalesce(o.sec, n.sec) AS key, CASE WHEN o.sec IS NULL THEN 'ADDED' WHEN n.sec IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM (SELECT sec, max(volume) AS v FROM {SPARSE} WHERE year(d) = 1997 GROUP BY 1) o FULL JOIN (SELECT sec, max(volume) AS v FROM {SPARSE} WHERE year(d) = 1998 GROUP BY 1) n ON o.sec = n.sec WHERE o.v IS DISTINCT FROM n.v")
def snapshot_diff(spark, sf):
    b = t.bars(spark, sf, "l_partkey")
    year = lambda y: b.where(F.year("d") == y).groupBy("sec").agg(F.max("volume").alias("v"))
    return quality.snapshot_diff(year(1997), year(1998), "sec", "v")


@query(f"SELECT e.event_id, e.sec, e.ex, round(p.ret, 9) AS ret, coalesce(abs(round(p.ret, 9)) > 0.5, false) AS is_suspect FROM {A} e JOIN {_PRICES} p ON p.sec = e.sec AND p.d = e.ex")
def ex_date_moves(spark, sf):
    return quality.ex_date_moves(t.bars(spark, sf), t.actions(spark, sf))


@query(f"""SELECT sec, count(*) AS sessions, round(list_sort(list(diff))[CAST(count(*) // 2 + 1 AS BIGINT)], 9) AS upper_median_diff, round(count(*) FILTER (WHERE diff <= 0.005) / count(*), 6) AS share_within FROM (SELECT sec, abs(round(ret, 9) - round(rc, 9)) AS diff FROM (SELECT sec, d, close / NULLIF(lag(close) OVER ({W}), 0) - 1 AS ret, high / NULLIF(lag(high) OVER ({W}), 0) - 1 AS rc FROM {B}) WHERE ret IS NOT NULL AND rc IS NOT NULL) GROUP BY 1""")
def external_agreement(spark, sf):
    b = t.bars(spark, sf)
    ret = lambda c: b.select("sec", "d", F.round(F.col(c) / F.nullif(F.lag(c).over(ops.by_security()), F.lit(0.0)) - 1, 9).alias("ret"))
    return quality.agreement(ret("close"), ret("high"))


@query()
def stratified_sessions(spark, sf):
    return quality.stratified_sessions(t.bars(spark, sf), 6, 3, 7)


# Calendar.


@query(f"SELECT d, dayname(d) AS weekday, count(DISTINCT sec) AS securities, dayofweek(d) IN (0, 6) AS is_weekend_session FROM {B} GROUP BY 1")
def calendar_sessions(spark, sf):
    return calendar.sessions(t.bars(spark, sf))


@query(f"SELECT d, dayname(d) AS weekday, CASE WHEN dayofweek(d) IN (0, 6) THEN 'WEEKEND' ELSE 'INFERRED_HOLIDAY' END AS reason FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM {SPARSE}) WHERE d NOT IN (SELECT d FROM {SPARSE})")
def calendar_non_trading(spark, sf):
    return calendar.non_trading(t.bars(spark, sf, "l_partkey"))


@query(WITH_BARS + f"SELECT year, coverage, CASE WHEN coverage >= 0.99 THEN 'BACKTEST_SAFE' WHEN coverage >= 0.9 THEN 'PARTIAL' ELSE 'PRICE_DATA_ONLY' END AS label FROM (SELECT CAST(year(d) AS INTEGER) AS year, round(count(*) FILTER (WHERE traded) / count(*), 6) AS coverage FROM {DENSE} GROUP BY 1)")
def year_labels(spark, sf):
    per = ops.dense(t.bars(spark, sf)).groupBy(F.year("d").alias("year")).agg(F.round(F.count_if("traded") / F.count("*"), 6).alias("coverage"))
    return calendar.year_labels(per)


# Identities and ledgers.

_SYMBOL = "'S' || CAST(sec - (year(d) % 3 = 0)::INT * (sec % 2) AS VARCHAR)"


def named(spark, sf):
    b = t.bars(spark, sf)
    return b.select("sec", "d", F.concat(F.lit("S"), F.col("sec") - F.when(F.year("d") % 3 == 0, F.col("sec") % 2).otherwise(0)).alias("symbol"), t.isin(F.col("sec")).alias("isin"))


@query(f"SELECT isin, arg_max(symbol, d) AS symbol, CAST(to_json(list_sort(list(DISTINCT symbol))) AS VARCHAR) AS symbols, min(d) AS first_d, max(d) AS last_d, count(*) AS sessions FROM (SELECT sec, d, {_SYMBOL} AS symbol, {t.ISIN_SQL} AS isin FROM {B}) GROUP BY 1")
def security_master(spark, sf):
    return identity.security_master(named(spark, sf), "symbol", "isin")


@query(f"SELECT {_SYMBOL} AS symbol, {t.ISIN_SQL} AS isin, min(d) AS first_d, max(d) AS last_d, count(*) AS sessions FROM {B} GROUP BY 1, 2")
def symbol_history(spark, sf):
    return identity.spans(named(spark, sf), "symbol", "isin")


_SPANS = f"(SELECT {_SYMBOL} AS symbol, {t.ISIN_SQL} AS isin, min(d) AS first_d, max(d) AS last_d FROM {B} GROUP BY 1, 2)"


@query(f"SELECT isin, symbol AS old_symbol, nxt AS new_symbol, nd AS on FROM (SELECT *, lead(symbol) OVER w AS nxt, lead(first_d) OVER w AS nd FROM {_SPANS} WINDOW w AS (PARTITION BY isin ORDER BY first_d, symbol)) WHERE nxt <> symbol".replace("AS on FROM", 'AS "on" FROM'))
def symbol_transitions(spark, sf):
    return identity.transitions(identity.spans(named(spark, sf), "symbol", "isin"))


_CHAIN = f"(SELECT 'P' || CAST(sec % 40 AS VARCHAR) AS symbol, 'INE' || lpad(CAST(sec % 40 AS VARCHAR), 6, '0') || lpad(CAST(sec // 40 % 1000 AS VARCHAR), 3, '0') AS isin, DATE '1995-01-01' + CAST(sec // 40 * 30 AS INTEGER) AS first_d, DATE '1995-01-01' + CAST(sec // 40 * 30 + 5 + sec * 7 % 24 AS INTEGER) AS last_d FROM (SELECT DISTINCT l_partkey AS sec FROM lineitem))"


@query(f"""SELECT isin, arg_min(canonical, symbol) AS canonical FROM (SELECT *, first_value(isin) OVER (PARTITION BY symbol, chain ORDER BY first_d, isin) AS canonical FROM (SELECT *, sum(CASE WHEN left(isin, 9) = left(pi, 9) AND date_diff('day', pl, first_d) BETWEEN 1 AND 20 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY first_d, isin) AS chain
  FROM (SELECT *, lag(isin) OVER w AS pi, lag(last_d) OVER w AS pl FROM {_CHAIN} WINDOW w AS (PARTITION BY symbol ORDER BY first_d, isin)))) GROUP BY 1""")
def lineage_chain(spark, sf):
    p = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("sec")).distinct()
    k = F.floor(F.col("sec") / 40)
    day0 = F.lit("1995-01-01").cast("date")
    s = p.select(
        F.concat(F.lit("P"), F.col("sec") % 40).alias("symbol"), F.concat(F.lit("INE"), F.lpad((F.col("sec") % 40).cast("string"), 6, "0"), F.lpad((k % 1000).cast("string"), 3, "0")).alias("isin"),
        F.date_add(day0, (k * 30).cast("int")).alias("first_d"), F.date_add(day0, (k * 30 + 5 + F.col("sec") * 7 % 24).cast("int")).alias("last_d"))
    return identity.lineage(s)


@query("SELECT name, CASE WHEN count(DISTINCT s) = 1 THEN min(s) END AS symbol, count(DISTINCT s) AS n_symbols, count(DISTINCT s) = 1 AS is_unique FROM (SELECT p_type AS name, p_brand AS s FROM part) GROUP BY 1")
def name_unique_map(spark, sf):
    return identity.unique_names(t.table(spark, sf, "part"), "p_type", "p_brand")


@query(f"SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(p_name), '&', ' AND ', 'g'), '[^A-Z0-9 ]', ' ', 'g'), '{txt.NAME_ENDINGS}', ' ', 'g'), ' +', ' ', 'g')) AS name FROM part")
def name_normalise(spark, sf):
    return t.table(spark, sf, "part").select("p_partkey", txt.company_name(F.col("p_name")).alias("name"))


@query(f"SELECT a.event_id, CASE WHEN n = 1 THEN isin END AS isin, CASE WHEN n = 1 THEN 'MATCHED_UNIQUE_ISIN' WHEN n > 1 THEN 'AMBIGUOUS_SYMBOL' ELSE 'UNMATCHED_SYMBOL' END AS match_status FROM (SELECT a.event_id, CASE WHEN count(*) FILTER (WHERE near) > 0 THEN count(*) FILTER (WHERE near) ELSE count(isin) END AS n, CASE WHEN count(*) FILTER (WHERE near) > 0 THEN min(isin) FILTER (WHERE near) ELSE min(isin) END AS isin FROM (SELECT a.event_id, s.isin, coalesce(s.first_d <= a.ex + 7 AND s.last_d >= a.ex - 30, false) AS near FROM {A} a LEFT JOIN {_SPANS} s ON s.symbol = 'S' || CAST(a.sec AS VARCHAR)) a GROUP BY 1) a")
def isin_resolution(spark, sf):
    e = t.actions(spark, sf).select("event_id", "ex", F.concat(F.lit("S"), F.col("sec")).alias("symbol"))
    return identity.resolve(e, identity.spans(named(spark, sf), "symbol", "isin")).select("event_id", "isin", "match_status")


_SETS = f"(SELECT ex AS effective_date, list_sort(list_distinct([('S' || CAST(sec AS VARCHAR)), ('S' || CAST(sec % 5 AS VARCHAR))])) AS exclusions, ['S' || CAST(sec % 9 AS VARCHAR)] AS inclusions, subject AS source_file, event_id FROM {A})"


def changes(spark, sf):
    s = lambda c: F.concat(F.lit("S"), c)
    return t.actions(spark, sf).select(F.col("ex").alias("effective_date"), F.array(s(F.col("sec")), s(F.col("sec") % 5)).alias("exclusions"), F.array(s(F.col("sec") % 9)).alias("inclusions"), F.col("subject").alias("source_file"), "event_id")


@query(f"SELECT effective_date, array_to_string(exclusions, ',') AS exclusions, array_to_string(inclusions, ',') AS inclusions, source_file FROM (SELECT *, row_number() OVER (PARTITION BY effective_date, exclusions, inclusions ORDER BY r, source_file) AS n FROM (SELECT *, CASE WHEN event_id % 20 = 0 THEN 0 ELSE 1 END AS r FROM {_SETS} WHERE event_id % 20 = 0 OR source_file <> 'Amalgamation')) WHERE n = 1")
def ledger_dedupe(spark, sf):
    c = changes(spark, sf)
    gone = spark.createDataFrame([("Amalgamation",)], "source_file string")
    merged = identity.merge_ledger(c.where("event_id % 20 = 0").drop("event_id"), c.where("event_id % 20 <> 0").drop("event_id"), gone)
    return merged.select("effective_date", F.array_join("exclusions", ",").alias("exclusions"), F.array_join("inclusions", ",").alias("inclusions"), "source_file")


@query()
def membership_timeline(spark, sf):
    import datetime

    c = changes(spark, sf).select("effective_date", "exclusions", "inclusions", "event_id")
    # Whoever has a bar has a line.
    members = t.table(spark, sf, "lineitem").select("l_suppkey").distinct().agg(F.collect_list(F.concat(F.lit("S"), F.col("l_suppkey"))).alias("members"))
    return identity.timeline(c, members, datetime.date(2002, 1, 1), ["event_id"])


@query(f"SELECT d, array_to_string(list_sort(list_filter(now, lambda x: NOT list_contains(before, x))), ',') AS joined, array_to_string(list_sort(list_filter(before, lambda x: NOT list_contains(now, x))), ',') AS gone FROM (SELECT d, now, lag(now) OVER (ORDER BY d) AS before FROM (SELECT CAST(date_trunc('year', d) AS DATE) AS d, list_sort(list(DISTINCT sec)) AS now FROM {SPARSE} GROUP BY 1)) WHERE before IS NOT NULL")
def membership_diff(spark, sf):
    per = t.bars(spark, sf, "l_partkey").groupBy(F.trunc("d", "year").alias("d")).agg(F.collect_set("sec").alias("now"))
    two = per.withColumn("before", F.lag("now").over(Window.orderBy("d"))).where("before is not null")
    join = lambda a: F.array_join(F.array_sort(a), ",")
    return two.select("d", join(F.array_except("now", "before")).alias("joined"), join(F.array_except("before", "now")).alias("gone"))


@query(f"SELECT sec, string_agg(DISTINCT subject, '; ' ORDER BY subject) AS subjects FROM {A} GROUP BY 1")
def string_agg_ordered(spark, sf):
    return t.actions(spark, sf).groupBy("sec").agg(F.array_join(F.array_sort(F.collect_set("subject")), "; ").alias("subjects"))


@query(f"SELECT sec, round(arg_max(close, d) FILTER (WHERE volume > 20), 9) AS last_busy_close, max(d) FILTER (WHERE volume > 20) AS last_busy FROM {B} GROUP BY 1")
def argmax_filter(spark, sf):
    busy = F.col("volume") > 20
    return t.bars(spark, sf).groupBy("sec").agg(F.round(F.max_by(F.when(busy, F.col("close")), F.when(busy, F.col("d"))), 9).alias("last_busy_close"), F.max(F.when(busy, F.col("d"))).alias("last_busy"))


# Incremental and streams.


@query(f"SELECT sec, d, volume FROM {B} WHERE d > DATE '{LIVE}' AND d <= DATE '{END}'")
def append_idempotent(spark, sf):
    b = t.bars(spark, sf).select("sec", "d", "volume")
    first = b.where(F.col("d").between(F.lit(LIVE).cast("date") + F.expr("interval 1 day"), F.lit("2000-06-30").cast("date")))
    second = b.where(F.col("d").between(F.lit("2000-06-01").cast("date"), F.lit(END).cast("date")))
    stored = inc.new_rows(first, None, ["sec", "d"])
    stored = stored.unionByName(inc.new_rows(second, stored, ["sec", "d"]))
    return stored.unionByName(inc.new_rows(second, stored, ["sec", "d"]))


@query("SELECT user_id, event_type, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_wins(spark, sf):
    e = t.table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return inc.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type"], "at").select("user_id", "event_type", "ts", "value")


@query("SELECT w_start, w_start + INTERVAL 1 DAY AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS w_start FROM events) GROUP BY 1, 2, 3")
def tumbling(spark, sf):
    return _naive(inc.tumbling(inc.timed(t.table(spark, sf, "events"))))


@query("SELECT w_start, w_start + INTERVAL 1 DAY AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT e.*, time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR * k AS w_start FROM events e, (SELECT unnest([0, 1, 2, 3]) AS k)) GROUP BY 1, 2, 3")
def sliding(spark, sf):
    return _naive(inc.sliding(inc.timed(t.table(spark, sf, "events"))))


@query("""SELECT user_id, min(ts) AS w_start, max(ts) + INTERVAL 30 MINUTE AS w_end, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)) GROUP BY user_id, s""")
def session_windows(spark, sf):
    return _naive(inc.sessions(inc.timed(t.table(spark, sf, "events"))))


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("w_start", "w_end")})


@query("SELECT event_type, count(*) FILTER (WHERE late) AS late, count(*) AS n FROM (SELECT *, coalesce(ts < max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 7 DAY, false) AS late FROM events) GROUP BY 1")
def late_drop(spark, sf):
    return inc.on_time(t.table(spark, sf, "events")).groupBy("event_type").agg(F.count_if("is_late").alias("late"), F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events JOIN customer ON c_custkey = user_id GROUP BY 1")
def stream_static_join(spark, sf):
    return t.table(spark, sf, "events").join(t.table(spark, sf, "customer"), F.col("c_custkey") == F.col("user_id")).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


# Readers over pages.


@query()
def page_links(spark, sf):
    return readers.page_links(t.table(spark, sf, "pages"))


@query()
def page_tables(spark, sf):
    return readers.page_tables(t.table(spark, sf, "pages"))


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_props(spark, sf):
    return t.table(spark, sf, "events").select(F.from_json("props", "k long")["k"].alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT a, least(a + 89, DATE '2001-12-31') AS b FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 90 DAY)) AS DATE) AS a)")
def fetch_chunks(spark, sf):
    start, end = calendar.chunks(F.lit("1995-01-01").cast("date"), F.lit("2001-12-31").cast("date"))
    return spark.range(1).select(start).select(F.col("start").alias("a"), F.least(F.lit("2001-12-31").cast("date"), F.date_add("start", 89)).alias("b"))


import tidemark.plans.checks  # noqa: E402, F401 (registers its queries here)
