"""The driver's tables as market data: each view as a DataFrame and as the DuckDB SQL of the same rows.

Securities are suppliers (deep history) or parts (sparse history); a bar is a day's trades of one; orders are a
corporate-action feed.  ISINs and symbols are spelled from the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Subjects of the made-up corporate actions, chosen by order key.
SUBJECTS = (
    "Bonus 1:1", "Face Value Split From Rs.10 To Rs.2", "Rights 1:4 @ Premium Rs 20/-", "Dividend Rs 2 Per Share", "Demerger",
    "Bonus 2:1/Dividend- Rs 1.60 Per Share", "Bonus 1:1 And Face Value Split From Rs.10 To Re.1", "Fv Splt Frm Rs 10 To Re 1",
    "Consolidation Of Equity Shares From Re 1 Per Share To Rs 10 Per Share", "Buy Back Of Shares", "Bonus Preference Shares 21:1",
    "Scheme Of Arrangement", "Annual General Meeting", "Fv Spl-Rs10tors5/Bon-2:1", "Amalgamation",
)

SUBJECT_SQL = "[" + ", ".join(f"'{s}'" for s in SUBJECTS) + "]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    """(sec, d, open, high, low, close, volume, turnover): a row a security and day."""
    t = table(spark, sf_dir, "lineitem").select(F.col(key).alias("sec"), F.col("l_shipdate").cast("date").alias("d"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"), F.col("l_quantity").alias("q"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice").alias("at"))
    per = t.groupBy("sec", "d").agg(F.min_by("p", "at").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "at").alias("close"), F.sum("q").cast("long").alias("volume"))
    return per.withColumn("turnover", F.col("close") * F.col("volume"))


def bars_sql(key: str = "l_suppkey") -> str:
    at = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice"
    down = ", ".join(f"{c} DESC" for c in at.split(", "))
    return f"""(SELECT *, close * volume AS turnover FROM (
      SELECT {key} AS sec, CAST(l_shipdate AS DATE) AS d, first(p ORDER BY {at}) AS open, max(p) AS high, min(p) AS low,
             first(p ORDER BY {down}) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
      FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2))"""


def isin(sec):
    return F.concat(F.lit("INE"), F.lpad(sec.cast("string"), 6, "0"), F.lit("01"), F.lpad((sec % 97).cast("string"), 2, "0"))


ISIN_SQL = "'INE' || lpad(CAST(sec AS VARCHAR), 6, '0') || '01' || lpad(CAST(sec % 97 AS VARCHAR), 2, '0')"


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, sec, ex, subject): every order as a corporate action of one of the suppliers."""
    n = table(spark, sf_dir, "supplier").agg(F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders").join(F.broadcast(n))
    return o.select(
        F.col("o_orderkey").alias("event_id"), (F.col("o_custkey") % F.col("n")).alias("sec"), F.col("o_orderdate").cast("date").alias("ex"),
        F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), ((F.col("o_orderkey") / 10).cast("long") % len(SUBJECTS) + 1).cast("int")).alias("subject"),
    )


def actions_sql() -> str:
    return f"""(SELECT o_orderkey AS event_id, o_custkey % (SELECT count(*) FROM supplier) AS sec, CAST(o_orderdate AS DATE) AS ex,
      {SUBJECT_SQL}[CAST((o_orderkey // 10) % {len(SUBJECTS)} + 1 AS INTEGER)] AS subject FROM orders)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, d, series): the trading series of a day, from return flags: BZ if any, else BE, else EQ."""
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("d"))
    return t.agg(F.when(F.count_if(F.col("l_returnflag") == "R") > 1, "BZ").when(F.count_if(F.col("l_returnflag") == "A") > 1, "BE").otherwise("EQ").alias("series"))


SERIES_SQL = """(SELECT l_suppkey AS sec, CAST(l_shipdate AS DATE) AS d, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 1 THEN 'BZ'
  WHEN count(*) FILTER (WHERE l_returnflag = 'A') > 1 THEN 'BE' ELSE 'EQ' END AS series FROM lineitem GROUP BY 1, 2)"""


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, d, delivered): the quantity of a day's final lines."""
    t = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
    return t.groupBy(F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("d")).agg(F.sum("l_quantity").cast("long").alias("delivered"))


DELIVERY_SQL = "(SELECT l_suppkey AS sec, CAST(l_shipdate AS DATE) AS d, CAST(sum(l_quantity) AS BIGINT) AS delivered FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)"
