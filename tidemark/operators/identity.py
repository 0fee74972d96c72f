"""Identities over time: lineage, transitions, memberships, ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import same_issuer

# Days between two ISINs of one lineage.
LINEAGE_GAP = 20


def spans(bars: DataFrame, symbol: str, isin: str) -> DataFrame:
    """(symbol, isin, first_d, last_d, sessions) of each pair."""
    return bars.groupBy(F.col(symbol).alias("symbol"), F.col(isin).alias("isin")).agg(F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count("*").alias("sessions"))


def lineage(spans_: DataFrame, existing: DataFrame | None = None, gap: int = LINEAGE_GAP) -> DataFrame:
    """(isin, canonical): a symbol's next ISIN joins the chain before it if it is the same issuer's and follows within days.

    The first ISIN of a chain names it; existing decisions win; of several symbols the first decides, of several chains of
    one the earliest.
    """
    w = Window.partitionBy("symbol").orderBy("first_d", "isin")
    days = F.datediff("first_d", F.lag("last_d").over(w))
    joins = same_issuer(F.lag("isin").over(w), F.col("isin")) & (days > 0) & (days <= gap)
    t = spans_.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    t = t.withColumn("chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("canonical", F.first("isin").over(Window.partitionBy("symbol", "chain").orderBy("first_d", "isin")))
    out = t.groupBy("isin").agg(F.min_by("canonical", F.struct("symbol", "first_d", "canonical")).alias("canonical"))
    if existing is None:
        return out
    known = existing.select(F.col("isin").alias("_i"), F.col("canonical").alias("_c"))
    direct = out.join(known, F.col("isin") == F.col("_i"), "left").select("isin", F.coalesce("_c", "canonical").alias("canonical"))
    return direct.join(known, F.col("canonical") == F.col("_i"), "left").select("isin", F.coalesce("_c", "canonical").alias("canonical"))


def transitions(spans_: DataFrame) -> DataFrame:
    """(isin, old_symbol, new_symbol, on): neighbouring symbols of an ISIN's history."""
    w = Window.partitionBy("isin").orderBy("first_d", "symbol")
    t = spans_.withColumn("new_symbol", F.lead("symbol").over(w)).withColumn("on", F.lead("first_d").over(w))
    return t.where("new_symbol is not null and new_symbol <> symbol").select("isin", F.col("symbol").alias("old_symbol"), "new_symbol", "on")


def unique_names(rows: DataFrame, name: str, symbol: str) -> DataFrame:
    """(name, symbol, n_symbols, is_unique): a symbol only where the name has no other."""
    per = rows.where(F.col(name) != "").groupBy(F.col(name).alias("name")).agg(F.countDistinct(symbol).alias("n_symbols"), F.min(symbol).alias("symbol"))
    return per.select("name", F.when(F.col("n_symbols") == 1, F.col("symbol")).alias("symbol"), "n_symbols", (F.col("n_symbols") == 1).alias("is_unique"))


def security_master(bars: DataFrame, symbol: str, isin: str) -> DataFrame:
    """(isin, symbol, symbols, first_d, last_d, sessions): the latest symbol and all symbols in order, as JSON."""
    per = bars.groupBy(F.col(isin).alias("isin")).agg(
        F.max_by(symbol, F.struct("d", symbol)).alias("symbol"), F.to_json(F.array_sort(F.collect_set(symbol))).alias("symbols"), F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count("*").alias("sessions"))
    return per


def resolve(events: DataFrame, history: DataFrame, before: int = 30, after: int = 7) -> DataFrame:
    """Events with isin and match_status: the spans of the symbol near the ex-date, or all of them where none is near.

    history: (symbol, isin, first_d, last_d).
    """
    h = history.select(F.col("symbol").alias("_s"), F.col("isin").alias("_i"), "first_d", "last_d")
    j = events.join(h, F.col("symbol") == F.col("_s"), "left")
    near = (F.col("first_d") <= F.date_add("ex", after)) & (F.col("last_d") >= F.date_sub("ex", before))
    per = j.withColumn("_near", F.coalesce(near, F.lit(False))).groupBy(*events.columns).agg(F.count_if("_near").alias("n_near"), F.count("_i").alias("n_all"), F.min(F.when(F.col("_near"), F.col("_i"))).alias("i_near"), F.min("_i").alias("i_all"))
    n = F.when(F.col("n_near") > 0, F.col("n_near")).otherwise(F.col("n_all"))
    one = F.when(F.col("n_near") > 0, F.col("i_near")).otherwise(F.col("i_all"))
    return per.select(*events.columns, F.when(n == 1, one).alias("isin"), F.when(n == 1, "MATCHED_UNIQUE_ISIN").when(n > 1, "AMBIGUOUS_SYMBOL").otherwise("UNMATCHED_SYMBOL").alias("match_status"))


def latest_wins(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    """The last row of each key by *order*."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_ledger(curated: DataFrame, parsed: DataFrame, superseded: DataFrame | None = None) -> DataFrame:
    """Membership changes (effective_date, exclusions, inclusions arrays, source_file): curated beat parsed, superseded sources go, equal changes count once."""
    p = parsed if superseded is None else parsed.join(superseded.select("source_file").distinct(), "source_file", "left_anti")
    both = curated.withColumn("_rank", F.lit(0)).unionByName(p.withColumn("_rank", F.lit(1)))
    both = both.withColumns({"exclusions": F.array_sort(F.array_distinct("exclusions")), "inclusions": F.array_sort(F.array_distinct("inclusions"))})
    return latest_wins(both, ["effective_date", "exclusions", "inclusions"], F.col("_rank").asc(), F.col("source_file").asc()).drop("_rank")


def timeline(changes: DataFrame, anchor: DataFrame, as_of, order: list[str] | None = None) -> DataFrame:
    """(symbol, valid_from, valid_to): half-open membership intervals from set changes and the members at the end.

    changes: (effective_date, exclusions, inclusions, and *order*, by which changes of a date follow each other; without it
    by their symbols); anchor: one row (members) as of *as_of*.  The set is walked back to the start through the changes and
    forward again; changes that don't fit (removing a non-member, adding a member) change nothing.

    A symbol's walk depends on no other symbol: before its first change it is a member if that takes it out, and without
    changes if it is one at the end.  So each symbol is one window over its own changes, exclusions of a change first.
    """
    tie = F.struct(*(order or ["exclusions", "inclusions"])).alias("tie")
    c = changes.where("effective_date is not null").select("effective_date", tie, "exclusions", "inclusions")
    out_, in_, end_ = 0, 1, 2
    told = lambda symbols, kind: c.select(F.explode(symbols).alias("symbol"), F.col("effective_date").alias("d"), "tie", F.lit(kind).alias("kind"))
    last = anchor.select("members").limit(1).select(F.explode(F.array_distinct("members")).alias("symbol"))
    both = told("exclusions", out_).unionByName(told("inclusions", in_)).unionByName(last.withColumn("kind", F.lit(end_)), allowMissingColumns=True)
    # A member at the end comes before its changes, of which the first that tells something new is kept of each run.
    w = Window.partitionBy("symbol").orderBy("d", "tie", "kind")
    t = both.where("symbol is not null").withColumn("before", F.lag("kind").over(w)).where("before is null or kind <> before")
    t = t.withColumns({"next": F.lead("kind").over(w), "until": F.lead("d").over(w)})
    first = F.coalesce(F.col("before") == end_, F.lit(True))
    never = (F.col("kind") == end_) & F.col("next").isNull()
    t = t.where((F.col("kind") == in_) | ((F.col("kind") == out_) & first) | never)
    end = F.date_add(F.lit(as_of), 1)
    since, to = F.when(F.col("kind") == in_, F.col("d")), F.when(F.col("kind") == out_, F.col("d")).otherwise(F.coalesce("until", end))
    return t.select("symbol", since.alias("valid_from"), to.alias("valid_to"))
