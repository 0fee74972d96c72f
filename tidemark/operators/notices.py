"""Index-change notices as membership events: sections, marked lists, effective dates, and names as symbols."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import company_name
from tidemark.plans.runtime import map_arrow

# The words by which notices name the index family, mark their lists and speak of effect; how near a date must follow, and when names are alike.
FAMILY, OWN = ("CNX", "NIFTY"), "500"
EXCLUDED = ("EXCLUDED", "EXCLUDING", "DELETED", "DELETION", "DELETING", "REMOVED", "REMOVAL", "REMOVING")
INCLUDED = ("INCLUDED", "INCLUDING", "ADDED", "ADDITION", "ADDING", "REPLACED", "REPLACEMENT")
EFFECT = ("EFFECTIVE", "W.E.F.")
BROKEN_EFFECT = {"EFF ECTIV E": "EFFECTIVE", "EFF ECTIVE": "EFFECTIVE", "EFFECTIV E": "EFFECTIVE", "W . E . F .": "W.E.F.", "W. E. F.": "W.E.F.", "W .E .F .": "W.E.F."}
ORDINALS = ("ST", "ND", "RD", "TH")
NAME_WORDS, DATE_CHARS = 6, 20
REACH, ALIKE, MARGIN = 220, 0.965, 0.015


def _clean(line):
    return F.trim(F.regexp_replace(F.translate(line, "\u00a0Â", "  "), r"\s+", " "))


def _words(text):
    return F.filter(F.split(text, " "), lambda w: w != "")


def _is_in(word, values):
    return word.isin(*values)


def heading(line):
    """The words behind the index family's name if a line is no more than the name of an index, else null.

    Before the family may stand a label of the section and the name of the index's licensor; a colon may close the line.
    """
    text = F.rtrim(F.upper(line), F.lit(" :"))
    for name in FAMILY:  # the family's name may touch a number
        text = F.replace(text, F.lit(name), F.lit(name + " "))
    words = _words(F.replace(F.replace(text, F.lit("S & P"), F.lit("S&P")), F.lit("S &P"), F.lit("S&P")))
    at = F.get(F.filter(F.transform(words, lambda w, k: F.when(_is_in(w, FAMILY), k)), lambda k: k.isNotNull()), F.lit(0))
    label = F.filter(F.slice(words, F.lit(1), at), lambda w: w != "S&P")
    behind = F.slice(words, at + 2, F.size(words))
    plain = lambda w: F.translate(w, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789&-", "") == ""
    labelled = (F.size(label) == 0) | ((F.size(label) == 1) & plain(F.translate(F.get(label, F.lit(0)), "().", "")))
    return F.when(at.isNotNull() & labelled & F.forall(behind, plain) & (F.size(F.filter(behind, lambda w: w != "INDEX")) <= NAME_WORDS), behind)


def sections(notices: DataFrame) -> DataFrame:
    """(source_file, section, line_no, line, mode): the lines of own sections under their exclusion or inclusion mark.

    A section runs from a heading of the index itself to the next heading of any other index: running counts of
    both kinds of headings number the lines, so a notice is read in one pass over its lines.
    """
    lines = notices.select("source_file", F.posexplode(F.split("text", r"\r\n|\n|\r")).alias("line_no", "raw")).withColumn("line", _clean(F.col("raw")))
    w = Window.partitionBy("source_file").orderBy("line_no")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("index", heading(F.col("line")))
    own = F.coalesce((F.get("index", F.lit(0)) == OWN) & (F.size(F.filter("index", lambda w: w != "INDEX")) == 1), F.lit(False))
    other = F.col("index").isNotNull() & ~own
    t = lines.withColumn("own", own).withColumn("section", F.count_if("own").over(run)).withColumn("closed", F.max(F.when(other, F.col("line_no"))).over(run)).withColumn("opened", F.max(F.when(F.col("own"), F.col("line_no"))).over(run))
    t = t.where(F.col("opened").isNotNull() & (F.col("closed").isNull() | (F.col("closed") < F.col("opened"))))
    said = F.split(F.upper("line"), "[^A-Z]+")
    has = lambda values: F.arrays_overlap(said, F.array(*[F.lit(v) for v in values]))
    mark = F.when(has(EXCLUDED), "exclude").when(has(INCLUDED), "include")
    inside = Window.partitionBy("source_file", "section").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("mark", mark).withColumn("mode", F.last("mark", ignorenulls=True).over(inside)).where("mode is not null").select("source_file", "section", "line_no", "line", "mode", F.col("mark").isNotNull().alias("is_mark"))


def effective_date(text):
    """The date that follows the last mark of effect, of those that a date follows closely; a bare press date doesn't count."""
    flat = F.upper(F.regexp_replace(text, r"\s+", " "))
    for broken, word in BROKEN_EFFECT.items():
        flat = F.replace(flat, F.lit(broken), F.lit(word))
    for word in EFFECT:
        flat = F.replace(flat, F.lit(word), F.lit("\0"))
    behind = F.slice(F.split(flat, "\0"), F.lit(2), F.greatest(F.lit(0), F.size(F.split(flat, "\0")) - 1))
    days = F.transform(behind, lambda part: F.get(F.filter(_dates(F.substring(part, 1, REACH + DATE_CHARS)), lambda d: d.isNotNull()), F.lit(0)))
    return F.try_element_at(F.filter(days, lambda d: d.isNotNull()), F.lit(-1))


def _dates(text):
    """For each word of a text the date that it and the two after it write, month or day first, or null."""
    number = lambda w: F.when(_is_in(F.right(w, F.lit(2)), ORDINALS) & F.substring(w, 1, 1).between("0", "9"), F.left(w, F.length(w) - 2)).otherwise(w)
    words = F.transform(_words(F.translate(text, ",.;)", "    ")), number)
    three = F.transform(words, lambda w, k: F.initcap(F.concat_ws(" ", F.slice(words, k + 1, F.lit(3)))))
    return F.transform(three, lambda t: F.coalesce(F.try_to_date(t, "MMMM d yyyy"), F.try_to_date(t, "d MMMM yyyy")))


def parse(notices: DataFrame, symbols: DataFrame) -> DataFrame:
    """(source_file, section, effective_date, exclusions, inclusions, confidence) of notices (source_file, text) by known *symbols*.

    A line names the symbol that is its last word; sections without a date or with an empty list give no event.
    """
    s = sections(notices)
    word = F.upper(F.regexp_replace(F.element_at(F.split("line", " "), -1), r"^[()\[\],:;]+|[()\[\],:;]+$", ""))
    known = s.where("not is_mark").withColumn("symbol", word).join(F.broadcast(symbols.select(F.upper("symbol").alias("symbol")).distinct()), "symbol")
    first = known.groupBy("source_file", "section", "mode", "symbol").agg(F.min("line_no").alias("at"))
    per = first.groupBy("source_file", "section").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("mode") == m, F.struct("at", "symbol")))), lambda x: x["symbol"]).alias(n) for m, n in (("exclude", "exclusions"), ("include", "inclusions"))])
    ends = s.groupBy("source_file", "section").agg(F.max("line_no").alias("end"))
    context = ends.join(notices, "source_file").select("source_file", "section", effective_date(F.array_join(F.slice(F.split("text", r"\r\n|\n|\r"), F.lit(1), F.col("end") + 1), "\n")).alias("effective_date"))
    both = per.join(context, ["source_file", "section"]).where("effective_date is not null and size(exclusions) > 0 and size(inclusions) > 0")
    return both.withColumn("confidence", F.when(F.size("exclusions") == F.size("inclusions"), "PARSED_BALANCED").otherwise("PARSED_UNBALANCED_REVIEW"))


def _bare(name):
    return F.regexp_replace(F.replace(name, F.lit(" "), F.lit("")), "(?:PVT)?LTD$", "")


def resolve_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (name) with symbol and method: by normalised name, else without spaces and legal form where that is unique, else by likeness.

    names: (name, symbol), one index's listed companies, which the fuzzy step sends to the tasks.  A fuzzy match must
    be alike enough and clearly better than the next.
    """
    table = names.select(company_name(F.col("name")).alias("_n"), F.col("symbol").alias("_s")).groupBy("_n").agg(F.min("_s").alias("_s"))
    short = table.groupBy(_bare(F.col("_n")).alias("_b")).agg(F.min("_s").alias("_s2"), F.countDistinct("_s").alias("_k")).where("_k = 1").drop("_k")
    t = rows.withColumn("_name", company_name(F.col("name"))).join(F.broadcast(table), F.col("_name") == F.col("_n"), "left").drop("_n")
    t = t.withColumn("_bare", _bare(F.col("_name"))).join(F.broadcast(short), F.col("_bare") == F.col("_b"), "left").drop("_b")
    left = t.where("_s is null and _s2 is null").select("name", "_bare").distinct()
    all_names = [(r["_b"], r["_s"]) for r in table.select(_bare(F.col("_n")).alias("_b"), "_s").collect()]  # one index's names: thousands at most

    def fuzzy(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for name, bare in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                scored = sorted((difflib.SequenceMatcher(None, bare or "", b).ratio(), s) for b, s in all_names)
                best, second = (scored[-1] if scored else (0.0, None)), (scored[-2][0] if len(scored) > 1 else 0.0)
                out.append((name, best[1] if best[0] >= ALIKE and best[0] - second >= MARGIN else None))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], ["_fn", "_s3"])

    alike = map_arrow(left, fuzzy, "_fn string, _s3 string")
    t = t.join(alike, F.col("name").eqNullSafe(F.col("_fn")), "left")
    method = F.when(F.col("_s").isNotNull(), "NAME_EXACT").when(F.col("_s2").isNotNull(), "NAME_SUFFIX").when(F.col("_s3").isNotNull(), "NAME_ALIKE").otherwise("REVIEW")
    return t.select(*rows.columns, F.coalesce("_s", "_s2", "_s3").alias("symbol"), method.alias("method"))


def accepted_snapshots(snapshots: DataFrame, sizes: tuple[int, ...] = (500, 501, 502)) -> DataFrame:
    """(date, members, accepted) of official member lists (date, symbol): only lists of a known size count."""
    per = snapshots.groupBy("date").agg(F.array_sort(F.collect_set("symbol")).alias("members"))
    return per.withColumn("accepted", F.size("members").isin(*sizes))


def anchors(*lists: DataFrame) -> DataFrame:
    """(date, members) from several sources, the earlier ones winning a date."""
    rows = None
    for k, one in enumerate(lists):
        r = one.select("date", "members", F.lit(k).alias("_k"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.groupBy("date").agg(F.min_by("members", "_k").alias("members"))


def equivalent(a, b, aliases):
    """Whether two symbol arrays are the same companies under a map of aliases."""
    named = lambda x: F.array_distinct(F.transform(x, lambda s: F.coalesce(F.element_at(aliases, s), s)))
    return (F.size(F.array_except(named(a), named(b))) == 0) & (F.size(F.array_except(named(b), named(a))) == 0)
