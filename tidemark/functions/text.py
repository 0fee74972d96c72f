"""Numbers, dates and names out of text."""

from __future__ import annotations

import difflib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats of exchange files, words at the end of company names.
DATE_FORMATS = ("dd-MMM-yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy")
NAME_ENDINGS = r"\b(LIMITED|LTD|COMPANY|CO|CORPORATION|CORP)\b"


def number(text: Column) -> Column:
    """A number with thousands commas; a dash or blank is null, never 0."""
    bare = F.replace(F.trim(text), F.lit(","), F.lit(""))
    return F.when(~bare.isin("", "-"), bare.try_cast("double"))


def date(text: Column) -> Column:
    """The first of the known formats that reads it."""
    return F.coalesce(*[F.try_to_date(F.trim(text), f) for f in DATE_FORMATS])


def first_alias(columns: list[str], *aliases: str) -> Column:
    """The first of the aliases, whatever its case, that a table has and whose value isn't blank or a dash."""
    by = {c.strip().upper(): c for c in columns}
    found = [F.nullif(F.nullif(F.trim(F.col(f"`{by[a.upper()]}`")), F.lit("-")), F.lit("")) for a in aliases if a.upper() in by]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def company_name(name: Column) -> Column:
    """Upper case, & as AND, no punctuation or legal form, single spaces."""
    t = F.regexp_replace(F.upper(name), "&", " AND ")
    t = F.regexp_replace(F.regexp_replace(t, "[^A-Z0-9 ]", " "), NAME_ENDINGS, " ")
    return F.trim(F.regexp_replace(t, " +", " "))


def name_aliases(name: Column) -> Column:
    """The normalised name, without a leading THE, and without spaces."""
    n = company_name(name)
    bare = F.regexp_replace(n, "^THE ", "")
    return F.array_distinct(F.array(n, bare, F.replace(bare, F.lit(" "), F.lit(""))))


def same_issuer(a: Column, b: Column) -> Column:
    """Two Indian ISINs of one issuer's equity: equal in their first nine characters."""
    ok = lambda c: (F.length(c) == 12) & c.startswith("IN")
    return ok(a) & ok(b) & (F.substring(a, 1, 9) == F.substring(b, 1, 9))


def ratio(a: str | None, b: str | None) -> float | None:
    """Ratcliff-Obershelp likeness of two strings, 0 to 1."""
    return None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio()


def register(spark) -> None:
    """Make ``name_ratio`` known to SQL."""
    spark.udf.register("name_ratio", ratio, "double")
