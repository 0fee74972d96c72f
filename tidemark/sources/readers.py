"""Readers of source files: exchange day files, delivery files, API answers, HTML pages; with the gates that refuse bad ones."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import date, first_alias, number
from tidemark.plans.runtime import map_arrow

# The column names of the exchange's two day-file formats, and of its delivery file.
ALIASES = {
    "d": ("TradDt", "TIMESTAMP", "DATE1"), "symbol": ("TckrSymb", "SYMBOL"), "isin": ("ISIN",), "series": ("SctySrs", "SERIES"), "open": ("OpnPric", "OPEN", "OPEN_PRICE"),
    "high": ("HghPric", "HIGH", "HIGH_PRICE"), "low": ("LwPric", "LOW", "LOW_PRICE"), "close": ("ClsPric", "CLOSE", "CLOSE_PRICE"), "volume": ("TtlTradgVol", "TOTTRDQTY", "TTL_TRD_QNTY"), "turnover": ("TtlTrfVal", "TOTTRDVAL"),
}
SERIES_ORDER = ("EQ", "BE", "BZ")
DELIVERY = {"d": ("DATE1",), "symbol": ("SYMBOL",), "series": ("SERIES",), "trades": ("NO_OF_TRADES",), "delivered": ("DELIV_QTY",), "delivered_pct": ("DELIV_PER",), "avg_price": ("AVG_PRICE",)}


class SourceError(ValueError):
    """A source file that may not be used, and why."""


def decode(data: bytes) -> str:
    """UTF-8 with or without a mark, else Windows Latin-1, else Latin-1."""
    for name in ("utf-8-sig", "cp1252"):
        try:
            return data.decode(name)
        except UnicodeDecodeError:
            continue
    return data.decode("latin-1")


def one_csv(data: bytes) -> bytes:
    """The CSV member of an archive that has exactly one."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(".csv")]
        if len(names) != 1:
            raise SourceError(f"{len(names)} CSV files in the archive; one is asked for")
        return z.read(names[0])


def zipped_csv_lines(spark: SparkSession, glob: str) -> DataFrame:
    """(path, line_no, line) of archives of one CSV each, an archive a row of work."""

    def lines(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = decode(one_csv(data)).splitlines()
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], ["path", "line_no", "line"])

    return map_arrow(spark.read.format("binaryFile").load(glob).select("path", "content"), lines, "path string, line_no long, line string")


def csv_of_lines(lines: DataFrame, header: str) -> DataFrame:
    """All-string columns of CSV lines under a header line; names are trimmed."""
    names = [h.strip() for h in header.split(",")]
    schema = ", ".join(f"`{n}` string" for n in names)
    return lines.where(F.col("line_no") > 0).select("path", F.from_csv("line", schema, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("r")).select("path", "r.*")


def csv_strings(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV files with all columns as strings, joined by name, each row with its file."""
    out = None
    for p in paths:
        one = spark.read.csv(p, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).withColumn("source_file", F.col("_metadata.file_name"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def canonical(raw: DataFrame) -> DataFrame:
    """Typed rows of either day-file format, whatever the order of its columns."""
    get = lambda k: first_alias(raw.columns, *ALIASES[k])
    missing = [k for k in ("d", "symbol", "close") if not {a.upper() for a in ALIASES[k]} & {c.strip().upper() for c in raw.columns}]
    if missing:
        raise SourceError(f"no column for {', '.join(missing)}")
    prices = {k: number(get(k)) for k in ("open", "high", "low", "close", "turnover")}
    return raw.select(date(get("d")).alias("d"), F.upper(get("symbol")).alias("symbol"), F.upper(get("isin")).alias("isin"), F.upper(get("series")).alias("series"), *[v.alias(k) for k, v in prices.items()], number(get("volume")).cast("long").alias("volume"))


def day_rows(rows: DataFrame, day: str | None = None) -> DataFrame:
    """Rows of one day in tradable series with valid prices; of each ISIN, then symbol, one: EQ before BE before BZ, the larger volume."""
    ok = F.col("series").isin(*SERIES_ORDER) & (F.least("open", "high", "low", "close") > 0) & (F.col("high") >= F.greatest("open", "low", "close")) & (F.col("low") <= F.least("open", "close")) & (F.col("volume") >= 0)
    kept = rows.where(ok & (F.col("isin").rlike("^IN[A-Z0-9]{10}$")))
    kept = kept if day is None else kept.where(F.col("d") == F.lit(day).cast("date"))
    from pyspark.sql import Window

    rank = F.array_position(F.array(*[F.lit(s) for s in SERIES_ORDER]), F.col("series"))
    for key in ("isin", "symbol"):
        w = Window.partitionBy("d", key).orderBy(rank, F.col("volume").desc(), "symbol", "isin")
        kept = kept.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return kept


def delivery(raw: DataFrame, day: str, minimum: int = 500) -> DataFrame:
    """(d, symbol, series, trades, delivered, delivered_pct, avg_price): dashes are null, never 0; another day's file is a holiday, with no rows; short files are refused."""
    get = lambda k: first_alias(raw.columns, *DELIVERY[k])
    for k, names in DELIVERY.items():
        if not {n.upper() for n in names} & {c.strip().upper() for c in raw.columns}:
            raise SourceError(f"no column for {k}")
    rows = raw.select(date(get("d")).alias("d"), F.upper(get("symbol")).alias("symbol"), F.upper(get("series")).alias("series"), number(get("trades")).cast("long").alias("trades"), number(get("delivered")).cast("long").alias("delivered"), number(get("delivered_pct")).alias("delivered_pct"), number(get("avg_price")).alias("avg_price"))
    n, own = rows.agg(F.count("*"), F.count_if(F.col("d") == F.lit(day).cast("date"))).first()
    if n < minimum:
        raise SourceError(f"{n} rows; {minimum} are asked for")
    return rows.where(F.col("d") == F.lit(day).cast("date")) if own else rows.where("false")


def api_rows(spark: SparkSession, texts: DataFrame, column: str, schema: str) -> DataFrame:
    """The records of API answers: a list, or an object with the list under data or records."""
    as_list = F.from_json(column, f"array<struct<{schema}>>")
    wrapped = F.from_json(column, f"struct<data: array<struct<{schema}>>, records: array<struct<{schema}>>>")
    is_list = F.ltrim(column).startswith("[")
    return texts.select(F.explode(F.when(is_list, as_list).otherwise(F.coalesce(wrapped["data"], wrapped["records"]))).alias("r")).select("r.*")


def identity_map(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """(isin, symbol, first_d, last_d) and (symbol, isin) of a JSON identity map."""
    one = spark.range(1).select(F.from_json(F.lit(text), "struct<isin2hist: map<string, array<struct<symbol: string, from: string, to: string>>>, sym2isin: map<string, string>>").alias("m"))
    hist = one.select(F.explode("m.isin2hist").alias("isin", "h")).select("isin", F.explode("h").alias("h")).select("isin", "h.symbol", F.to_date("h.from").alias("first_d"), F.to_date("h.to").alias("last_d"))
    return hist, one.select(F.explode("m.sym2isin").alias("symbol", "isin"))


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.links: list[tuple[str, str]] = []
        self.cell: list[str] | None = None
        self.link: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []
        elif tag == "a":
            self.link = [dict(attrs).get("href") or "", ""]

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)
        if self.link is not None:
            self.link[1] += data

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "a" and self.link is not None:
            self.links.append((self.link[0], " ".join(self.link[1].split())))
            self.link = None


def html_tables(html: str | None) -> list[list[str]]:
    """The cells of all table rows of a page."""
    p = _Tables()
    p.feed(html or "")
    return [r for r in p.rows if r]


def html_links(html: str | None, pattern: str = "") -> list[tuple[str, str]]:
    """(address, text) of the links of a page whose address fits."""
    p = _Tables()
    p.feed(html or "")
    return [x for x in p.links if re.search(pattern, x[0])]


def page_links(pages: DataFrame, pattern: str = "") -> DataFrame:
    """(page_id, position, href, label) of the links of pages."""

    def links(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(i, k, *x) for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k, x in enumerate(html_links(h, pattern))]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["page_id", "position", "href", "label"])

    return map_arrow(pages.select("page_id", "html"), links, "page_id long, position long, href string, label string")


def page_tables(pages: DataFrame) -> DataFrame:
    """(page_id, row_no, cells) of the table rows of pages."""

    def tables(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(i, k, r) for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k, r in enumerate(html_tables(h))]
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.string())))], ["page_id", "row_no", "cells"])

    return map_arrow(pages.select("page_id", "html"), tables, "page_id long, row_no long, cells array<string>")


def load_daily(spark: SparkSession, path: str, start: str, end: str, columns: list[str], allowed: set[str]) -> DataFrame:
    """Rows of a date range with columns of an allow-list: both reach the scan."""
    wrong = [c for c in columns if c not in allowed or not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c)]
    if wrong:
        raise SourceError(f"columns that may not be asked for: {', '.join(wrong)}")
    return spark.read.parquet(path).select("d", *[c for c in columns if c != "d"]).where(F.col("d").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SourceError(f"missing columns: {', '.join(missing)}")
    return df


def with_default_series(df: DataFrame) -> DataFrame:
    """A table without series is all EQ."""
    return df if "series" in df.columns else df.withColumn("series", F.lit("EQ"))
