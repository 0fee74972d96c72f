"""Readers, gates, publishing, and incremental intake."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import readers, sinks
from tidemark.streaming import incremental as inc

UDIFF = "TradDt,TckrSymb,ISIN,SctySrs,OpnPric,HghPric,LwPric,ClsPric,TtlTradgVol,TtlTrfVal"
ROWS = [
    "2026-01-02,AAA,INE000A01011,EQ,10,12,9,11,100,1100", "2026-01-02,AAAOLD,INE000A01011,BE,10,12,9,11,500,5500", "2026-01-02,BBB,INE000B01011,BE,10,12,9,11,100,1100",
    "2026-01-02,BAD,INE000C01011,EQ,10,8,9,11,100,1100", "2026-01-02,SME,INE000D01011,SM,10,12,9,11,100,1100", "2026-01-02,GS,IN0020A01011,GS,10,12,9,11,100,1100", "2026-01-01,LATE,INE000E01011,EQ,10,12,9,11,100,1100",
    '2026-01-02,ZZZ,INE000Z01011,BZ,"1,000","1,200",900,"1,100",100,-',
]


def test_day_file(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "day.zip", "w") as z:
        z.writestr("day.csv", "﻿" + "\n".join([UDIFF, *ROWS]))
    lines = readers.zipped_csv_lines(spark, f"file://{tmp_path}/*.zip")
    rows = readers.canonical(readers.csv_of_lines(lines, UDIFF))
    day = {r["symbol"]: r for r in readers.day_rows(rows, "2026-01-02").collect()}
    assert set(day) == {"AAA", "BBB", "ZZZ"} and day["ZZZ"]["close"] == 1100.0 and day["ZZZ"]["turnover"] is None
    legacy = tmp_path / "old.csv"
    legacy.write_text("ISIN,SYMBOL,SERIES,CLOSE,OPEN,HIGH,LOW,TIMESTAMP,TOTTRDQTY,TOTTRDVAL\nINE000A01011,aaa,EQ,11,10,12,9,02-JAN-2020,5,55\n")
    one = readers.canonical(readers.csv_strings(spark, f"file://{legacy}")).first()
    assert (one["symbol"], one["close"], one["d"], one["volume"]) == ("AAA", 11.0, datetime.date(2020, 1, 2), 5)
    with pytest.raises(readers.SourceError):
        readers.canonical(spark.createDataFrame([("x",)], "SYMBOL string"))
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("a.csv", "")
        z.writestr("b.csv", "")
    with pytest.raises(readers.SourceError):
        readers.one_csv((tmp_path / "two.zip").read_bytes())


def test_delivery(spark):
    schema = "SYMBOL string, `SERIES` string, DATE1 string, NO_OF_TRADES string, DELIV_QTY string, DELIV_PER string, AVG_PRICE string"
    rows = [(f"S{k}", "EQ", "02-Jan-2026", "5", "-" if k else "7", "-" if k else "50.5", "10") for k in range(600)]
    df = spark.createDataFrame(rows, schema)
    got = readers.delivery(df, "2026-01-02")
    assert got.count() == 600 and got.where("delivered is null").count() == 599 and got.where("delivered = 0").count() == 0
    assert readers.delivery(df, "2026-01-03").count() == 0  # a holiday serves yesterday's file
    with pytest.raises(readers.SourceError):
        readers.delivery(df.limit(10), "2026-01-02")
    with pytest.raises(readers.SourceError):
        readers.delivery(df.drop("DELIV_QTY"), "2026-01-02")


def test_api_pages_and_maps(spark):
    texts = spark.createDataFrame([('[{"a": 1}]',), ('{"data": [{"a": 2}, {"a": 3}]}',), ('{"records": [{"a": 4}]}',), ("nonsense",), (None,)], "t string")
    assert sorted(r["a"] for r in readers.api_rows(spark, texts, "t", "a: int").collect()) == [1, 2, 3, 4]
    html = "<table><tr><th>S</th><td> a  b </td></tr><tr></tr></table><a href='x.pdf'>Press <b>one</b></a><a href='y.html'>no</a>"
    assert readers.html_tables(html) == [["S", "a b"]] and readers.html_links(html, r"\.pdf$") == [("x.pdf", "Press one")] and readers.html_links(None) == []
    hist, sym = readers.identity_map(spark, '{"isin2hist": {"I1": [{"symbol": "A", "from": "2020-01-01", "to": "2020-02-01"}]}, "sym2isin": {"A": "I1"}}')
    assert tuple(hist.first())[:2] == ("I1", "A") and tuple(sym.first()) == ("A", "I1")
    assert readers.decode(b"\xef\xbb\xbfa\x93") and readers.decode("é".encode("cp1252")) == "é"


def test_publishing(spark, tmp_path):
    folder = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a", datetime.date(2020, 1, 1)), (2, "", datetime.date(2021, 1, 1))], "k long, s string, d date")
    sinks.publish(df, folder, {"positive": F.col("k") > 0})
    with pytest.raises(sinks.Refused):
        sinks.publish(df.withColumn("k", -F.col("k")), folder, {"positive": F.col("k") > 0})
    assert sorted(r["k"] for r in sinks.current(spark, folder).collect()) == [1, 2]
    made = sinks.manifest(folder)
    assert sinks.verify(folder, made) == {"missing": [], "changed": [], "unexpected": []}
    (tmp_path / "store" / "stray").write_text("x")
    (tmp_path / "store" / "CURRENT").write_text("other")
    assert sinks.verify(folder, made) == {"missing": [], "changed": ["CURRENT"], "unexpected": ["stray"]}
    p, c = f"{tmp_path}/p", f"{tmp_path}/c"
    sinks.export_twins(df, p, c)
    assert spark.read.parquet(p).where("s is null").count() == 1
    part = next(x for x in (tmp_path / "c").iterdir() if x.name.endswith(".csv") and "1," in x.read_text())
    part.write_text(part.read_text().replace("1,", "7,"))
    (tmp_path / "c" / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(sinks.Refused):
        sinks.assert_twins(spark, p, c)
    assert [tuple(r)[:2] for r in sinks.export_years(df, f"{tmp_path}/y").orderBy("year").collect()] == [(2020, 1), (2021, 1)]
    assert sinks.write_once(df, f"{tmp_path}/once") and not sinks.write_once(df, f"{tmp_path}/once")
    a, b = (sinks.partition_fingerprints(x.withColumn("y", F.year("d")), "y").collect() for x in (df, df.unionAll(df)))
    assert sorted(a) != sorted(b) and sinks.changed_partitions({"a": "1", "b": "2"}, {"a": "1"}) == ["b"]


def test_appends_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(k % 7, k % 3) for k in range(40)], "a long, b long")
    src = f"{tmp_path}/src"
    df.repartition(4).write.parquet(src)
    for run in range(2):  # a new checkpoint reads everything again
        q = inc.append_stream(inc.stream_of(spark, src, df.schema), f"{tmp_path}/out", f"{tmp_path}/ck{run}", ["a", "b"]).start()
        q.awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out").count() == 21


def test_streamed_windows_equal_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src = f"{tmp_path}/src"
    events.repartition(3).write.parquet(src)
    q = inc.tumbling(inc.timed(inc.stream_of(spark, src, events.schema))).writeStream.outputMode("complete").format("memory").queryName("tumbled").trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, inc.tumbling(inc.timed(events)).collect()))
    q = inc.drop_repeats(inc.stream_of(spark, src, events.schema), ["user_id", "event_type"], "40 days").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert spark.table("once").count() == events.select("user_id", "event_type").distinct().count()


def test_guards():
    d = datetime.date(2026, 1, 10)
    inc.check_gap(d, d)
    for bad in (d - datetime.timedelta(1), d + datetime.timedelta(46)):
        with pytest.raises(ValueError):
            inc.check_gap(d, bad)


def test_retention_and_upsert(spark):
    df = spark.createDataFrame([(k, k % 5, k) for k in range(20)], "d long, key long, seen long")
    assert inc.retained(df, "d", 3).count() == 3
    assert sorted(r["seen"] for r in inc.upsert(df.where("d < 10"), df.where("d >= 10"), ["key"], "seen").collect()) == [15, 16, 17, 18, 19]
    assert inc.missing_dates(df.where("d <> 4"), df, "d").collect()[0]["d"] == 4
