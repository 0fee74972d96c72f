"""The market views take every row of the driver's tables, on both sides."""

import duckdb

from tidemark.plans import catalog
from tidemark.plans import driver_tables as t


def rows(sf_dir, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def test_every_order_is_an_event(spark, sf_dir):
    suppliers = len(rows(sf_dir, "supplier", "s_suppkey"))
    want = sorted((k, c % suppliers, d, t.SUBJECTS[k // 10 % len(t.SUBJECTS)]) for k, c, d in rows(sf_dir, "orders", "o_orderkey, o_custkey, CAST(o_orderdate AS DATE)"))
    assert sorted(map(tuple, t.actions(spark, sf_dir).collect())) == want
    con = duckdb.connect()
    for name in ("orders", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert sorted(con.execute(f"SELECT event_id, sec, ex, subject FROM {t.actions_sql()}").fetchall()) == want
    assert catalog.queries()["ca_parse_v1"](spark, sf_dir).count() == len(want)
