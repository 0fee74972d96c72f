"""Every query with SQL gives the rows that DuckDB gives for it; the others run."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from tidemark.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def plain(row):
    return repr(tuple(None if isinstance(v, float) and math.isnan(v) else v + 0.0 if isinstance(v, float) else v for v in row))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf_dir, con, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name not in catalog.oracles():
        assert columns
        return
    r = con.execute(catalog.oracles()[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert sorted(map(plain, got)) == sorted(plain([row[k] for k in at]) for row in r.fetchall())


def test_no_cartesian_products(spark, sf_dir):
    for name, f in catalog.queries().items():
        plan = f(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    from tidemark.sources.readers import SourceError, load_daily

    path = f"file://{tmp_path}/bars"
    catalog.queries()["bars_ohlcv"](spark, sf_dir).write.parquet(path)
    df = load_daily(spark, path, "1996-01-01", "1996-12-31", ["sec", "close"], {"sec", "close", "volume"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,1996-01-01)" in plan and "ReadSchema: struct<sec:bigint,d:date,close:double>" in plan
    with pytest.raises(SourceError):
        load_daily(spark, path, "1996-01-01", "1996-12-31", ["open"], {"sec"})


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
