"""Every query with SQL against DuckDB over the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry_point.queries()[name](spark, SF)
    columns = sorted(df.columns)
    con.execute(entry_point.oracle_sql()[name])
    found = [c[0] for c in con.description]
    assert sorted(found) == columns
    want = sorted((tuple(str(plain(r[found.index(c)])) for c in columns) for r in con.fetchall()))
    got = sorted((tuple(str(plain(x)) for x in r) for r in df.select(*columns).collect()))
    assert got == want and got


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["als_grid_by_rmse", "als_recommend_all", "implicit_grid_by_auc", "implicit_recommend_named"])
def test_factor_models(spark, name):
    rows = entry_point.queries()[name](spark, SF).collect()
    assert rows
    if name == "als_grid_by_rmse":
        assert all(r.validation_rmse < 2.5 for r in rows)
    if name == "implicit_grid_by_auc":
        assert all(0.3 < r.mean_auc <= 1 for r in rows)
