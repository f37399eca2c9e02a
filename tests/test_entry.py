"""The registered queries of the engine give the rows of their SQL on the smallest tables."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events"


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].round(6) if df[c].dtype.kind == "f" else df[c]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).values.tolist()))


@pytest.fixture(scope="module")
def store():
    con = duckdb.connect()
    for t in NAMES.split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def names():
    from tidewater import catalog

    return sorted(catalog.QUERIES)


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, store, name):
    from tidewater import catalog

    assert rows(catalog.QUERIES[name](spark, SF).toPandas()) == rows(store.execute(catalog.ORACLES[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
