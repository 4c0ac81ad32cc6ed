import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from lectern.plans import registry, review  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(frame):
    def value(v):
        return None if v is None or v is pd.NA or v is pd.NaT or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted((tuple(value(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.execute(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
