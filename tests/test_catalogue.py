"""Every registered query against its SQL on a small table set."""

import math
import os

import pytest

import __spark_entry__
from shardlog.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if type(v).__name__ in ("bool", "bool_"):
        return bool(v)
    if type(v).__name__ == "Decimal" or isinstance(v, float) and v == int(v):
        return int(v)
    return v.item() if hasattr(v, "item") else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), duck.sql(catalogue.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda d: sorted(repr([norm(v) for v in r]) for r in d[cols].astype(object).itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries()) and set(catalogue.ORACLE) <= set(__spark_entry__.oracle_sql())
