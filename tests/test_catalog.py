"""Each registered query with SQL gives the rows of its SQL over the smallest tables."""

import datetime
import math
import os

import duckdb
import pandas as pd
import pytest
from foliospark.plans import catalog

DATA = os.environ.get("FOLIO_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "customer documents embeddings events lineitem nation orders pages part region supplier benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return str(v) if isinstance(v, datetime.datetime) else v


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.astype(object).itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_rows_equal_those_of_the_sql(spark, sql, name):
    got, want = catalog.queries()[name](spark, DATA).toPandas(), sql.sql(catalog.oracles()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracles())))
def test_others_run(spark, name):
    df = catalog.queries()[name](spark, DATA)
    assert df.columns and df.count() > 0
