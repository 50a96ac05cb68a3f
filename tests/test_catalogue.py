"""Every query of the catalogue with SQL gives DuckDB's rows on the smallest tables."""

import numbers
import os

import duckdb
import pandas as pd
import pytest

from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def text(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "NULL"
    return str(float(v)) if isinstance(v, numbers.Real) and not isinstance(v, bool) else str(v)


def table(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(text(v) for v in row) for row in frame[names].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, duck, name):
    assert table(catalogue.queries()[name](spark, SF).toPandas()) == table(duck.execute(catalogue.oracle_sql()[name]).df())


def test_pushdown(spark):
    plan = catalogue.queries()["prewhere"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "l_comment" not in plan
