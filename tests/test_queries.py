"""Every registered query of the domain against its SQL in DuckDB."""

import glob
import math

import duckdb
import pandas as pd
import pytest

from quillmesh.plans import catalogue, exports, views  # noqa: F401

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.sql(f"create view {p.split('/')[-1][:-8]} as select * from '{p}'")
    return c


def normal(df: pd.DataFrame) -> list:
    def one(x):
        x = x.item() if hasattr(x, "item") else x
        if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return ""
        return f"{float(x):.9g}" if isinstance(x, int | float) and not isinstance(x, bool) else str(x)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert len(e.entry(spark).collect()) == 1
    assert set(e.oracle_sql()) <= set(e.queries())
