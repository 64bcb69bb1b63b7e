"""Every query of the core against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from glossaria.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(df):
    def cell(v):
        if v is None or v != v:
            return "~"
        if hasattr(v, "tolist"):
            v = v.tolist()
        return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
        return
    assert canonical(got) == canonical(duck.execute(sql).df())


def test_names_are_unique_and_oracles_have_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())
