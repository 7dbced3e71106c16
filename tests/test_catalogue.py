"""Every registered query against its SQL on a copy of the smallest tables."""

import os

import duckdb
import numpy as np
import pytest

from geokernel.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


def plain(frame):
    def value(v):
        if v is None or v != v:
            return None
        if isinstance(v, bool | np.bool_):
            return bool(v)
        if isinstance(v, int | np.integer):
            return int(v)
        if isinstance(v, float | np.floating):
            return repr(float(v))
        return str(v)

    columns = sorted(frame.columns)
    return columns, sorted((tuple(value(v) for v in row) for row in frame[columns].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert plain(QUERIES[name](spark, SF).toPandas()) == plain(duck.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
