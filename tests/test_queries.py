"""Every query with SQL, against DuckDB on the same tables; the others run and give rows."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(entry.QUERIES)


def rows(frame):
    def cell(v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return None
        return float(v) if pd.api.types.is_number(v) and not pd.api.types.is_bool(v) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(cell, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
