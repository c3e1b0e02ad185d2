"""Every registered query against its SQL, over the generated tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("EDDYLINE_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def canonical(rows: pd.DataFrame) -> list[str]:
    def cell(value):
        if pd.isna(value):
            return None
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        return str(value)

    columns = sorted(rows.columns)
    return sorted(
        str([cell(v) for v in row]) for row in rows[columns].itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    got = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.count() > 0
        return
    want = database.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.toPandas()) == canonical(want)


def test_entry(spark):
    assert contract.entry(spark).columns == ["item_id", "window_end", "cnt", "rk"]
