"""Every registered query against its SQL, on the smallest tables (``ORACLE_SF_DIR`` to change)."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tillroll.plans.oracles import ORACLES
from tillroll.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = normal(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    expected = normal([c[0] for c in result.description], result.fetchall())
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert found[1]


def test_every_query_has_an_oracle_and_is_registered():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


def test_entry(spark):
    report = driver.entry(spark)
    assert report.columns == ["year", "month", "n_lines", "units", "revenue"]
    assert report.count() > 0
