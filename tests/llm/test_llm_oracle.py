"""The package's queries against DuckDB on the smallest supplied tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from voltlake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{file}'")
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert canonical(result.collect(), result.columns) == canonical(cursor.fetchall(), names)


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
