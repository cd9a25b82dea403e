"""Every registered query against its SQL, on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import ENTRIES
from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    found = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert found == rows_of(names, result.fetchall())


def test_flagship_has_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["year", "level1", "cnt"] and frame.count() > 0


def test_workers_need_not_import_the_package():
    """A session started elsewhere runs a query with Python workers."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; "
        "from pyspark.sql import SparkSession; "
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
        "print('rows', e.entry(spark).count())"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=300
    )
    assert "rows " in done.stdout, done.stderr[-2000:]
