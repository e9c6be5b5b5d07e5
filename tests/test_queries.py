"""Each query against its SQL, on the smallest data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import TABLES, compare  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from registry.oracle import ORACLE  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0
