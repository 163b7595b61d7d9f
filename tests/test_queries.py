"""Every registered query against its SQL in DuckDB."""

import datetime
import decimal
import math
import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracles import ORACLES
from checks.queries import QUERIES, TABLES
from typeferry import clear_scratch
from typeferry.operators.scratch import SCRATCH_DATABASE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    names = sorted(frame.columns)
    found = Counter(tuple(plain(r[c]) for c in names) for r in frame.collect())

    result = duck.execute(contract.oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(at) == names
    expected = Counter(tuple(plain(r[at[c]]) for c in names) for r in result.fetchall())
    assert sum(expected.values()) > 0
    assert found == expected, list((found - expected).items())[:3] + ["expected"] + list(
        (expected - found).items()
    )[:3]


def test_entry(spark):
    assert contract.entry(spark).count() == 1500


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"ReadSchema: struct<([^>]*)>?", plan) or re.findall(
        r"FileScan parquet \[([^\]]*)\]", plan
    )


def test_counts_read_what_they_need(spark):
    """Row counts read no column; loss counts read the columns that can lose values."""
    found = scans(QUERIES["discover_count"](spark, SF_DIR))
    assert len(found) >= len(TABLES) and not any(found)
    assert not any(scans(QUERIES["map_catalog"](spark, SF_DIR)))


def test_scratch_is_cleared(spark):
    QUERIES["merge_orders"](spark, SF_DIR).count()
    left = f"SHOW TABLES IN {SCRATCH_DATABASE} LIKE 'merge_orders*'"
    assert spark.sql(left).count() > 0
    assert clear_scratch(spark) > 0
    assert spark.sql(left).count() == 0
    assert clear_scratch(spark) == 0
