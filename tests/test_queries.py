"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(found.columns) == sorted(columns)
    rows = found.collect()
    assert rows
    assert _sorted_rows(found.columns, rows) == _sorted_rows(columns, expected.fetchall())


def test_every_query_has_sql():
    own = {name[2:] for name in vars(contract) if name.startswith("q_")}
    assert own <= set(contract.queries()) and own <= set(contract.oracle_sql())


def test_entry(spark):
    assert len(contract.entry(spark).collect()) == 1
