"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from paperlake.workload import oracle
from paperlake.workload import queries as workload
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(workload.registered()) == set(oracle.oracle_sql())
    assert set(workload.registered()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(workload.registered()))
def test_query_equals_sql(spark, con, name):
    df = workload.registered()[name](spark, SF_DIR)
    assert differences(df, con, oracle.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
