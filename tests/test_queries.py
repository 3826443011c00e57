"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect
from twinledger.plans.catalog import query_catalog
from twinledger.plans.oracle import oracle_catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(query_catalog()) == set(oracle_catalog())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(query_catalog()))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == ""


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row.total_reported_executions > 0
