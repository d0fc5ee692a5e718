"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import oracle
from strata.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_counterpart():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    oracle.compare(spark, con, name, FOLDER, entry.queries(), entry.oracle_sql())
