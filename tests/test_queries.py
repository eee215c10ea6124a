"""Every registered query runs and agrees with its SQL twin on the given tables."""

from __future__ import annotations

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, db, name):
    assert oracle.compare(spark, db, FOLDER, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    assert frame.columns and frame.collect()


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
