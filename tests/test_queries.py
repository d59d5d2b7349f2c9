"""Every registered query against its SQL, and the driver entry points."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# fitted several times over; their parts are tested on small inputs in test_models
SLOW = {"g08_cross_validation", "i13_alerts_from_detections"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not available")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:2] == ["pod", "window_start"] and not result.isEmpty()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
