"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as contract
from driftline.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_the_library_has_sql():
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    assert oracle.compare(REGISTRY[name].run(spark, FOLDER), con, REGISTRY[name].sql) == []
