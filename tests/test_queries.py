"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as entry_points
from sparkpact.plans.queries import QUERIES as CONTRACT_QUERIES

QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir_module):
    return oracle_connection(sf_dir_module)


@pytest.fixture(scope="module")
def sf_dir_module():
    from conftest import SF_DIR

    return SF_DIR


def test_every_contract_query_has_its_sql():
    assert set(CONTRACT_QUERIES) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 11


@pytest.mark.parametrize("name", sorted(CONTRACT_QUERIES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), oracle, ORACLE[name]) is None
