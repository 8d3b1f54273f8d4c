"""Every registered query against its oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

from checks.compare import differences, oracle_connection
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), oracle, ORACLE[name]) == []
