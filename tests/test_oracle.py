"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import compare, connect

from tablelearn.plans import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], ORACLE.get(name)) is None
