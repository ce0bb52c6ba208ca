"""Every registered query against its SQL (or for rows) on the smallest tables."""

import pytest

from gridloom.registry import QUERIES, SQL
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SLOW = {"job_run_all"}  # the same stages run in the other job queries


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, name, QUERIES, SQL) is None


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 1
