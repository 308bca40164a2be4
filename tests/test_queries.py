"""Every registered query equals its SQL on the smallest tables."""

import sys
import os

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

from oracle import compare, connect  # noqa: E402
from snapgate.suite import catalog  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, con, name):
    equal, message = compare(con, catalog.queries()[name](spark, SF_DIR), catalog.oracle_sql()[name])
    assert equal, message


def test_entry(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(e.queries())
