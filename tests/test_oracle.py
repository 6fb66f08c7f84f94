import os

import pytest

from checks.compare import connect, differences
from checks.oracle import all_sql
from checks.queries import all_queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_twin_has_a_query():
    assert set(all_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) == []
