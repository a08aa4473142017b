"""Every registered query against its SQL on the smallest tables; without SQL it must run and give rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries  # noqa: E402
from turnwarden.queries import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    ok, note = check_queries.compare(spark, db, FOLDER, name)
    assert ok, note


def test_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
