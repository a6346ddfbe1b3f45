"""Every registered query against its SQL on the given tables."""

import importlib.util
import os

import oracle
import pytest
from conftest import SMALL

PATH = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
spec = importlib.util.spec_from_file_location("spark_entry", PATH)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

from plaintlens.plans.queries import QUERIES  # noqa: E402
from plaintlens.plans.sql import ORACLE_SQL  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", SMALL)


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_flagship(spark):
    assert entry.entry(spark).count() == 4
