"""The registered queries of the subpackage on the given tables."""

import oracle
import pytest
from conftest import SMALL

from plaintlens.llm.queries import QUERIES
from plaintlens.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = oracle.duck(SMALL)
    assert oracle.difference(QUERIES[name](spark, SMALL), con, ORACLE_SQL[name]) is None
