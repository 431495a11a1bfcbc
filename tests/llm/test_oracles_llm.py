import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

import oracle
from taxaloom.llm import registry


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.compare(registry.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), registry.ORACLE_SQL[name]) == ""
