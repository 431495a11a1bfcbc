import oracle
import pytest

from taxaloom.plans import audit_queries as driver_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(driver_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = driver_queries.QUERIES[name](spark, sf_dir)
    if name in driver_queries.ORACLE_SQL:
        assert oracle.compare(df, con, driver_queries.ORACLE_SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
