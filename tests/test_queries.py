import pytest
from comparing import duck, same

from tidewater import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_says_what_its_sql_says(spark, sf_dir, con, name):
    same(catalog.QUERIES[name](spark, sf_dir), con, catalog.ORACLE[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
