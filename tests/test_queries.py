import pytest

from tests.oracle import connection, differing
from tintwell.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, tmp_path, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLE_SQL:
        assert differing(con, df, catalog.ORACLE_SQL[name], tmp_path) == []
    else:
        assert df.count() > 0
