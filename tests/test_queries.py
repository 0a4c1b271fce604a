import pytest

from stemma.plans import catalogue
from tests.oracle import SF, connection, duck_rows, spark_rows


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_equals_duckdb(spark, con, name):
    got, names = spark_rows(catalogue.QUERIES[name](spark, SF))
    if name not in catalogue.ORACLES:
        assert got
        return
    want, expected = duck_rows(con, catalogue.ORACLES[name])
    assert names == expected
    assert got == want
