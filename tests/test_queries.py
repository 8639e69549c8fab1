import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL
import __spark_entry__ as contract


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, SMALL, name) is None


def test_entry(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == ["report", "position", "key1", "key2", "n"]
    assert flagship.count() == 54
