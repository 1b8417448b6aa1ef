import pytest

from quire.plans.registry import ORACLES, QUERIES
from tests.oracle import same

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, name):
    rows = same(QUERIES[name](spark, SF), ORACLES[name], SF)
    assert rows > 0
