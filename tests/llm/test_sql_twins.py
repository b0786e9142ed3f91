import pytest

from drawloom.llm import registry
from tests.llm.oracle import same


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, name):
    d = "/root/testdata/sf0.01"
    assert same(registry.QUERIES[name](spark, d), registry.ORACLES[name], d) > 0
