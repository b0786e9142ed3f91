import pytest

from drawloom import catalog
from tests.oracle import same

D = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, name):
    same(catalog.QUERIES[name](spark, D), catalog.ORACLES[name], D)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs_without_twin(spark, name):
    assert catalog.QUERIES[name](spark, D).count() > 0
