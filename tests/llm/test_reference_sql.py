import pytest

from riskflow.llm.oracles import ORACLES
from riskflow.llm.queries import QUERIES
from tests.compare import difference


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_reference(spark, name):
    assert difference(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLES[name]) is None
