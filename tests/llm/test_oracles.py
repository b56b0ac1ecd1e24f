import pytest

from orderstar.llm.oracles import ORACLES
from orderstar.llm.queries import QUERIES

from ..helpers import duck_content, spark_content


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, sf_dir, duck, name):
    assert spark_content(QUERIES[name](spark, sf_dir)) == duck_content(duck, ORACLES[name])
