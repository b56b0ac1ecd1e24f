"""Every query against its SQL counterpart."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from orderstar.plans.catalog import QUERIES

from .helpers import duck_content, spark_content


def test_every_query_of_the_warehouse_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    frame = queries()[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(column[0] for column in result.description)
    got = spark_content(frame)
    assert got == duck_content(duck, oracle_sql()[name])
    assert got, "an empty result compares nothing"


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
