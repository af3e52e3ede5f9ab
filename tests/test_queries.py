"""Every registered query against its SQL."""

import __spark_entry__
import pytest
from compare import difference

from hostpulse.plans.queries import QUERIES

SQL = __spark_entry__.oracle_sql()


def test_every_query_is_registered_and_has_sql():
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert QUERIES.keys() <= SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), SQL[name], small) is None


def test_entry_gives_rows(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns[:2] == ["eventhub_timestamp", "topic"]
    assert rows.count() > 0
