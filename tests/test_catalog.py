"""Every query of the catalog against its oracle."""

import pytest

from tests.oracle import oracle, spark_rows
from traffic_signals import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, data, name):
    assert spark_rows(catalog.QUERIES[name](spark, data)) == oracle(catalog.ORACLES[name], data)


def test_all_queries_have_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["bucket", "family", "visits"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
