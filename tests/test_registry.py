"""Every registered query against its SQL, over the smallest tables."""

import pytest

from leasemill.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, compare):
    compare(QUERIES[name], SQL[name])


def test_entry(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and sum(r.market_share_pct for r in rows) == pytest.approx(100)
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
