"""Every registered query against its DuckDB statement."""

import pytest

from compare import compare
from packetmill.plans.catalog import ORACLES, QUERIES


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["load_id", "doc_seq"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
