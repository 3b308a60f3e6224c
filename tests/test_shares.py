"""Queries that work share by share of the loads."""

import pytest

from compare import compare
from packetmill import session
from packetmill.plans import fixtures, silver
from packetmill.plans.catalog import ORACLES, QUERIES


@pytest.fixture
def two_shares(monkeypatch):
    monkeypatch.setattr(session, "SHARE_BYTES", 1)
    monkeypatch.setattr(session, "MOST_SHARES", 2)
    monkeypatch.setattr(silver, "_bronze", {})


@pytest.mark.parametrize("name", ["h7_itinerary_ends", "h1_flatten_documents", "d5_load_overview", "b7_export_ml"])
def test_shares_make_the_whole(spark, sf_dir, con, two_shares, name):
    assert session.shares(spark, sf_dir, "lineitem", "orders") == 2
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_a_share_reads_its_own_rows_before_the_joins(spark, sf_dir, two_shares, tmp_path):
    plans = []

    def make(given):
        rows = given["freight_documents"].select("load_id", "doc_seq", "commodity", "pickup_date")
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows

    got = fixtures.write_by_loads(spark, sf_dir, str(tmp_path / "rows"), make)
    assert got.count() == fixtures.table(spark, sf_dir, "lineitem").count()
    for plan in plans:
        lines = plan.splitlines()
        below = [lines[i - 1] + lines[i - 2] for i, x in enumerate(lines) if "Relation" in x and ("l_orderkey" in x or "o_orderkey" in x)]
        assert len(below) == 2 and all("xxhash64" in x for x in below), plan


def test_what_a_share_stored_is_deleted(spark, tmp_path):
    with session.discarding(spark):
        rows = session.stored(spark.range(3), "passing")
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert session.stored(rows, "next").count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
