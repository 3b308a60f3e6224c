"""Versions of a table: whole or not at all, for readers and after a stopped job."""

import pytest
from pyspark.sql import functions as F

from packetmill.sources import published


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_job_stopped_in_mid_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert published.current_version(spark, path) is None and published.versions(spark, path) == []
    with pytest.raises(ValueError):
        published.read_published(spark, path)
    first = published.publish(spark.range(5), path)
    before = published.read_published(spark, path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        published.publish(broken, path)
    assert published.current_version(spark, path) == first and len(published.versions(spark, path)) == 2
    assert values(published.read_published(spark, path)) == list(range(5))
    second = published.publish(spark.range(7), path)
    assert values(published.read_published(spark, path)) == list(range(7))
    assert values(before) == list(range(5))  # a reader goes on with the version it began with
    assert values(published.read_published(spark, path, version=first)) == list(range(5)) and second > first


def test_pointing_back_and_expiring(spark, tmp_path):
    path = str(tmp_path / "t")
    names = [published.publish(spark.range(n), path) for n in range(1, 6)]
    published.point_to(spark, path, names[2])
    assert published.read_published(spark, path).count() == 3
    assert published.expire(spark, path, keep=2) == [names[0]]
    assert published.versions(spark, path) == names[1:]
    with pytest.raises(ValueError):
        published.point_to(spark, path, "version-none")
    assert published.expire(spark, path, keep=1) == [names[1]] and published.read_published(spark, path).count() == 3


def test_csv_and_a_table_that_reads_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(spark.createDataFrame([(1, "a,b")], "id int, v string"), path, "csv")
    back = published.read_published(spark, path, "csv", header="true", inferSchema="true")
    assert [tuple(r) for r in back.collect()] == [(1, "a,b")]
    published.publish(back.union(back), path, "csv")  # the version it reads is not the one it writes
    assert published.read_published(spark, path, "csv", header="true").count() == 2
