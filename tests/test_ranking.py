"""Global positions: right, whole, and without a task that sees all rows."""

from pyspark.sql import functions as F

from packetmill.operators import manifest
from packetmill.operators.ranking import with_position


def test_positions_are_those_of_a_plain_sort(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    got = with_position(rows, F.col("k").desc()).collect()
    assert sorted(r.position for r in got) == list(range(1, 5001))
    assert all(r.position == 5000 - r.k for r in got)


def test_a_value_that_most_rows_share_spreads_over_ranges(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("k"))
        got = with_position(rows, F.col("k").asc())
        per_file = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(per_file) < 20_000
        ranked = [r.k for r in got.orderBy("position").collect()]
        assert ranked == sorted(ranked) and got.agg(F.countDistinct("position")).first()[0] == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_empty_tables_nulls_and_clashing_names(spark):
    assert with_position(spark.createDataFrame([], "a string, `b.c` int"), F.col("a")).columns == ["a", "b.c", "position"]
    rows = spark.createDataFrame([("b", 9), (None, 8), ("a", 7), ("a", 7)], "a string, Position int")
    got = with_position(rows, F.col("a").asc_nulls_last())
    assert sorted((r.position, r.a) for r in got.collect()) == [(1, "a"), (2, "a"), (3, "b"), (4, None)]


def test_worklist_positions_follow_the_ordered_list(spark):
    work = spark.createDataFrame([(str(i), f"p/{i}.pdf", i % 40) for i in range(200)], "load_id string, path string, sort_key int")
    for newest in (False, True):
        listed = [r.path for r in manifest.ordered_worklist(work, newest).collect()]
        placed = manifest.positioned_worklist(work, newest)
        assert [r.path for r in placed.orderBy("position").collect()] == listed
