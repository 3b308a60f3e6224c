"""Settings that follow the input."""

import time

from packetmill.session import fit_partitions, stored


def test_partitions_grow_with_the_tables(spark, tmp_path):
    number, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    for folder, megabytes in (("small", 1), ("large", 40)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "lineitem.parquet").write_bytes(bytes(megabytes << 20))
    try:
        fit_partitions(spark, str(tmp_path / "large"))
        assert (spark.conf.get(number), spark.conf.get(size)) == ("20", "16m")
        fit_partitions(spark, str(tmp_path / "small"))
        assert spark.conf.get(number, None) is None
    finally:
        spark.conf.set(size, before)
        spark.conf.unset(number)


def test_a_stored_table_gives_its_shuffle_files_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, blocks = spark.conf.get(key), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {b.toString() for b in (lambda found: (found.apply(i) for i in range(found.size())))(blocks.getAllBlocks()) if "shuffle" in b.toString()}

    there = files()
    rows = stored(spark.range(1000).repartition(4, "id"), "dealt")
    for _ in range(50):  # they go in the background
        if not files() - there:
            break
        time.sleep(0.1)
    assert not files() - there and rows.count() == 1000
    assert spark.conf.get(key) == before
