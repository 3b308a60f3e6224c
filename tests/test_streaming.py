"""Incremental runs: restarts, new files, repeats."""

from pyspark.sql import functions as F

from packetmill.streaming import ingest, throughput

SCHEMA = "load_id string, path string"


def put(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_second_run_adds_only_new_files(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    put(spark, src, [("1", "a"), ("2", "b")])
    for _ in range(2):
        ingest.ingest_incremental(stream(spark, src), dst, checkpoint)
        assert spark.read.parquet(dst).count() == 2
    put(spark, src, [("3", "c")])
    ingest.ingest_incremental(stream(spark, src), dst, checkpoint)
    assert sorted(r.path for r in spark.read.parquet(dst).collect()) == ["a", "b", "c"]


def test_first_seen_holds_over_batches_and_repeats(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    put(spark, src, [("1", "b"), ("1", "a"), ("2", "c")])
    ingest.ingest_first_seen(stream(spark, src), dst, checkpoint)
    put(spark, src, [("1", "0"), ("3", "d")])
    put(spark, src, [("3", "e"), ("2", "f")])
    for _ in range(2):
        ingest.ingest_first_seen(stream(spark, src), dst, checkpoint)
        got = {r.load_id: r.path for r in ingest.first_seen(spark, dst).collect()}
        assert (got["1"], got["2"]) == ("a", "c") and got["3"] in ("d", "e") and len(got) == 3
        assert ingest.first_seen(spark, dst).count() == 3


def test_throughput_equals_the_batch_result_over_several_batches(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    schema = "ts timestamp_ntz, total_tokens bigint"
    base = spark.range(0, 300).select(
        (F.timestamp_seconds(F.col("id") * 7)).cast("timestamp_ntz").alias("ts"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("total_tokens")
    )
    for part in range(3):
        base.filter(F.col("total_tokens").isNull() if part == 2 else F.col("total_tokens") % 2 == part).coalesce(1).write.mode("append").parquet(str(src))
    throughput.run_throughput(stream(spark, src, schema), dst, str(tmp_path / "cp"), "1 minute", "1 day")
    want = throughput.throughput(base, "1 minute")
    assert sorted(map(tuple, throughput.latest_windows(spark, dst).collect())) == sorted(map(tuple, want.collect()))


def test_cost_of_a_batch_does_not_grow(spark, tmp_path):
    """Fifty batches: each looks up the loads that it brings, and reads nothing that others wrote."""
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    for i in range(50):
        put(spark, src, [(str(j), f"{i:02d}-{j}") for j in range(i * 10, i * 10 + 20)] + [("hot", f"{i:02d}-{k}") for k in range(30)])
    query = ingest.ingest_first_seen(stream(spark, src), dst, checkpoint)
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) == 50
    for p in progress:
        state = p["stateOperators"][0]
        assert p["numInputRows"] == 50 and state["numRowsUpdated"] <= 21
        assert state["customMetrics"]["rocksdbGetCount"] <= 21 * 4  # lookups: those of this batch
    seconds = [p["durationMs"]["addBatch"] for p in progress]
    assert sorted(seconds[-15:])[7] < 3 * sorted(seconds[5:20])[7]
    rows = ingest.first_seen(spark, dst).collect()
    assert len(rows) == len({r.load_id for r in rows}) == 511
    order = [int(r.path[:2]) for r in sorted((r for r in rows if r.load_id != "hot"), key=lambda r: int(r.load_id))]
    assert max(order) == 49
    # Files are taken in the order of their times, so a load's first batch is one of the two that bring it.
    assert all(int(r.load_id) // 10 - 1 <= int(r.path[:2]) <= int(r.load_id) // 10 for r in rows if r.load_id != "hot")


def test_loads_not_seen_for_long_are_forgotten(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    put(spark, src, [("1", "a"), ("2", None)])
    ingest.ingest_first_seen(stream(spark, src), dst, checkpoint, forget_ms=1)
    for i in range(2):  # what has timed out leaves with one batch and may come back with the next
        put(spark, src, [("3", f"x{i}")])
        ingest.ingest_first_seen(stream(spark, src), dst, checkpoint, forget_ms=1)
    put(spark, src, [("1", "b")])
    ingest.ingest_first_seen(stream(spark, src), dst, checkpoint, forget_ms=1)
    assert sorted(r.path for r in ingest.first_seen(spark, dst).filter("load_id = '1'").collect()) == ["a", "b"]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_late_rows_are_kept_and_folded_in(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    schema = "id bigint, ts timestamp, total_tokens bigint"
    base = spark.range(0, 300).select("id", F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("total_tokens"))
    base = base.unionByName(spark.createDataFrame([(900, None, 5)], schema))
    for part in (2, 0, 1):
        base.filter(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(str(src))
        for _ in range(2):  # a run over nothing new changes nothing
            throughput.run_throughput_keeping_late(stream(spark, src, schema), dst, checkpoint, "5 minutes")
    late = throughput.late_rows(spark, dst).count()
    assert 100 < late < 200
    on_time = throughput.windows_on_time(spark, dst)
    assert on_time.agg(F.sum("calls")).first()[0] == 300 - late
    want = sorted(map(tuple, throughput.throughput(base, "1 minute").collect()))
    for _ in range(2):
        assert sorted(map(tuple, throughput.fold_late(spark, dst).collect())) == want


def test_first_seen_runs_without_python_per_load(spark, tmp_path):
    """Nulls come first, loads without an id are one load, and no Python visits the loads one by one."""
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "cp")
    schema = "load_id string, path string, length int"
    put(spark, src, [("1", "b", 1), ("1", None, 2), ("1", None, None), (None, "z", 1), (None, "y", 1)], schema)
    ingest.ingest_first_seen(stream(spark, src, schema), dst, checkpoint)
    put(spark, src, [("1", "a", 0), (None, "a", 0), ("2", "c", 3), ("2", "c", 2)], schema)
    query = ingest.ingest_first_seen(stream(spark, src, schema), dst, checkpoint)
    got = {tuple(r) for r in ingest.first_seen(spark, dst).select("load_id", "path", "length").collect()}
    assert got == {("1", None, None), (None, "y", 1), ("2", "c", 2)}
    assert query.recentProgress[-1]["stateOperators"][0]["operatorName"] == "stateStoreSave"
