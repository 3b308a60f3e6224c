"""Folders as a table: every file, empty ones too, in parallel and as a stream."""

import os
import time

from pyspark.sql import functions as F

from packetmill.operators import manifest
from packetmill.sources import listing
from packetmill.streaming import ingest


def fill(root, loads=30):
    for i in range(loads):
        folder = root / str(i)
        (folder / "deep").mkdir(parents=True)
        (folder / "a.pdf").write_bytes(b"%PDF" * i)
        (folder / "deep" / "b.PDF").write_bytes(b"")
        (folder / "c.txt").write_bytes(b"x")
    (root / "loose.pdf").write_bytes(b"12345")


def test_every_file_once_with_its_length(spark, tmp_path):
    fill(tmp_path)
    for uri in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/"):
        got = {r.path: r.length for r in listing.list_files(spark, uri, folders=4).collect()}
        base = uri.rstrip("/")
        want = {f"{base}/loose.pdf": 5}
        for i in range(30):
            want |= {f"{base}/{i}/a.pdf": 4 * i, f"{base}/{i}/deep/b.PDF": 0, f"{base}/{i}/c.txt": 1}
        assert got == want


def test_folders_are_dealt_to_tasks(spark, tmp_path):
    fill(tmp_path)
    files = listing.list_files(spark, str(tmp_path), folders=4)
    per_task = [r["count"] for r in files.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 9 and max(per_task) == 12


def test_scan_and_triage_see_empty_files(spark, tmp_path):
    fill(tmp_path, 3)
    files = manifest.scan_manifest(listing.list_files(spark, str(tmp_path)), f"{tmp_path}/")
    assert sorted((r.load_id, r.length) for r in files.select("load_id", "length").collect()) == [
        ("0", 0), ("0", 0), ("1", 0), ("1", 4), ("2", 0), ("2", 8), ("loose.pdf", 5)]
    told = files.withColumns({"openable": F.lit(True), "needs_pass": F.lit(False), "page_count": F.lit(1)})
    assert manifest.with_triage(told).filter("reason = 'empty file (0 bytes)'").count() == 4


def test_missing_and_empty_folders(spark, tmp_path):
    assert listing.list_files(spark, str(tmp_path)).count() == 0
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0


def test_a_stream_takes_each_file_once(spark, tmp_path):
    root, dst, checkpoint = tmp_path / "raw", str(tmp_path / "dst"), str(tmp_path / "cp")
    fill(root, 4)
    for _ in range(2):
        ingest.ingest_incremental(listing.stream_files(spark, str(root), settle=0), dst, checkpoint)
        assert spark.read.parquet(dst).count() == 13
    time.sleep(0.05)
    (root / "9").mkdir()
    (root / "9" / "late.pdf").write_bytes(b"")
    ingest.ingest_incremental(listing.stream_files(spark, str(root), settle=0), dst, checkpoint)
    paths = [r.path for r in spark.read.parquet(dst).collect()]
    assert len(paths) == len(set(paths)) == 14 and f"{root}/9/late.pdf" in paths


def test_a_file_still_being_written_waits(spark, tmp_path):
    root, dst, checkpoint = tmp_path / "raw", str(tmp_path / "dst"), str(tmp_path / "cp")
    fill(root, 1)
    old = time.time() - 3600
    for name in ("a.pdf", "c.txt"):
        os.utime(root / "0" / name, (old, old))
    ingest.ingest_incremental(listing.stream_files(spark, str(root), settle=600), dst, checkpoint)
    assert sorted(r.path.rsplit("/", 1)[1] for r in spark.read.parquet(dst).collect()) == ["a.pdf", "c.txt"]
