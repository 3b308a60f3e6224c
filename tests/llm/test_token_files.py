"""Token files: what is written is what is read, frame by frame and document by document."""

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packetmill.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def written(docs):
    out = io.BytesIO()
    writer = token_files.FrameWriter(out)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, np.uint32))
    writer.close()
    return out.getvalue()


def reader(block):
    return token_files.FrameReader(pa.BufferReader(block))


def test_round_trip_over_frames():
    rng = np.random.default_rng(1)
    big = token_files.FRAME_IDS
    sizes = [1, 0, 5, big, big - 1, 1, 1, 3 * big, 7, 0, big // 2, big // 2, 1]
    docs = [(i if i else None, rng.integers(0, 70_000 if i % 2 else 60_000, n)) for i, n in enumerate(sizes)]
    back = list(reader(written(docs)).documents())
    assert [d for d, _ in back] == [d for d, _ in docs]
    assert all((a == b).all() for (_, a), (_, b) in zip(docs, back))
    assert list(reader(written([])).documents()) == []


def test_only_requested_frames_are_read(monkeypatch):
    docs = [(i, np.arange(20_000) + i) for i in range(10)]
    file = reader(written(docs))
    read = []
    monkeypatch.setattr(file, "frame", lambda i, f=file.frame: read.append(i) or f(i))
    (doc_id, ids), = file.documents({6})
    assert doc_id == 6 and ids[0] == 6 and read == [6]


def test_damage_is_found():
    block = bytearray(written([(1, np.arange(5000)), (2, np.arange(40_000))]))
    block[100] ^= 1
    with pytest.raises(Exception, match="damaged|zstd|decompress"):
        list(reader(bytes(block)).documents())
    with pytest.raises(ValueError):
        reader(bytes(block[:-1]))


def want_rows(rows):
    start, want = 0, []
    for doc_id, text in rows:
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return want


def test_query_against_the_library(spark, sf_dir):
    from packetmill.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op10_token_files"](spark, sf_dir).collect())
    assert got == want_rows(sorted((r["doc_id"], r["text"]) for r in docs))


def test_odd_rows(spark, tmp_path):
    rows = [(3, "c d", "x"), (1, None, "y"), (None, "no id", None), (2, "", "z"), (3, "c d", "x"), (None, "no", "x"), (9, "<|endoftext|> é ẹ́", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    manifest = token_files.write_tokens(docs, str(tmp_path / "t"), PATH, 2)
    got = sorted((r for r in token_files.read_tokens(manifest).collect()), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 3, 3, 9]
    want = {d: LIBRARY.encode(t or "", add_special_tokens=False).ids + [2] for d, t, _ in rows if d is not None}
    start = 0
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids)
        assert r["doc_id"] is None or ids == want[r["doc_id"]]
        start += len(ids)
    for m in manifest.collect():
        assert all(d is None or ids.tolist() == want[d] for d, ids in token_files.read_documents(f"{m['folder']}/{m['name']}", {1, 9}).items())
    assert token_files.write_and_read(docs.limit(0), PATH, 2).collect() == []


def test_every_file_is_read_by_a_task_of_its_own(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        docs = spark.createDataFrame([(i, f"word {i}") for i in range(800)], "doc_id long, text string")
        manifest = token_files.write_tokens(docs, str(tmp_path), PATH, 2)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        n = manifest.count()
        tasks = token_files.read_tokens(manifest).select(F.spark_partition_id().alias("p")).distinct().count()
        assert n == tasks == 16
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
