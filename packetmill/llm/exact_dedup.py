"""Exact deduplication: two passes with a Bloom filter, after which only repeated rows shuffle.

Pass 1 hashes every text and finds the filter cells that are hit at least twice. Each task writes
its cells as 16-bit offsets into blocks of the filter, so about four bytes per row travel, and a
block's cells meet in one small group of bounded size. Pass 2 tests every row: one of whose cells
was hit only once cannot have an equal, and passes straight through with its text. The others, all
true copies and a few percent of chance, are grouped by SHA-256 and joined back.

A filter round has at most ``max_bits`` bits (128 MB); larger inputs are cut by hash into several
rounds. Rounds run one after the other: each writes its verdicts and then gives its broadcast back,
so what is broadcast at any time has a fixed bound at any input size. The rows are then written
twice, by round and by verdict; a single round writes neither.

Defined cases: a null text counts as empty; among equal texts the smallest id stays, null ids last;
rows that repeat an id and its text are copies of each other, one of which stays; an empty table
gives an empty result; input columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetmill.llm.common import SPACE, pack, stored, unpack
from packetmill.operators.joins import join_summary
from packetmill.session import scratch_dir

BITS_PER_ROW = 8
PROBES = 2
MAX_BITS = 1 << 30
BLOCK_BITS = 1 << 15  # offsets within a block fit 16 bits


def _cells(h: np.ndarray, rounds: int, blocks: int) -> np.ndarray:
    """The filter cells of each hash: PROBES rows of cell numbers, all in the hash's own round."""
    h = h.astype(np.uint64)
    size = np.uint64(blocks * BLOCK_BITS)
    step = (h >> np.uint64(32)) | np.uint64(1)
    low = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    first = (h % np.uint64(rounds)) * size
    return np.stack([first + (low + np.uint64(i) * step) % size for i in range(PROBES)])


def _hit_cells(rounds: int, blocks: int):
    """Pass 1 of a task: its cells, and which of them it hit more than once, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            cells, hits = np.unique(_cells(h, rounds, blocks).ravel(), return_counts=True)
            block = (cells // np.uint64(BLOCK_BITS)).astype(np.int64)
            offset = (cells % np.uint64(BLOCK_BITS)).astype("<u2")
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.array([], int)
            ends = np.r_[starts[1:], len(block)] if len(block) else starts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[starts], pa.int64()),
                    pa.array([offset[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([offset[a:b][hits[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["block", "once", "twice"],
            )

    return run


def _merge_blocks(group: pa.Table) -> pa.Table:
    """The cells of one block that all tasks together hit at least twice, as a bitmap."""
    block = group.column("block")[0].as_py()
    once = np.frombuffer(b"".join(group.column("once").to_pylist()), "<u2")
    twice = np.frombuffer(b"".join(group.column("twice").to_pylist()), "<u2")
    hit = np.bincount(once, minlength=BLOCK_BITS) > 1
    hit[twice] = True
    bits = np.packbits(hit, bitorder="little").tobytes()
    return pa.table({"block": pa.array([block], pa.int64()), "bits": pa.array([bits], pa.binary())})


def repeated_hash_tests(hashed: DataFrame, n_rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS):
    """The number of rounds, and for a round a function that tells which values of the long column
    ``h`` may occur twice. Its ``give_back`` frees the round's broadcast once its rows are written.

    Never wrong about a value that does occur twice; wrong about a few percent of the others.
    """
    spark = hashed.sparkSession
    total = max(1, math.ceil(n_rows * bits_per_row / BLOCK_BITS))
    rounds = max(1, math.ceil(total * BLOCK_BITS / max_bits))
    blocks = max(1, math.ceil(total / rounds))
    hits = hashed.select("h").mapInArrow(_hit_cells(rounds, blocks), "block long, once binary, twice binary")
    merged = stored(hits.groupBy("block").applyInArrow(_merge_blocks, "block long, bits binary"), "bloom")

    def test(round_no: int):
        bits = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
        first = round_no * blocks
        # Bounded by max_bits: the cells of one round, not the hashes.
        for r in merged.filter(F.col("block").between(first, first + blocks - 1)).toLocalIterator():
            at = (r["block"] - first) * (BLOCK_BITS // 8)
            bits[at:at + BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
        shared = spark.sparkContext.broadcast(bits)

        @F.pandas_udf("boolean")
        def maybe(h):
            import pandas as pd

            cells = _cells(h.to_numpy(), rounds, blocks) - np.uint64(first * BLOCK_BITS)
            filled = shared.value
            hit = (filled[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1
            return pd.Series(hit.all(axis=0))

        maybe.give_back = shared.destroy
        return maybe

    return rounds, test


def add_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``row`` (the input's columns), and ``text_sha256`` of the normalised text."""
    return pack(docs, id_col, text_col).select(
        "id", "row", F.sha2(F.regexp_replace("text", SPACE, " "), 256).alias("text_sha256"))


def _tested_in_rounds(hashed: DataFrame, rounds: int, test) -> DataFrame:
    """The rows with ``maybe``; one round's filter is broadcast at a time."""
    spark = hashed.sparkSession
    # One copy by round, so that every round reads its own rows only.
    by_round = F.when(F.col("h") < 0, F.pmod(F.col("h"), F.lit(rounds)) + F.lit(2**64 % rounds))
    by_round = F.pmod(F.coalesce(by_round, F.pmod(F.col("h"), F.lit(rounds))), F.lit(rounds))
    dealt = stored(hashed.withColumn("round", by_round.cast("int")), "rounds", "round")
    path = scratch_dir(spark, "verdicts")
    for i in range(rounds):
        maybe = test(i)
        told = dealt.filter(F.col("round") == i).drop("round").withColumn("maybe", maybe("h"))
        told.write.partitionBy("maybe").parquet(f"{path}/round={i}")
        maybe.give_back()
    schema = T.StructType([*hashed.schema.fields, T.StructField("maybe", T.BooleanType())])
    folders = [f"{path}/round={i}" for i in range(rounds)]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def mark_repeats(prints: DataFrame, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``keep_id``, ``group_size`` and ``kept`` to rows with ``id`` and ``text_sha256``."""
    hashed = prints.withColumn("h", F.xxhash64("text_sha256"))
    rounds, test = repeated_hash_tests(hashed, prints.count(), bits_per_row, max_bits)
    tested = hashed.withColumn("maybe", test(0)("h")) if rounds == 1 else _tested_in_rounds(hashed, rounds, test)
    singles, several = (tested.filter(verdict).drop("h", "maybe") for verdict in ("not maybe", "maybe"))
    several = stored(several.withColumn("row_no", F.monotonically_increasing_id()), "repeated")
    groups = several.groupBy("text_sha256").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_no")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"))
    joined = join_summary(several, groups, ["text_sha256"], "inner")
    rest = [c for c in prints.columns]
    return singles.select(
        *rest, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    ).unionByName(joined.select(
        *rest, F.col("keep.id").alias("keep_id"), "group_size", (F.col("keep.row_no") == F.col("row_no")).alias("kept")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    marked = mark_repeats(add_fingerprint(docs, id_col, text_col))
    return unpack(marked, F.col("keep_id"), F.col("group_size"), F.col("kept"), F.col("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without the rows whose text another row, with a smaller id, has as well."""
    return unpack(mark_repeats(add_fingerprint(docs, id_col, text_col)).filter("kept"))
