"""Importance resampling of documents towards a target distribution of n-grams.

1. *Overlapped scan.* A text's separators are collapsed to single spaces; then one expression per
   length, with boundaries on both sides, is run over the bytes with overlapping matches, and every
   match is the span of an n-gram. A span's CRC-32 modulo ``buckets`` is the feature's bucket.
   Texts are scanned once: a document's buckets and counts are stored as two short binary columns.
2. *Gains.* Bucket counts of the documents and of the target are added up by task, then by bucket;
   the gain of a bucket is the logarithm of the ratio of both smoothed shares. Only ``buckets``
   numbers reach the driver and are broadcast, whatever the input.
3. *Draw.* A document's weight is the sum of the gains of its features; Gumbel noise that depends on
   the seed and the id only is added, and the highest scores are drawn without replacement. Their
   ranks are counted in sorted ranges.

All gains and scores are whole thousandths, so that sums do not depend on any order.

Defined cases: a null text has no words; a document without features weighs 0; an id that is null is
hashed as the empty text and ranked after others of equal score; rows that repeat an id have equal
noise and are drawn each for itself; an empty target leaves all gains to the corpus counts; an
empty table gives an empty result; input columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from packetmill.llm.common import pack, stored, unpack
from packetmill.operators.ranking import with_position

BUCKETS = 10_000
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPAN = methodcaller("span")
PIECE_ROWS = 500  # documents whose features leave a task together


def span_pattern(n: int) -> regex.Pattern:
    """Runs of exactly n words in a text whose words are parted by single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def feature_hashes(text: str | None, patterns: list[regex.Pattern]) -> list[np.ndarray]:
    """The CRC-32 of every n-gram of a text, one array per pattern."""
    data = SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ")
    return [
        np.fromiter((crc32(data[a:b]) for a, b in map(SPAN, p.finditer(data, overlapped=True))), np.uint32)
        for p in patterns]


def _feature_rows(max_words: int, buckets: int, names: list[str]):
    """The input's columns but the text, then ``n_words, n_features, places, counts``."""
    place_type = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(n + 1) for n in range(max_words)]
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                part = batch.slice(at, PIECE_ROWS)
                words, features, places, counts = [], [], [], []
                for text in part.column(0):
                    hashes = feature_hashes(text.as_py(), patterns)
                    place, count = np.unique(np.concatenate(hashes) % np.uint32(buckets), return_counts=True)
                    words.append(len(hashes[0]))
                    features.append(int(count.sum()))
                    places.append(place.astype(place_type).tobytes())
                    counts.append(count.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                     pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names)

    return run, place_type


def features(texts: DataFrame, max_words: int, buckets: int) -> tuple[DataFrame, str]:
    """Rows of ``text`` and any others, as ``n_words, n_features, places, counts`` and the others."""
    others = [f for f in texts.schema.fields if f.name != "text"]
    added = ["n_words long", "n_features long", "places binary", "counts binary"]
    run, place_type = _feature_rows(max_words, buckets, [f.name for f in others] + [a.split()[0] for a in added])
    schema = StructType(others + list(StructType.fromDDL(", ".join(added))))
    return texts.select("text", *[f"`{f.name}`" for f in others]).mapInArrow(run, schema), place_type


def bucket_counts(rows: DataFrame, place_type: str, buckets: int) -> DataFrame:
    """``bucket, n`` over all rows; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for place, count in zip(batch.column(0), batch.column(1)):
                at = np.frombuffer(place.as_py(), place_type)  # distinct within a document
                total[at] += np.frombuffer(count.as_py(), "<u4")
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], ["bucket", "n"])

    parts = rows.select("places", "counts").mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, in whole thousandths."""
    s, t = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    every = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    rows = np.array(both.select("bucket", "s", "t").collect(), np.int64).reshape(-1, 3)  # one row per bucket
    rows = rows[np.argsort(rows[:, 0])]
    all_s, all_t = float(int(rows[:, 1].sum()) + buckets), float(int(rows[:, 2].sum()) + buckets)
    return np.array([
        math.floor(1000.0 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in rows[:, 1:].tolist()], np.int64)


def weigh(rows: DataFrame, gain: np.ndarray, place_type: str) -> DataFrame:
    """Rows of features with their ``weight`` instead of places and counts."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    @F.pandas_udf("long")
    def weight(places, counts):
        import pandas as pd

        gain = shared.value
        return pd.Series([
            int(gain[np.frombuffer(p, place_type)] @ np.frombuffer(c, "<u4").astype(np.int64))
            for p, c in zip(places, counts)], dtype="int64")

    return rows.withColumn("weight", weight("places", "counts")).drop("places", "counts")


def noise(seed: str):
    """Gumbel noise in whole thousandths, a function of the seed and the column ``id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, max_words: int = 1, least_words: int = 20,
             buckets: int = BUCKETS, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) are drawn and ranked
    from 1; the rank of all others is null. Without ``keep_text`` the text goes.
    """
    packed = pack(docs, id_col, text_col)
    if not keep_text:
        packed = packed.withColumn("row", F.col("row").dropFields(f"`{text_col}`"))
    rows, place_type = features(packed, max_words, buckets)
    rows = stored(rows, "features")
    wanted, _ = features(target.select(F.col(f"`{target_col}`").alias("text")), max_words, buckets)
    gain = gains(bucket_counts(rows, place_type, buckets), bucket_counts(wanted, place_type, buckets), buckets)
    weighed = weigh(rows, gain, place_type).withColumn("score", F.col("weight") + noise(seed))
    able = weighed.filter(F.col("n_words") >= least_words)
    drawn = percent * rows.filter(F.col("n_words") >= least_words).count() // 100
    placed = with_position(able, F.desc("score"), F.col("id").asc_nulls_last(), name="place")
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    added = ["n_features", "weight", "score"]
    short = weighed.filter(F.col("n_words") < least_words).withColumn("place", F.lit(None).cast("long"))
    return unpack(placed.unionByName(short), *[F.col(c) for c in added], rank)
