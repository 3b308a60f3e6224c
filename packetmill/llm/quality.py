"""Quality scores: ridge regression on random Fourier features, isotonically calibrated.

Every whole text is described by a dozen statistics (word lengths, repetition of words, word pairs
and lines, symbols, capitals, ...). ``FEATURES`` random cosines of the standardised statistics
approximate a Gaussian kernel. Each task sums the normal equations of its labelled rows, the sums
are added row by row of the matrix, and only the finished matrix, whose size is fixed, is solved on
the driver. One fold of the labelled rows is kept for calibration: ridge scores are counted in
``BINS`` bins, and the pool of adjacent violators makes the share of label 1 rise with the score.
Between the centres of its levels the calibrated score is interpolated.

Training uses all labelled rows whose crc32(id as text) mod FOLDS is not HELD_OUT; a score depends
on the text alone.

Defined cases: null and blank texts have statistics of zero and are scored like others; labels that
are null, or whose document does not exist, are not used; a document with several labels counts
with each; without labels, or with only one kind of label, the score is the share of label 1 (one
half without any).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetmill.llm.common import pack, stored, unpack
from packetmill.llm.langid import fold

FEATURES = 256
RIDGE = 1e-3
WIDTH = 1.5           # of the kernel, in roots of the number of statistics
BINS = 2000
LOWEST, HIGHEST = -0.5, 1.5
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
ACCEPT = 0.3
SEED = 20

STATISTICS = [
    "log_words", "word_length", "word_spread", "distinct_words", "commonest_word", "repeated_neighbours", "distinct_pairs",
    "capitals", "digits", "symbols", "symbol_words", "lone_symbols", "log_lines", "repeated_lines", "squeezed", "sentence_ends",
]
_SYMBOL = re.compile(r"[^\w\s]")
_SYMBOL_WORD = re.compile(r"(?:^|\s)\S*[^\w\s]{2,}\S*")


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of STATISTICS."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = text.splitlines()
    letters = max(1, len(text))
    packed = text.encode("utf-8", "surrogatepass")
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        np.log1p(n), lengths.mean(), lengths.std(), len(counts) / n ** 0.8, max(counts.values()) / n, same / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1), sum(map(str.isupper, words)) / n,
        sum(map(str.isdigit, words)) / n, len(_SYMBOL.findall(text)) / letters, len(_SYMBOL_WORD.findall(text)) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(zlib.compress(packed, 1)) / len(packed), sum(w[-1] in ".!?" for w in words) / n,
    ]


def add_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``row`` and ``x``, the statistics."""

    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    packed = pack(docs, id_col, text_col)
    return packed.select("id", "row", describe("text").alias("x"))


class Model:
    """Standardisation, random features, ridge weights and the calibration's levels."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        d = len(STATISTICS)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.turns = rng.standard_normal((d, FEATURES)) / (WIDTH * np.sqrt(d))
        self.shift = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.centres, self.levels = np.zeros(1), np.full(1, 0.5)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.c_[np.sqrt(2 / FEATURES) * np.cos(z @ self.turns + self.shift), np.ones(len(x))]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.centres, self.levels)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The sums of z z' and z y over rows of ``x``, ``y``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z, y = shared.value.features(_matrix(batch.column(0))), batch.column(1).to_numpy()
            total += z.T @ np.c_[z, y]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(FEATURES + 1), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"])

    def add(group: pa.Table) -> pa.Table:
        sums = np.stack([np.asarray(s.values) for s in group.column("sums")]).sum(0)
        return pa.table({"i": group.column("i").slice(0, 1), "sums": pa.array([sums], pa.list_(pa.float64()))})

    kind = "i long, sums array<double>"
    summed = rows.mapInArrow(run, kind).groupBy("i").applyInArrow(add, kind)
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in summed.collect():  # FEATURES + 1 rows
        total[r["i"]] = r["sums"]
    return total[:, :-1], total[:, -1]


def binned_scores(rows: DataFrame, model: Model) -> list[tuple[float, int, float]]:
    """``mean score, rows, sum of y`` of each bin of the ridge score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BINS))
        for batch in batches:
            raw, y = shared.value.raw(_matrix(batch.column(0))), batch.column(1).to_numpy()
            at = np.clip((raw - LOWEST) / (HIGHEST - LOWEST) * BINS, 0, BINS - 1).astype(np.int64)
            total += [np.bincount(at, w, BINS) for w in (raw, np.ones(len(raw)), y)]
        held = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), *(pa.array(row[held]) for row in total)], ["bin", "raw", "n", "y"])

    sums = rows.mapInArrow(run, "bin long, raw double, n double, y double").groupBy("bin").agg(
        F.sum("raw").alias("raw"), F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
    return [(r["raw"] / r["n"], int(r["n"]), r["y"]) for r in sorted(sums, key=lambda r: r["bin"])]


def isotonic(bins: list[tuple[float, int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Centres and rising levels: neighbours whose shares fall are pooled."""
    pools: list[list[float]] = []  # weighted centre, n, y
    for centre, n, y in bins:
        pools.append([centre * n, n, y])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            c, n1, y1 = pools.pop()
            pools[-1] = [pools[-1][0] + c, pools[-1][1] + n1, pools[-1][2] + y1]
    return np.array([c / n for c, n, _ in pools]), np.array([y / n for _, n, y in pools])


def train(described: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "quality") -> Model:
    """Fit on stored rows of ``id`` and ``x`` that have a label and are not held out."""
    d = len(STATISTICS)
    sums = described.agg(
        *[F.avg(F.col("x")[i]) for i in range(d)], *[F.stddev_pop(F.col("x")[i]) for i in range(d)]).first()
    mean, spread = (np.array([v or 0.0 for v in part]) for part in (sums[:d], sums[d:]))
    model = Model(mean, spread)
    known = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label).cast("double").alias("y")).dropna()
    known = known.filter(fold(F.col("id"), FOLDS) != HELD_OUT)
    rows = stored(described.select("id", "x").join(known, "id"), "labelled")
    in_calibration = fold(F.col("id"), FOLDS) == CALIBRATION
    n, share = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
    a, b = normal_equations(rows.filter(~in_calibration).select("x", "y"), model)
    if not n or not 0 < share < 1 or not a[-1, -1]:
        model.levels = np.full(1, share if n else 0.5)
        return model
    model.weights = np.linalg.solve(a + RIDGE * a[-1, -1] / FEATURES * np.eye(len(a)), b)
    bins = binned_scores(rows.filter(in_calibration).select("x", "y"), model)
    if bins:
        model.centres, model.levels = isotonic(bins)
    else:  # too few labels for a fold of their own
        model.centres, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def scorer(described: DataFrame, model: Model):
    """A column function: statistics to the calibrated score."""
    shared = described.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(np.clip(shared.value.score(np.stack(x.to_list())), 0, 1)) if len(x) else pd.Series([], dtype=float)

    return score


def score_ids(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``held_out``, ``score`` and ``predicted``."""
    described = stored(add_statistics(docs, id_col, text_col).drop("row"), "statistics")
    score = scorer(described, train(described, labels))
    scored = described.select("id", score("x").alias("score"))
    held_out = F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that the model accepts."""
    described = add_statistics(docs, id_col, text_col)
    return unpack(described.filter(scorer(described, model)("x") >= ACCEPT))
