"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to ORDERS letters of the whole lower-case text, where every run
of other characters is one space, weighted by TF-IDF and scaled to length one. Document frequencies
are counted over all training rows; the weights are fitted by follow-the-regularised-leader with an
elastic-net penalty (L1 makes them sparse) on a bounded sample of the training rows: at most about
``SAMPLE`` documents, shared evenly by the languages and chosen by a hash. A fifth of the sample is
kept for the temperature by which the logits are divided, so that the score is a probability.

A row is for training if its language and text are known and crc32(id as text) mod FOLDS is not
HELD_OUT. A prediction uses the text alone.

Defined cases: a text that is null or without any letter is ``und`` with score 0; rows without an
id are never used for training and count as not held out; without training rows everything is
``und``. Every language of the training rows is learned, the rarest too; one takes 0.8 MB of the
driver's memory while the model is fitted, and 0.3 MB of the broadcast model.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill.llm.common import pack, stored, unpack

BITS = 15
SIZE = 1 << BITS
ORDERS = 3
SAMPLE = 4000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 2e-3, 1e-4, 5


@cache
def _letters() -> np.ndarray:
    """For every code point itself if it is a letter, else the space."""
    table = np.full(0x110000, 32, np.uint32)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    table[letters] = letters
    return table


def letters_of(text: str) -> np.ndarray:
    """Letters of the lower-case text, runs of anything else as one space, a space at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.r_[np.uint32(32), _letters()[points], np.uint32(32)]
    return found[np.r_[True, (found[1:] != 32) | (found[:-1] != 32)]]


def grams(letters: np.ndarray) -> np.ndarray:
    """Feature numbers of all n-grams, repeats included."""
    out, h = [], np.zeros(len(letters), np.uint32)
    for n in range(1, ORDERS + 1):
        h = (h[:len(letters) - n + 1] if n > 1 else h) * np.uint32(0x01000193) + letters[n - 1:] * np.uint32(0x9E3779B1)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
        out.append(mixed >> np.uint32(32 - BITS))
    return np.concatenate(out)


def counted(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct features of a text and how often each occurs; None without a letter."""
    letters = letters_of(text)
    if not (letters != 32).any():
        return None
    found = grams(letters)
    if len(found) < SIZE // 8:
        return np.unique(found, return_counts=True)
    counts = np.bincount(found, minlength=SIZE)
    features = np.flatnonzero(counts)
    return features, counts[features]


class Model:
    """Weights, document frequencies and temperature; small enough to broadcast."""

    def __init__(self, languages: list[str], idf: np.ndarray):
        self.languages, self.idf = languages, idf.astype(np.float64)
        self.weights = np.zeros((SIZE + 1, len(languages)))  # the last row is the bias
        self.temperature = 1.0

    def vector(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[features]
        return x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, features: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[features] + self.weights[-1]

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """Follow the regularised leader, one document after the other; then the temperature."""
        fit, keep = [r for i, r in enumerate(rows) if i % 5], rows[::5]
        z, n = np.zeros_like(self.weights), np.zeros_like(self.weights)

        def solved(at):
            w = -(np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
            return w

        for _ in range(EPOCHS):
            for features, x, label in fit or rows:
                at = np.r_[features, SIZE]
                x1 = np.r_[x, 1.0]
                w = solved(at)
                p = _softmax(x1 @ w)
                p[label] -= 1
                g = np.outer(x1, p)
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
                n[at] += g * g
        self.weights = solved(slice(None)).astype(np.float32).astype(np.float64)
        logits = np.array([self.logits(f, x) for f, x, _ in keep])
        labels = np.array([label for *_, label in keep])

        def loss(t: float) -> float:
            scaled = logits / t
            top = scaled.max(1)
            return float((top + np.log(np.exp(scaled - top[:, None]).sum(1)) - scaled[np.arange(len(labels)), labels]).mean())

        self.temperature = min(np.exp(np.linspace(np.log(0.05), np.log(20), 200)), key=loss)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counted(text) if text and self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        features, counts = found
        p = _softmax(self.logits(features, self.vector(features, counts)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fold(id_col: Column, folds: int) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(folds))


def _document_frequencies(texts: DataFrame) -> DataFrame:
    """``feature, n``: texts that have each feature; a task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SIZE, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = counted(text.as_py())
                if found:
                    n[found[0]] += 1
        features = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(n[features])], ["feature", "n"])

    return texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _sample_rows(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(*found, lang, order) for lang, order, text in zip(*(c.to_pylist() for c in batch.columns))
                    if (found := counted(text))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[3] for x in held], pa.int64()), pa.array([x[2] for x in held], pa.string()),
                 pa.array([x[0].astype(np.int32) for x in held], pa.list_(pa.int32())),
                 pa.array([x[1].astype(np.int32) for x in held], pa.list_(pa.int32()))],
                ["luck", "lang", "features", "counts"])

    return sample.mapInArrow(run, "luck long, lang string, features array<int>, counts array<int>")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Model:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("text is not null and lang is not null").filter(fold(F.col("id"), FOLDS) != HELD_OUT)
    per_language = rows.groupBy("lang").count().collect()  # one row per language
    languages = sorted(r["lang"] for r in per_language)
    if not languages:
        return Model([], np.zeros(SIZE))
    total = sum(r["count"] for r in per_language)
    df = np.zeros(SIZE)
    for r in _document_frequencies(rows.select("text")).collect():  # SIZE rows at most
        df[r["feature"]] = r["n"]
    model = Model(languages, np.log((1 + total) / (1 + df)) + 1)

    # A row is in the sample if its hash lies under its language's share of the range of hashes.
    share = {r["lang"]: min(1.0, sample / len(languages) / r["count"]) for r in per_language}
    bound = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 40)))])
    luck = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40))
    chosen = rows.withColumn("luck", luck).filter(F.col("luck") < F.element_at(bound, F.col("lang")))
    number = {lang: i for i, lang in enumerate(languages)}
    picked = _sample_rows(chosen.select("lang", "luck", "text")).toArrow()
    order = np.argsort(picked.column("luck").to_numpy(), kind="stable") if len(picked) else []
    features, counts, langs = (picked.column(c) for c in ("features", "counts", "lang"))
    training = []
    for i in order:
        f, c = np.asarray(features[int(i)].values), np.asarray(counts[int(i)].values)
        training.append((f, model.vector(f, c), number[langs[int(i)].as_py()]))
    if training:
        model.fit(training)
    return model


def predictor(docs: DataFrame, model: Model):
    """A column function: text to a struct of ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             model: Model | None = None) -> DataFrame:
    """Every input row with ``held_out``, ``lang_pred`` and ``score``."""
    model = model or train(docs, id_col, text_col, lang_col)
    packed = pack(docs, id_col, text_col).withColumn("p", predictor(docs, model)("text"))
    held_out = F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False))
    return unpack(packed, held_out.alias("held_out"), F.col("p.lang_pred").alias("lang_pred"), F.col("p.score").alias("score"))


def known_language(docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """The input rows whose language is recognised with a score of at least ``least``."""
    model = train(docs, id_col, text_col, lang_col)
    packed = pack(docs, id_col, text_col).withColumn("p", predictor(docs, model)("text"))
    return unpack(packed.filter((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= least)))
