"""The quality classifier: held-out accuracy, sums against plain numpy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetmill.llm import quality

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    from packetmill.llm.queries import QUERIES

    return QUERIES["op4_quality"](spark, BIG).cache()


def test_held_out_rows(spark, scored):
    rows = scored.filter("held_out").join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert good and bad
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([(r["predicted"] == r["quality"]) for r in rows]) > 0.93


def test_every_document_is_scored(spark, scored):
    assert scored.count() == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert scored.filter("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_held_out_labels_change_nothing(spark, scored):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.score_ids(docs, turned).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in scored.collect())


def test_sums_and_calibration(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    x, y = rng.normal(size=(500, d)), rng.integers(0, 2, 500).astype(float)
    model = quality.Model(np.zeros(d), np.ones(d))
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(7)
    a, b = quality.normal_equations(rows, model)
    z = model.features(x)
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)
    # The features approximate the kernel.
    k = model.features(x)[:, :-1]
    far = ((x[:40, None] - x[None, :40]) ** 2).sum(2)
    assert np.abs(k[:40] @ k[:40].T - np.exp(-far / (2 * quality.WIDTH ** 2 * d))).mean() < 0.08
    bins = quality.binned_scores(rows, model)
    assert sum(n for _, n, _ in bins) == 500 and sum(s for *_, s in bins) == y.sum()


def test_isotonic():
    centres, levels = quality.isotonic([(0.1, 2, 1), (0.2, 2, 0), (0.3, 4, 2), (0.5, 1, 1), (0.6, 2, 1), (0.9, 3, 3)])
    assert (np.diff(levels) > 0).all() and (np.diff(centres) > 0).all()
    assert np.allclose(levels, [1 / 4, 1 / 2, 2 / 3, 1])


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " "), (None, "a b"), (4, "x"), (4, "x"), (5, "word " * 30_000)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score_ids(docs, none).collect()} == {0.5}
    same = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (9, 0, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_ids(docs, same).collect()
    assert len(got) == 7 and {r["score"] for r in got} == {1.0}
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)] + [(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in quality.score_ids(docs, mixed).collect())
    assert quality.score_ids(docs.limit(0), same).collect() == []
    described = quality.add_statistics(docs)
    model = quality.train(described, same)
    assert quality.good_documents(docs, model).columns == docs.columns
