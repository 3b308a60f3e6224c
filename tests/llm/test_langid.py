"""Language ID: held-out accuracy, what predictions may depend on, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetmill.llm import langid


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").cache()


@pytest.fixture(scope="module")
def model(docs):
    return langid.train(docs)


def test_held_out_accuracy(docs, model):
    out = langid.identify(docs, model=model).filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score"), F.count("*")).first()
    assert out[0] > 0.98 and 0 <= out[1] <= out[2] <= 1 and out[3] > 150


def test_scores_are_calibrated(docs, model):
    got = langid.identify(docs, model=model).filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg("score")).first()
    assert abs(got[0] - got[1]) < 0.03


def test_weights_are_sparse(model):
    assert 0 < (model.weights != 0).mean() < 0.5


def test_held_out_rows_and_other_columns_are_not_learned(docs, model):
    other = docs.withColumn("lang", F.when(langid.fold(F.col("doc_id"), 4) == 2, F.lit("xx")).otherwise(F.col("lang")))
    again = langid.train(other)
    assert again.languages == model.languages and np.array_equal(again.weights, model.weights)
    text = docs.filter("lang = 'de'").first()["text"]
    assert model.predict(text)[0] == "de"


def test_odd_rows(spark, docs, model):
    rows = [(1, None, "en", 1), (2, "", "en", 2), (3, "123 !? ²", None, 3), (None, "der und die ist nicht das ein eine", "de", 4),
            (None, None, None, 5), (5, "x", "de", 6), (5, "the of and to in is that " * 20_000, "en", 7), (6, "日本語", None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = langid.identify(df, model=model)
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["held_out"] is not None
    kept = langid.known_language(df, 0.0)
    assert kept.columns == df.columns and kept.count() in (4, 0)


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    assert langid.identify(spark.createDataFrame([], schema)).collect() == []
    row, = langid.identify(spark.createDataFrame([(1, "text", None)], schema)).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_features_count_every_gram():
    letters = langid.letters_of("Ab, 12 é")
    assert "".join(map(chr, letters)) == " ab é "
    assert len(langid.grams(letters)) == 6 + 5 + 4
    features, counts = langid.counted("ab ab " * 3000)
    assert counts.sum() == len(langid.grams(langid.letters_of("ab ab " * 3000)))
    assert langid.counted("12 !") is None


def test_every_language_is_learned(spark):
    """Three hundred languages, the rarest with two documents of a share of the sample."""
    letters = [chr(0x4E00 + i) for i in range(300)]
    rows = [(i * 10 + k, f"{x * 9} {x * 4} a {x * 7}", f"l{i:03d}") for i, x in enumerate(letters) for k in range(2 if i % 50 else 6)]
    rows = [r for r in rows for _ in (0,) if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=1500)
    assert model.languages == sorted({r[2] for r in rows}) and len(model.languages) > 256
    told = [model.predict(r[1])[0] for r in rows]
    assert len(set(told)) > 256 and sum(t == r[2] for t, r in zip(told, rows)) > 0.85 * len(rows)
