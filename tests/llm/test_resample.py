"""Importance resampling against a plain version."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
import regex

from packetmill.llm import resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, max_words):
    words = [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) if w]
    return [" ".join(words[i:i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)], len(words)


def plain(docs, target, percent=10, max_words=1, least=20, buckets=10_000, seed="2024"):
    def place(f):
        return crc32(f.encode()) % buckets

    s, t, rows = Counter(), Counter(), []
    for i, text in docs:
        found, n = plain_features(text, max_words)
        s.update(map(place, found))
        rows.append((i, found, n))
    for text in target:
        t.update(map(place, plain_features(text, max_words)[0]))
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, found, n in rows:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in map(place, found))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted(ranked + [(*r[:4], None) for r in out if r[4] < least], key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def documents(n=300):
    words = "the cat sat on a mat and Dog ran Über den Fluß 42 x9 foo-bar it's naïve 日本 語".split()
    docs = [(i, " ".join(words[(i * j * 7 + j) % len(words)] for j in range(i % 60))) for i in range(n)]
    return docs + [
        (1000, None), (1001, ""), (1002, " .,;\x00 "), (None, "cat " * 30), (None, None), (7, "dog mat " * 40), (7, "dog mat " * 40),
        (1003, "word " * 60_000), (1004, "a" * 300_000), (1005, " nbsp stays in a word " * 10)]


@pytest.mark.parametrize("options", [{}, {"max_words": 3, "buckets": 97, "percent": 35, "seed": "x"}])
def test_against_plain_version(spark, options):
    docs, target = documents(), ["the cat sat on the mat", "Dog ran", None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resample.resample(df, wanted, **options)) == plain(docs, target, **options)


def test_other_columns_stay_and_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([(1, "cat " * 25, "r", 3.5)], "doc_id long, text string, Rank string, `a.b` double")
    out = resample.resample(df, df.select("text"), percent=100)
    assert out.columns == ["doc_id", "text", "a.b", "n_features", "weight", "score", "rank"]
    assert out.first()[:4] == (1, "cat " * 25, 3.5, 25) and out.first()["rank"] == 1
    assert "text" not in resample.resample(df, df.select("text"), keep_text=False).columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(documents(40)[:40], none.schema)
    assert resample.resample(none, some.select("text")).count() == 0
    assert got(resample.resample(some, none.select("text"))) == plain(documents(40)[:40], [])


def test_spans_are_those_of_whole_words():
    text = b"ab c \xc3\xa9 d"
    spans = [m.span() for m in resample.span_pattern(2).finditer(text, overlapped=True)]
    assert [text[a:b] for a, b in spans] == [b"ab c", b"c \xc3\xa9", b"\xc3\xa9 d"]
    assert isinstance(resample.SEPARATORS, regex.Pattern)
