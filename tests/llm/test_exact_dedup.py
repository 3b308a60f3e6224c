"""Exact deduplication against plain grouping."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetmill.llm import exact_dedup

ROWS = [
    (5, "a  b", "x"), (3, "a b", "y"), (9, "a\t\n b", None), (1, "a b ", "z"), (2, None, "n"), (4, "", "n"), (8, " ", "n"), (None, "a b", "null id"),
    (None, "alone", None), (7, "same", "1"), (7, "same", "1"), (7, "same", "1"), (6, "é é", ""), (10, "é é", ""), (11, "x" * 100_000, ""), (12, "x" * 100_000, ""),
    *[(100 + i, f"text {i % 40} " * 3, "many") for i in range(400)],
]


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        kept = 0
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((str(i), str(keep), len(ids), kept == 0, sha))
            kept += 1
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept string").repartition(5)


def rows_of(df):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())


def test_all_rows(docs):
    assert rows_of(exact_dedup.exact_dedup(docs)) == plain(ROWS)


def test_rounds_agree(docs):
    """Few bits: many rounds, each with a filter that is mostly full."""
    prints = exact_dedup.add_fingerprint(docs).select("id", "text_sha256")
    got = exact_dedup.mark_repeats(prints, bits_per_row=700, max_bits=exact_dedup.BLOCK_BITS).withColumnRenamed("id", "doc_id")
    assert rows_of(got) == plain(ROWS)


def test_one_round_is_broadcast_at_a_time(docs, monkeypatch):
    """Every round gives its filter back before the next one is made; rows keep all their columns."""
    live, most = [], []
    made = exact_dedup.repeated_hash_tests

    def counted(*args):
        rounds, test = made(*args)

        def one(i):
            maybe = test(i)
            free = maybe.give_back
            live.append(i)
            most.append(len(live))
            maybe.give_back = lambda: (live.remove(i), free())
            return maybe

        return rounds, one

    monkeypatch.setattr(exact_dedup, "repeated_hash_tests", counted)
    prints = exact_dedup.add_fingerprint(docs)
    got = exact_dedup.unpack(
        exact_dedup.mark_repeats(prints, bits_per_row=700, max_bits=exact_dedup.BLOCK_BITS), *[F.col(c) for c in (
            "keep_id", "group_size", "kept", "text_sha256")])
    assert rows_of(got) == plain(ROWS)
    assert len(most) > 5 and set(most) == {1} and not live


def test_rest_passes_and_columns_stay(docs):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    got = left.collect()
    assert len(got) == sum(r[3] for r in plain(ROWS))
    assert {r["kept"] for r in got if r["doc_id"] == 7} == {"1"}
    assert exact_dedup.drop_copies(docs.limit(0)).collect() == []


def test_filter_finds_every_repeat_and_few_others(spark):
    rng = np.random.default_rng(3)
    h = rng.integers(-2**63, 2**63, 20_000)
    repeated = h[:500]
    df = spark.createDataFrame([(int(x),) for x in [*h, *repeated]], "h long").repartition(7)
    rounds, test = exact_dedup.repeated_hash_tests(df, df.count())
    assert rounds == 1
    hit = {r["h"] for r in df.filter(test(0)(F.col("h"))).collect()}
    assert hit >= {int(x) for x in repeated}
    assert len(hit) < 500 + 0.1 * len(h)
