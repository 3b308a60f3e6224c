"""Near copies by five-word shingles and a similarity of 0.8, as the pipeline's stage takes them."""

import random
import re

import numpy as np
import pytest
from test_jaccard import SMALL, families

import corpus_pipeline
from packetmill.llm import jaccard


def plain_sets(rows, k):
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        yield {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def plain_components(rows, k=5, percent=80):
    sets, root = list(plain_sets(rows, k)), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def edges_of_the_limit():
    """A text and one copy of it each, told by whether the copy is near enough."""
    rng, rows, near = random.Random(11), [], []
    for share, edits, linked in [(0.15, 0, True), (0.24, 0, True), (0.27, 0, False), (0.0, 0.02, True), (0.0, 0.03, False)]:
        base = [f"w{rng.randrange(10**9)}" for _ in range(500)]
        copy = base + [f"x{rng.randrange(10**9)}" for _ in range(int(share * 500))]
        for i in range(int(edits * 500)):
            copy[10 + i * 480 // int(edits * 500)] = f"e{rng.randrange(10**9)}"
        near += [linked]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    return rows, near


def test_stage_on_both_sides_of_the_limit(spark):
    rows, near = edges_of_the_limit()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "/nowhere").collect()}
    assert kept == {2 * i for i in range(len(near))} | {2 * i + 1 for i, linked in enumerate(near) if not linked}


@pytest.mark.parametrize("seed", [1, 8])
def test_against_all_pairs(spark, seed):
    rows = families(seed) + SMALL
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for options in ({}, {"chunk": 16, "large": 20}):
        got = jaccard.join_components(docs, words=5, percent=80, **options).collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == plain_components(rows)


def test_bounds():
    rng = np.random.default_rng(2)
    for n in (1, 4, 5, 6, 9, 12, 19, 50, 300, 2000):
        base = rng.integers(0, 2**63, 2 * n + 300).astype(np.uint64)
        most = int(jaccard.limit(2 * n, 80))
        for d in sorted({*range(0, most, 1 + most // 20), most}):
            for out in {0, d // 2, d}:
                x, y = base[:n], np.r_[base[out:n], base[n:n + d - out]]
                if d > jaccard.limit(len(x) + len(y), 80):
                    continue
                assert set(jaccard.block_keys(x, 80)) & set(jaccard.block_keys(y, 80)), (n, d, out)
                # Only what both have recurs; that is enough for either.
                both = np.intersect1d(x, y)
                cells = np.zeros(1 << jaccard.CELL_BITS - 3, np.uint8)
                at = jaccard._cells(both)
                np.bitwise_or.at(cells, (at >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
                assert jaccard.may_have_partner(x, cells, 80) and jaccard.may_have_partner(y, cells, 80)
