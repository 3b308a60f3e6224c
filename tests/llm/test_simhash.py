"""SimHash near-duplicates against comparing all pairs."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from packetmill.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, n):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= distance:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {p: find(p) for p in root}


def documents():
    rng = np.random.default_rng(3)
    words = [f"W{i}" for i in range(50)]
    base = [" ".join(rng.choice(words, 80)) for _ in range(12)]
    docs = [(i, base[i % 12]) for i in range(60)]  # exact copies
    for i in range(60, 300):  # near copies: one to six words differ
        text = base[i % 12].split()
        for at in rng.integers(0, len(text), 1 + i % 6):
            text[at] = "changed"
        docs.append((i, "\t ".join(text)))
    return docs + [
        (400, None), (401, ""), (402, " \n\x0b "), (403, "one"), (404, "ONE  "), (405, "one two"), (406, "\x1c two words"),
        (None, base[0]), (None, "only without id"), (407, "x" * 200_000), (408, "long text " * 60_000), (3, "É é 語"), (3, "É é 語")]


@pytest.mark.parametrize("options", [{}, {"words": 3}, {"words": 3, "chunk": 7}, {"words": 2, "distance": 3}, {"words": 3, "distance": 5, "chunk": 40}])
def test_against_all_pairs(spark, options):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = simhash.near_duplicates(df, keep_text=False, **options)
    prints = [plain_print(t, options.get("words", 5)) for _, t in docs]
    roots = plain_roots(prints, options.get("distance", 2))
    least = {}
    for (i, _), p in zip(docs, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    expected = sorted((str(i), f"{p:016x}", str(least.get(roots[p]))) for (i, _), p in zip(docs, prints))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out.collect()) == expected
    assert out.columns == ["doc_id", "fingerprint", "component_id"]


def test_clustered_prints_of_every_distance(spark):
    """Chains and dense clusters of fingerprints, with the bits that no anchor sees among them."""
    rng = np.random.default_rng(5)
    centres = [0, (1 << 64) - 1, *(int(x) for x in rng.integers(0, 1 << 63, 4))]
    prints = {c ^ sum(1 << int(b) for b in rng.choice(64, k, False)) for c in centres for k in (0, 1, 1, 2, 2, 3, 4, 5) for _ in range(25)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    for distance, chunk in ((1, 2048), (2, 30), (4, 2048)):
        edges = [(int(r.a, 16), int(r.b, 16)) for r in simhash.links(df, distance, chunk).collect()]
        assert all((a ^ b).bit_count() <= 64 and a != b for a, b in edges)
        root = {p: p for p in prints}
        for a, b in edges * 12:  # enough rounds to settle small forests
            root[a] = root[b] = min(root[a], root[b])
        wanted = plain_roots(prints, distance)
        same = lambda r: {frozenset(p for p in prints if r[p] == x) for x in set(r.values())}
        assert same(root) == same(wanted)


def test_every_word_is_covered_once_and_near_words_share_an_anchor():
    offsets, patterns = simhash.error_patterns(0)
    assert (np.diff(offsets) == 1).all() and len(patterns) == 2048
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for flips in (1, 2):
        y = x.copy()
        for _ in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
        (r, a), (s, b) = simhash.anchors(x, 2), simhash.anchors(y, 2)
        assert all(set(a[r == i]) & set(b[s == i]) for i in range(300))
        assert len(np.unique(np.stack([r, a]), axis=1).T) == len(r)  # no anchor twice


def test_empty_table_other_columns_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 2), (2, "a b", "y", 3)], "doc_id long, text string, Fingerprint string, `a.b` int")
    out = simhash.near_duplicates(df).orderBy("doc_id")
    assert out.columns == ["doc_id", "text", "a.b", "fingerprint", "component_id"]
    assert [(r[0], r[1], r[2], r[4]) for r in out.collect()] == [(1, "a b", 2, 1), (2, "a b", 3, 1)]


def test_crowded_anchors_run_in_separate_groups(spark):
    """A third of all fingerprints near one anchor: its chunks lie in groups of bounded size."""
    rng = np.random.default_rng(7)
    prints = {sum(1 << int(b) for b in rng.choice(64, 3, False)) for _ in range(1500)} | {int(x) for x in rng.integers(0, 1 << 62, 3000)}
    df = spark.createDataFrame([(p,) for p in prints if p < 1 << 63] + [(p - (1 << 64),) for p in prints if p >> 63], "print long")
    sizes = simhash.groups(df, 2, 200).agg(F.max(F.size("lefts") + F.size("rights"))).first()[0]
    assert sizes < 2 * 200 * 1.5
