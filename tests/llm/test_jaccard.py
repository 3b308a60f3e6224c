"""The n-gram Jaccard join against comparing every two documents."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from packetmill.llm import jaccard
from packetmill.llm.components import connected


def plain_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else ({tuple(words)} if words else set())


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posted = {}
    for i, s in enumerate(sets):
        for x in s:
            posted.setdefault(x, []).append(i)
    seen = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in posted[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def families(seed, n=60, copies=14, length=(1, 400)):
    """Texts, and copies with ever more edits, so that similarities lie on both sides of the limit."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    rows, shared = [], [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*length))]
        if rng.random() < 0.2:
            base = shared + base[:30]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6, 10])):
                at = rng.randrange(len(words) + 1)
                words[at:at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1]) or []
            text = (" " if rng.random() < 0.9 else "\t\n ").join(words)
            rows.append((len(rows) * 3 % 1009, text.upper() if rng.random() < 0.1 else text))
    return rows


SMALL = [
    (1, None), (2, ""), (3, " \t"), (4, "one"), (5, "One"), (6, "one two"), (7, "one  two"), (8, "one two three"), (9, "ONE\ttwo\nthree"),
    (10, "É two three"), (11, "é two three"), (None, "one two"), (6, "one two"), (12, "a b c a b c a b c"), (13, "b c a b c a b c a b"), (14, "w " * 50_000),
    (15, "w w w"), (16, "two one"),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = families(seed) + SMALL
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.join_components(docs).collect())
    assert got == plain_components(rows)


def test_one_large_family_in_small_chunks(spark):
    rows = families(3, n=2, copies=120, length=(150, 160))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_components(rows)
    for options in ({"chunk": 16, "large": 20}, {"chunk": 7, "large": 10**9}):
        assert sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.join_components(docs, **options).collect()) == want


def test_one_of_each_component_stays(spark):
    rows = [(1000 + i, t) for i, (_, t) in enumerate(families(4, n=25))] + SMALL
    docs = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, label string, node int")
    got = jaccard.one_per_component(docs)
    assert got.columns == docs.columns
    kept = sorted((str(r["doc_id"]), len(plain_set(r["text"]))) for r in got.collect())
    parts = plain_components(rows)
    least = sorted({(c) for d, n, c in parts if n})
    assert sorted(d for d, n in kept if n) == least
    assert sum(n == 0 for _, n in kept) == sum(n == 0 for _, n, _ in parts)


def test_empty_and_unrelated(spark):
    schema = "doc_id long, text string"
    assert jaccard.join_components(spark.createDataFrame([], schema)).collect() == []
    assert jaccard.one_per_component(spark.createDataFrame([], schema)).collect() == []
    apart = spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], schema)
    assert sorted(map(tuple, jaccard.join_components(apart).collect())) == [(1, 2, 1), (2, 2, 2)]


def test_bounds():
    rng = np.random.default_rng(1)
    for n in (1, 5, 9, 10, 19, 50, 300, 2000):
        base = rng.integers(0, 2**63, n + 300).astype(np.uint64)
        for d in range(0, int(jaccard.limit(2 * n)) + 1):
            # d shingles differ, as unevenly as allowed
            out, into = d // 2, d - d // 2
            x, y = base[:n], np.r_[base[out:n], base[n:n + into]]
            if d > jaccard.limit(len(x) + len(y)):
                continue
            assert set(jaccard.block_keys(x)) & set(jaccard.block_keys(y)), (n, d)
            common = set(jaccard.bands(len(x))) & set(jaccard.bands(len(y)))
            for band in common:
                assert np.bitwise_count(jaccard.bit_sketch(x, band) ^ jaccard.bit_sketch(y, band)).sum() <= d
    for total in range(2, 400):  # the limit is that of the similarity
        for a in range(1, total):
            b = total - a
            best = max((2 * i for i in range(0, min(a, b) + 1) if 100 * i >= 90 * (a + b - i)), default=None)
            least = [a + b - 2 * i for i in range(min(a, b) + 1) if 100 * i >= 90 * (a + b - i)]
            assert not least or max(least) <= jaccard.limit(total)
            assert best is None or total - best >= 0


def test_shingles_follow_the_words():
    texts = [t for _, t in SMALL] + ["a b c d", "A  b c d", None]
    sets = jaccard.shingle_sets(pa.array(texts, pa.string()))
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(set(sets[i]) & set(sets[j])) == len(plain_set(a) & plain_set(b)), (a, b)


def test_components(spark):
    rng = random.Random(5)
    edges = [(f"{a:04}", f"{a + 1:04}") for a in range(300) if a % 50 < 47] + [("0400", f"{i:04}") for i in range(401, 600)]
    rng.shuffle(edges)
    root = {}
    for a, b in sorted(edges):
        root[b] = root.setdefault(a, a)
    df = spark.createDataFrame(edges + edges[:9], "a string, b string").repartition(9)
    for chunk in (10**6, 40):  # in one task, and in several with star rounds between
        rows = connected(df, chunk).collect()
        assert {r["node"]: r["root"] for r in rows} == root and len(rows) == len(root)


def test_a_family_joined_by_sort_merge_is_dealt_out_again(spark):
    """Without broadcasting, the groups of a hot family still lie in separate tasks."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        rows = families(3) + SMALL
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = jaccard.join_components(docs, chunk=8, large=20).collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == plain_components(rows)
        sets = spark.createDataFrame(
            [("f", f"n{i}", i, 1, bytes(8), [(0, bytes(8))]) for i in range(300)],
            "family string, node string, handle long, n long, shingles binary, sketches array<struct<band:int,words:binary>>")
        grid = jaccard._grid(sets, None, 20).repartition("family", "band", "i", "j").groupBy("family", "band", "i", "j").count()
        plan = grid._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning(family" in plan and "REPARTITION_BY_COL" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_recurring_cells_over_slots(spark, monkeypatch):
    rows = families(4)
    packed = jaccard.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), "doc_id", "text")
    whole = jaccard.recurring_cells(packed, 5).value
    monkeypatch.setattr(jaccard, "SLOT_ROWS", 20)
    assert (jaccard.recurring_cells(packed, 5).value == whole).all() and whole.any()


def test_cells_sent_as_numbers_or_bits():
    """Empty, few and many set bits come back as they were; few of them travel as a few bytes."""
    rng = np.random.default_rng(4)
    size = 1 << jaccard.PART_BITS
    for n in (0, 1, 4095, 4096, 60_000):
        bits = np.zeros(size, bool)
        bits[rng.choice(size, n, replace=False)] = True
        packed = np.packbits(bits)
        made = jaccard._sent(pa.table({"part": pa.array([7], pa.int32()), "once": [b""], "twice": [packed.tobytes()]}))
        sent = made.column("twice")[0].as_py()
        assert len(sent) == min(2 * n, size // 8) and made.column("part")[0].as_py() == 7
        assert (jaccard._received(sent) == packed).all()


def test_recurring_cells_hold_what_two_rows_share(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 7:i * 7 + 30])) for i in range(50)]
    packed = jaccard.pack(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    table = jaccard.recurring_cells(packed, 5).value
    seen = Counter(int(c) for s in jaccard.shingle_sets(pa.array([t for _, t in rows]), 5) for c in jaccard._cells(s))
    want = sorted(c for c, n in seen.items() if n > 1)
    assert want and np.flatnonzero(np.unpackbits(table)).tolist() == want


def test_cells_in_rounds_know_the_same_texts(spark, monkeypatch):
    """More shingles than one table tells apart are looked up in rounds, and the result is the same."""
    assert jaccard.cell_rounds(10, 1 << 20) == (1, 1) and jaccard.cell_rounds(10, 20 << 30)[1] > 10
    rng = random.Random(5)
    rows = [*families(6, n=20), *((2000 + i, " ".join(str(rng.random()) for _ in range(60))) for i in range(50)), (9000, None), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = jaccard.pack(docs, "doc_id", "text")
    table = jaccard.recurring_cells(packed, 5).value
    handles = [r[0] for r in docs.select(jaccard.F.xxhash64(jaccard.F.coalesce("text", jaccard.F.lit("")))).collect()]
    sets = jaccard.shingle_sets(pa.array([r[0] for r in docs.select("text").collect()]), 5)
    want = {h for h, s in zip(handles, sets) if len(s) and jaccard.may_have_partner(s, table, 80)}
    for slots in (1, 3):
        got = {r.handle for r in jaccard._with_enough(packed, 80, 5, slots, 4).collect()}
        assert got == want and 0 < len(want) < len(set(handles)) - 40
    one = sorted(map(str, jaccard.one_per_component(docs, words=5, percent=80).collect()))
    monkeypatch.setattr(jaccard, "cell_rounds", lambda texts, size: (1, 3))
    assert sorted(map(str, jaccard.one_per_component(docs, words=5, percent=80).collect())) == one
