"""The whole results of the language and quality queries against plain fits of the same models."""

import math
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import xxhash

from packetmill.llm import langid, quality
from packetmill.llm.queries import QUERIES


def read(sf_dir, name, *columns):
    table = pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns))
    return list(zip(*(table.column(c).to_pylist() for c in columns)))


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def plain_counts(text):
    """How often each feature occurs, one n-gram after the other; None without a letter."""
    letters = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
    if not letters:
        return None
    letters = f" {letters} "
    found = Counter()
    for n in range(1, 4):
        for i in range(len(letters) - n + 1):
            h = 0
            for c in letters[i:i + n]:
                h = (h * 0x01000193 + ord(c) * 0x9E3779B1) % 2**32
            found[((h ^ (h >> 15)) * (0x85EBCA6B + 2 * n) % 2**32) >> 17] += 1
    return found


def plain_languages(rows):
    """``doc_id -> (lang_pred, score)`` of rows ``doc_id, text, lang``, all training rows in the sample."""
    training = [(i, t, g) for i, t, g in rows if t is not None and g is not None and fold(i, 4) != 2]
    languages = sorted({g for *_, g in training})
    assert len(training) < langid.SAMPLE / len(languages)
    df = Counter()
    for _, text, _ in training:
        df.update((plain_counts(text) or {}).keys())

    def vector(text):
        counts = plain_counts(text)
        x = {f: (1 + math.log(c)) * (math.log((1 + len(training)) / (1 + df[f])) + 1) for f, c in counts.items()}
        length = math.sqrt(math.fsum(v * v for v in x.values()))
        return {**{f: v / length for f, v in x.items()}, "bias": 1.0}

    def luck(doc_id, text):
        first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        return xxhash.xxh64_intdigest(text.encode(), first) % 2**40

    ordered = [(vector(t), languages.index(g)) for i, t, g in sorted(training, key=lambda r: luck(r[0], r[1])) if plain_counts(t)]
    z, n = defaultdict(float), defaultdict(float)

    def weight(at):
        if abs(z[at]) <= langid.L1:
            return 0.0
        return (math.copysign(langid.L1, z[at]) - z[at]) / ((langid.BETA + math.sqrt(n[at])) / langid.ALPHA + langid.L2)

    def shares(logits):
        top = max(logits)
        e = [math.exp(v - top) for v in logits]
        return [v / sum(e) for v in e]

    for _ in range(langid.EPOCHS):
        for i, (x, label) in enumerate(ordered):
            if i % 5 == 0:
                continue
            w = {(f, k): weight((f, k)) for f in x for k in range(len(languages))}
            p = shares([math.fsum(v * w[f, k] for f, v in x.items()) for k in range(len(languages))])
            for (f, k), old in w.items():
                g = x[f] * (p[k] - (k == label))
                z[f, k] += g - (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / langid.ALPHA * old
                n[f, k] += g * g
    final = {at: float(np.float32(weight(at))) for at in list(z)}

    def logits(x):
        return [math.fsum(v * final.get((f, k), 0.0) for f, v in x.items()) for k in range(len(languages))]

    kept = [(logits(x), label) for x, label in ordered[::5]]
    temperature = min(np.exp(np.linspace(np.log(0.05), np.log(20), 200)), key=lambda t: sum(
        -math.log(max(shares([v / t for v in l])[label], 1e-300)) for l, label in kept))
    out = {}
    for doc_id, text, _ in rows:
        if plain_counts(text) is None:
            out[doc_id] = ("und", 0.0)
            continue
        p = shares([v / temperature for v in logits(vector(text))])
        out[doc_id] = (languages[p.index(max(p))], max(p))
    return out


def test_language_query(spark, sf_dir):
    rows = read(sf_dir, "documents", "doc_id", "text", "lang")
    want = plain_languages(rows)
    got = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert len(got) == len(rows) == len(want)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-5
        assert r["held_out"] == (fold(r["doc_id"], 4) == 2)


def plain_isotonic(bins):
    """Levels by the min-max formula, exactly; neighbours of one level share a centre."""
    def share(a, b):
        return Fraction(sum(int(y) for *_, y in bins[a:b + 1]), sum(n for _, n, _ in bins[a:b + 1]))

    m = len(bins)
    levels = [max(min(share(a, b) for b in range(i, m)) for a in range(i + 1)) for i in range(m)]
    centres = [sum(c * n for (c, n, _), v in zip(bins, levels) if v == level) / sum(n for (_, n, _), v in zip(bins, levels) if v == level)
               for level in sorted(set(levels))]
    return centres, [float(v) for v in sorted(set(levels))]


def plain_quality(docs, labels):
    """``doc_id -> score``: one matrix of all rows, least squares with the penalty as further rows."""
    x = np.array([quality.statistics(t) for _, t in docs])
    spread = x.std(0)
    rng = np.random.default_rng(quality.SEED)
    turns = rng.standard_normal((x.shape[1], quality.FEATURES)) / (quality.WIDTH * math.sqrt(x.shape[1]))
    shift = rng.uniform(0, 2 * math.pi, quality.FEATURES)
    standard = ((x - x.mean(0)) / np.where(spread > 1e-9, spread, 1)).clip(-8, 8)
    z = np.column_stack([math.sqrt(2 / quality.FEATURES) * np.cos(standard @ turns + shift), np.ones(len(x))])
    place = {doc_id: i for i, (doc_id, _) in enumerate(docs)}
    known = [(place[i], float(y), fold(i, 5)) for i, y in labels if y is not None and i in place]
    fit = [(at, y) for at, y, f in known if f > 1]
    a, y = z[[at for at, _ in fit]], np.array([y for _, y in fit])
    penalty = math.sqrt(quality.RIDGE * len(fit) / quality.FEATURES) * np.eye(z.shape[1])
    weights = np.linalg.lstsq(np.vstack([a, penalty]), np.r_[y, np.zeros(z.shape[1])], rcond=None)[0]
    raw = z @ weights
    bins = defaultdict(list)
    for at, y, f in known:
        if f == 1:
            width = (quality.HIGHEST - quality.LOWEST) / quality.BINS
            bins[min(max(int((raw[at] - quality.LOWEST) / width), 0), quality.BINS - 1)].append((raw[at], y))
    told = [(sum(r for r, _ in b) / len(b), len(b), sum(y for _, y in b)) for _, b in sorted(bins.items())]
    return dict(zip((i for i, _ in docs), np.interp(raw, *plain_isotonic(told)).clip(0, 1)))


def test_quality_query(spark, sf_dir):
    docs = read(sf_dir, "documents", "doc_id", "text")
    want = plain_quality(docs, read(sf_dir, "labels", "doc_id", "quality"))
    got = QUERIES["op4_quality"](spark, sf_dir).collect()
    assert len(got) == len(docs) == len(want)
    for r in got:
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-5
        assert r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (fold(r["doc_id"], 5) == 0)
