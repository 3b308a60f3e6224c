"""BPE against the tokenizers library: pieces, merges, the transducer, whole tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from packetmill.llm import bpe
from packetmill.llm.pieces import PieceIds, Splitter, slices

PATH = public_tokenizers.path("word_bpe_49k.json")
JSON = open(PATH, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "\t\n", "it's 'LL we'd''s !!'s", "a b\u0085c d", "x́ ẹ́", "ΟΔΟΣ ΟΔΟΣ'", "İI ẞ ǅ",
    "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|x|>", "日本語 😀👍🏽", "\x00\x1c\x1f a", "½ ² ٣ Ⅷ 12", "a" * 300, "!?" * 200,
    "ab​cd", "﻿x", "don't CAN'T", "é" * 90 + "x", "<|", "École ÷×", "ño",
]


@pytest.fixture(scope="module")
def encoder():
    merger = bpe.Merger(JSON)
    words = ["the", "there", "thereof", "of", "off", "!!", "é", "tion", "nation", "ration", "a" * 300, "1"]
    return bpe.Encoder(JSON, bpe.compile_lexicon({w: merger.encode(w) for w in words}))


def check(encoder, texts):
    offsets, ids = encoder.encode(pa.array(texts, pa.string()))
    decoded = encoder.decode(offsets, ids).to_pylist()
    for i, text in enumerate(texts):
        want = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want, repr(text)
        assert decoded[i] == LIBRARY.decode(want, skip_special_tokens=False), repr(text)


def test_odd_texts(encoder):
    check(encoder, [*ODD, None, " ".join(ODD)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(encoder, texts):
    check(encoder, texts)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abetionTHR'sdmlv!?.<|> \néÉ́ß", max_size=120))
def test_dense_text(encoder, text):
    check(encoder, [text])


def test_long_pieces_merge_as_short_ones():
    merger, rng = bpe.Merger(JSON), random.Random(1)
    for _ in range(60):
        symbols = [rng.choice("etaoinshr") for _ in range(rng.randint(2, 200))]
        assert merger._scan(list(symbols)) == merger._heap(list(symbols))


def test_transducer_holds_exactly_its_words():
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): [i, i + 1][: 1 + i % 2] for i in range(800)}
    block = bpe.compile_lexicon(words)
    held = bpe.Transducer(block)
    other = ["".join(rng.choice("abéc") for _ in range(rng.randint(0, 8))) for _ in range(800)]
    number = held.numbers(pa.array([*words, *other], pa.large_string()))
    for word, n in zip([*words, *other], number):
        if word in words:
            assert held.ids[held.offsets[n]:held.offsets[n + 1]].tolist() == words[word]
        else:
            assert n == -1
    # Shared endings: fewer arcs than a tree of the same words needs.
    assert len(held.keys) < len({w.encode()[:i] for w in words for i in range(1, len(w.encode()) + 1)})
    assert bpe.Transducer(bpe.compile_lexicon({})).numbers(pa.array(["a", ""])).tolist() == [-1, -1]


def test_slices_cover_all_rows():
    column = pa.array(["a" * n for n in (5, 1, 0, 40, 3, 3)] + [None])
    assert [x for a, b in slices(column, 8) for x in range(a, b)] == list(range(7))
    assert list(slices(pa.array([], pa.string()))) == []


def test_table(spark):
    rows = [(i, t, "x", 1, "kept") for i, t in enumerate([*ODD, None])] + [(0, "again", None, 2, None), (None, "the nation", None, 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int, `my col` string")
    for most in (5, 100_000):
        out = bpe.encode(docs, PATH, most=most)
        assert out.columns == ["doc_id", "my col", "n_tokens", "ids", "decoded"]
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids"], r["decoded"]) for r in out.collect())
        want = []
        for doc_id, text, *_ in rows:
            ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
            want.append((doc_id is None, doc_id or 0, len(ids), bytearray(np.array(ids, "<u4").tobytes()),
                         LIBRARY.decode(ids, skip_special_tokens=False)))
        assert got == sorted(want)
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_query_against_the_library(spark, sf_dir):
    from packetmill.llm.queries import QUERIES

    got = {r["doc_id"]: tuple(r) for r in QUERIES["op6_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[r["doc_id"]] == (
            r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_digest_and_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "the nation", ("x",)), (2, None, None)], "doc_id long, text string, `a.b` struct<`c d`:string>")
    out = bpe.encode(docs, PATH, decode="digest")
    assert out.columns == ["doc_id", "a.b", "n_tokens", "ids", "decoded_sha256"]
    got = {r["doc_id"]: r["decoded_sha256"] for r in out.collect()}
    text = LIBRARY.decode(LIBRARY.encode("the nation").ids)
    assert got == {1: hashlib.sha256(text.encode()).hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
    assert bpe.encode(docs, PATH, decode=None).columns == ["doc_id", "a.b", "n_tokens", "ids"]


def test_counts_flush_and_long_pieces_stay_out_of_the_lexicon(spark, monkeypatch):
    monkeypatch.setattr(bpe, "COUNTED", 3)
    texts = ["a b c d e a", "a " + "z" * 500, "é b", None] * 5
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    counts = {r["piece"]: r["n"] for r in bpe.count_pieces(docs, JSON).collect()}
    assert counts == {"a": 15, "b": 10, "c": 5, "d": 5, "e": 5, "z" * 500: 5, "é": 5}
    words = {r["piece"] for r in bpe.frequent_pieces(bpe.count_pieces(docs, JSON)).collect()}
    assert words == {"a", "b", "c", "d", "e", "é"}


def test_remembered_pieces_are_forgotten_by_bytes():
    seen = []
    ids = PieceIds(lambda words: [seen.append(w) or [len(w)] for w in words], most=1000)
    for word in ["x" * 2000, "a", "x" * 2000, "a", "a"]:
        offsets, found = ids.ragged([word])
        assert found.tolist() == [len(word)] and offsets.tolist() == [0, 1]
    assert [len(w) for w in seen] == [2000, 1, 2000, 1]
