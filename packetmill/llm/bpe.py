"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon.

The pieces of all texts are counted, the frequent ones (at most ``LEXICON`` of them) are encoded
once and compiled into a minimal acyclic automaton: words share their endings as well as their
beginnings, and every arc carries how many words come before it, so that a walk adds up to the
word's number, which points at its ids. Words are at most ``WORD_BYTES`` long, so the automaton has
at most LEXICON * WORD_BYTES arcs of 24 bytes (184 MB; 5 MB for plain text). It is one block of bytes;
it is broadcast, and every worker maps it into memory from a file. Texts are encoded column by column:
distinct pieces walk the automaton side by side, and pieces it does not hold are merged exactly by
the ranks of the tokenizer file.

Ids come out as little-endian unsigned 32-bit binary, and the decoded text joins the tokens of the
ids by one space, which is what the tokenizer file's empty decoder does.

Defined cases: null and blank texts have no ids and decode to the empty text; the strings of
special tokens become their ids, as the tokenizers library does; one piece may be of any length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from packetmill.llm.common import stored
from packetmill.llm.pieces import SPECIAL_MARK, PieceIds, byte_letters, encode_column, slices, splitter_of, take_ragged

LEXICON = 120_000
WORD_BYTES = 64      # of a lexicon word; longer pieces are merged
COUNTED = 200_000    # distinct pieces that a task adds up before it passes them on
SHORT = 40  # symbols up to which scanning for the best merge beats a heap


class Merger:
    """Exact BPE merges of one piece."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model = spec["model"]
        self.vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        tokens = self.vocab | self.special
        self.tokens = [""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.tokens[i] = token

    def encode(self, piece: str) -> list[int]:
        if piece.startswith(SPECIAL_MARK) and piece[1:] in self.special:
            return [self.special[piece[1:]]]
        symbols = [self.letters[b] for b in piece.encode()]
        if not symbols:
            return []
        symbols[-1] += self.end
        merged = self._scan(symbols) if len(symbols) <= SHORT else self._heap(symbols)
        return [self.vocab[s] for s in merged]

    def _scan(self, symbols: list[str]) -> list[str]:
        none, ranks = len(self.ranks), self.ranks
        scores = [ranks.get(p, none) for p in zip(symbols, symbols[1:])]
        while scores and (best := min(scores)) < none:
            i = scores.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get((symbols[i - 1], symbols[i]), none)
            if i < len(scores):
                scores[i] = ranks.get((symbols[i], symbols[i + 1]), none)
        return symbols

    def _heap(self, symbols: list[str]) -> list[str]:
        """The same for long pieces, in time n log n: neighbours are linked, pairs wait in a heap."""
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if not symbols[i] or j >= n or self.ranks.get((symbols[i], symbols[j])) != rank:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] < n and (r := self.ranks.get((symbols[a], symbols[right[a]]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [s for s in symbols if s]


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """The automaton of the given words and their ids, as one block of bytes.

    Words are added in byte order; a state is finished, and replaced by an equal finished one, as
    soon as no further word can pass through it. Layout: five lengths, then the arcs' keys (state
    and byte, sorted), targets, and numbers of earlier words, the final states, the offsets of the
    words' ids, and the ids.
    """
    spelled = sorted((w.encode(), ids) for w, ids in words.items() if w)
    arcs: list[list[tuple[int, int]]] = []      # of finished states: (byte, target)
    final: list[bool] = []
    below: list[int] = []                       # words that a state leads to
    known: dict[tuple, int] = {}

    def finish(is_final: bool, out: list[tuple[int, int]]) -> int:
        key = (is_final, *out)
        if key not in known:
            known[key] = len(arcs)
            arcs.append(out)
            final.append(is_final)
            below.append(is_final + sum(below[t] for _, t in out))
        return known[key]

    path: list[list] = [[False, []]]            # unfinished states of the last word: final, arcs
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            is_final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], finish(is_final, out)))

    for word, _ in spelled:
        common = len(os.path.commonprefix([last, word]))
        close(common)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        last = word
    close(0)
    root = finish(*path[0])

    keys, targets, earlier = [], [], []
    for state, out in enumerate(arcs):
        seen = int(final[state])
        for byte, target in out:
            keys.append(state * 256 + byte)
            targets.append(target)
            earlier.append(seen)
            seen += below[target]
    ids = [i for _, x in spelled for i in x]
    parts = [
        np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(earlier, "<i8"), np.array(final, "<i8"),
        np.r_[0, np.cumsum([len(x) for _, x in spelled])].astype("<i8"), np.array(ids, "<i8"),
    ]
    return np.array([root, *map(len, parts)], "<i8").tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """A compiled lexicon, mapped into memory, that many words walk side by side."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:  # has no name, so nothing of it stays behind
            file.write(block)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        cells = np.frombuffer(self._map, "<i8")
        self.root, *lengths = cells[:7].tolist()
        self.keys, self.targets, self.earlier, self.final, self.offsets, self.ids = np.split(
            cells[7:], np.cumsum(lengths)[:-1])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 for those it does not hold."""
        words = words.cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        number = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return number
        live = np.arange(len(words))
        state, count = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        depth = 0
        while len(live):
            ended = lengths[live] == depth
            done = live[ended]
            number[done] = np.where(self.final[state[done]] != 0, count[done], -1)
            live = live[~ended]
            key = state[live] * 256 + data[offsets[live] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            held = self.keys[arc] == key
            live, arc = live[held], arc[held]
            state[live] = self.targets[arc]
            count[live] += self.earlier[arc]
            depth += 1
        return number


class Encoder:
    """Whole columns of text to ids and back."""

    def __init__(self, tokenizer_json: str, lexicon: bytes):
        self.splitter, self.merger = splitter_of(tokenizer_json), merger_of(tokenizer_json)
        self.lexicon = Transducer(lexicon)
        self.unseen = PieceIds(lambda words: list(map(self.merger.encode, words)))
        self.tokens = pa.array(self.merger.tokens, pa.string())

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number = self.lexicon.numbers(pa.array(words, pa.large_string()))
        missed = np.flatnonzero(number < 0)
        offsets, ids = self.unseen.ragged([words[i] for i in missed])
        # One ragged table: the lexicon's words first, then those that were merged just now.
        rows = number.copy()
        rows[missed] = len(self.lexicon.offsets) - 1 + np.arange(len(missed))
        all_offsets = np.r_[self.lexicon.offsets, self.lexicon.offsets[-1] + offsets[1:]]
        return take_ragged(all_offsets, np.r_[self.lexicon.ids, ids], rows)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets, ids = encode_column(self.splitter, self._ids_of, texts)
        return offsets, ids.astype("<u4")

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.tokens.take(pa.array(ids)))
        return pc.binary_join(lists, " ")


@cache
def merger_of(tokenizer_json: str) -> Merger:
    return Merger(tokenizer_json)


_encoders: dict[int, Encoder] = {}


def _encoder(key: int, tokenizer_json: str, lexicon: bytes) -> Encoder:
    """The worker's encoder of one broadcast lexicon; an earlier one is let go."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json, lexicon)
    return _encoders[key]


def as_binary(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Lists of ids as little-endian binary values."""
    width = ids.dtype.itemsize
    buffers = [None, pa.py_buffer((offsets * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())


def count_pieces(docs: DataFrame, tokenizer_json: str, text_col: str = "text") -> DataFrame:
    """``piece, n`` over all texts; every task adds up its own before anything shuffles."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, total = splitter_of(shared.value), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["piece", "n"])

        for batch in batches:
            column = batch.column(0)
            for a, b in slices(column):
                _, chunks, chunk_offsets, pieces, words = splitter.split(column.slice(a, b - a))
                per_chunk = np.bincount(chunks, minlength=len(chunk_offsets) - 1)
                n = np.bincount(pieces, np.repeat(per_chunk, np.diff(chunk_offsets)), len(words)).astype(np.int64)
                total.update(dict(zip(words, n.tolist())))
                if len(total) > COUNTED:
                    yield told()
                    total.clear()
        if total:
            yield told()

    return docs.select(text_col).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_pieces(counts: DataFrame, most: int = LEXICON) -> DataFrame:
    """The short pieces whose count reaches the lowest level that at most ``most`` of them reach.

    Levels are eighths of a power of two, so only some hundreds of sums reach the driver.
    """
    counts = counts.filter(F.octet_length("piece") <= WORD_BYTES)
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    per_level = sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    total, lowest = 0, 1 << 20
    for r in per_level:
        total += r["count"]
        if total > most:
            break
        lowest = r["level"]
    return counts.filter(level >= lowest)


def build_lexicon(docs: DataFrame, tokenizer_json: str, text_col: str = "text", most: int = LEXICON) -> bytes:
    """A compiled lexicon of the corpus's frequent pieces, at most ``most`` of them."""
    counts = stored(count_pieces(docs, tokenizer_json, text_col), "pieces")
    merger = Merger(tokenizer_json)
    words = [r["piece"] for r in frequent_pieces(counts, most).collect()]
    return compile_lexicon({w: merger.encode(w) for w in words})


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", decode: str | None = "text",
           most: int = LEXICON) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` to every row; the text is dropped.

    ``decode="text"`` also adds the ids' text as ``decoded``, ``decode="digest"`` its SHA-256 in
    hexadecimal as ``decoded_sha256``, so that the text itself need not leave the worker. Columns of the input with these names are replaced.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    told = {"text": ["decoded string"], "digest": ["decoded_sha256 string"], None: []}[decode]
    added = ["n_tokens long", "ids binary", *told]
    names = [a.split()[0] for a in added]
    others = [c for c in docs.columns if c != text_col and c.lower() not in names]
    lexicon = build_lexicon(docs, tokenizer_json, text_col, most)
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, lexicon))
    key = hash((tokenizer_path, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, *shared.value)
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                offsets, ids = encoder.encode(texts.slice(a, b - a))
                columns = [pa.array(np.diff(offsets)), as_binary(offsets, ids)]
                if decode:
                    text = encoder.decode(offsets, ids)
                    columns.append(text if decode == "text" else _digests(text))
                kept = [batch.column(i + 1).slice(a, b - a) for i in range(len(others))]
                yield pa.RecordBatch.from_arrays(kept + columns, [f"c{i}" for i in range(len(others))] + names)

    # Numbered while they pass through the workers: names may be any.
    rest = docs.select(F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    schema = StructType(rest.schema.fields[1:] + StructType.fromDDL(", ".join(added)).fields)
    return rest.mapInArrow(run, schema).toDF(*others, *names)
