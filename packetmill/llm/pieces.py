"""Splitting text into the pieces that a word-based BPE encodes one by one, in whole Arrow columns.

No piece crosses ASCII white space, and the normaliser works within it too. So a column of texts is
cut at white space, equal chunks are taken together, and only distinct chunks are split further:
plain ones (printable ASCII and the letters of Latin-1) by one regular expression over the column,
all others, and those that may hold a special token, one by one by the tokenizer's own normaliser
and pre-tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# The pattern of the tokenizer file's pre-tokenizer, for plain chunks.
PLAIN_PIECE = r"('s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\s\pL\pN]+)"
PLAIN_CHUNK = "^[!-~À-ÿ]*$"
MARKS = ",.;:!?*#$%&|-"  # after a word, any run of these is one piece
SPECIAL_MARK = "\0"  # a piece that starts with it is a special token; text never makes such a piece
SLICE_BYTES = 4 << 20
CACHE_BYTES = 48 << 20  # of remembered pieces
PIECE_BYTES = 120       # that a remembered piece takes beside its own letters


def byte_letters() -> list[str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``most`` bytes each; a longer text stands alone.

    Memory that Arrow holds of the slice before is given back first.
    """
    pool = pa.default_memory_pool()
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        pool.release_unused()
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to
        at = to


def take_ragged(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the given rows, one after the other: their offsets and values."""
    starts, lengths = offsets[:-1][rows], np.diff(offsets)[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    at = np.repeat(starts - out[:-1], lengths)
    at += np.arange(out[-1])
    return out, values[at]


class Splitter:
    """Pieces of whole columns of text, as the given tokenizer file splits them."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._bytes = {letter: b for b, letter in enumerate(byte_letters())}

    def odd_chunk(self, chunk: str) -> list[str]:
        """Pieces of a chunk that is not plain."""
        out = []
        for i, part in enumerate(self._cut.split(chunk)):
            if i % 2:
                out.append(SPECIAL_MARK + part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                for shown, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    out.append(bytes(self._bytes[c] for c in shown).decode())
        return out

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """``doc_offsets, chunks, chunk_offsets, pieces, words``.

        Text ``d`` is the chunks ``chunks[doc_offsets[d]:doc_offsets[d + 1]]``, chunk ``c`` the pieces
        ``pieces[chunk_offsets[c]:chunk_offsets[c + 1]]``, and piece ``p`` is spelled ``words[p]``.
        """
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        flat = lists.flatten()
        filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        count = np.r_[0, np.cumsum(filled)]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        doc_offsets = count[offsets - offsets[0]]
        coded = flat.filter(pa.array(filled)).dictionary_encode()
        chunks, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        plain = pc.match_substring_regex(distinct, PLAIN_CHUNK).to_numpy(zero_copy_only=False)
        plain &= ~pc.match_substring(distinct, "<|").to_numpy(zero_copy_only=False)
        # Most plain chunks are a word, or a word and then marks; those need no expression.
        heads = pc.utf8_rtrim(distinct, MARKS)
        simple = plain & pc.utf8_is_alpha(heads).to_numpy(zero_copy_only=False)
        cut, cut_counts = _heads_and_marks(distinct.filter(pa.array(simple)), heads.filter(pa.array(simple)))
        plain &= ~simple
        spaced = pc.replace_substring_regex(pc.utf8_lower(distinct.filter(pa.array(plain))), PLAIN_PIECE, r"\1 ")
        mixed = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
        rest = ~(simple | plain)
        odd = [self.odd_chunk(c) for c in distinct.filter(pa.array(rest)).to_pylist()]
        # The ragged table holds simple chunks, then mixed ones, then odd ones; chunk numbers follow.
        place = np.empty(len(distinct), np.int64)
        at = 0
        for kind in (simple, plain, rest):
            place[kind] = at + np.arange(kind.sum())
            at += kind.sum()
        counts = np.concatenate([cut_counts, np.diff(mixed.offsets.to_numpy()), [len(x) for x in odd]]).astype(np.int64)
        chunk_offsets = np.r_[0, np.cumsum(counts)]
        words = pa.concat_arrays([cut, mixed.flatten(), pa.array(list(chain(*odd)), pa.large_string())]).dictionary_encode()
        pieces = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return doc_offsets, place[chunks], chunk_offsets, pieces, words.dictionary.to_pylist()


def _heads_and_marks(chunks: pa.Array, heads: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each chunk's word in lower case and the marks after it, if any, and how many pieces that is."""
    if not len(chunks):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    ends = np.cumsum(pc.binary_length(chunks).to_numpy())
    first = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset]
    both = np.empty(2 * len(chunks) + 1, np.int64)
    both[0], both[2::2] = first, first + ends
    both[1::2] = both[:-1:2] + pc.binary_length(heads).to_numpy()
    # The chunks lie one after the other in their buffer, which need only be cut at more places.
    parts = pa.LargeStringArray.from_buffers(2 * len(chunks), pa.py_buffer(both), chunks.buffers()[2])
    filled = np.diff(both) > 0
    return pc.utf8_lower(parts.filter(pa.array(filled))), 1 + filled[1::2]


class PieceIds:
    """Ids of pieces, remembered by the worker; forgotten all at once beyond about ``most`` bytes."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = CACHE_BYTES):
        self.encode, self.most = encode, most
        self._forget()

    def _forget(self):
        self.number, self.offsets, self.ids, self.held = {}, np.zeros(1, np.int64), np.zeros(0, np.uint32), 0

    def ragged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the given distinct pieces."""
        if self.held > self.most:
            self._forget()
        new = [w for w in words if w not in self.number]
        if new:
            lists = self.encode(new)
            self.held += sum(map(len, new)) + PIECE_BYTES * len(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.offsets = np.r_[self.offsets, self.offsets[-1] + np.cumsum([len(x) for x in lists])]
            self.ids = np.r_[self.ids, np.fromiter(chain(*lists), np.uint32)]
        rows = np.fromiter((self.number[w] for w in words), np.int64, len(words))
        return take_ragged(self.offsets, self.ids, rows)


def encode_column(splitter: Splitter, ids_of: Callable, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of whole texts; ``ids_of`` gives offsets and ids of distinct pieces."""
    doc_offsets, chunks, chunk_offsets, pieces, words = splitter.split(texts)
    piece_offsets, piece_ids = ids_of(words)
    # From pieces to chunks: the ids of a chunk's pieces lie together once the pieces are laid out.
    laid_offsets, laid_ids = take_ragged(piece_offsets, piece_ids, pieces)
    ends, ids = take_ragged(laid_offsets[chunk_offsets], laid_ids, chunks)
    return ends[doc_offsets], ids


@cache
def splitter_of(tokenizer_json: str) -> Splitter:
    """One splitter per worker and tokenizer file."""
    return Splitter(tokenizer_json)
