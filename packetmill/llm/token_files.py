"""Token ids in files of independent zstandard frames, from which single documents can be read.

A file holds some thousand documents in ascending id order: frames of a few documents each, a frame
with the document index (an Arrow stream of id and number of tokens), and at the end a seek table
in the public seekable format of zstandard: for every frame its compressed and its plain size and a
checksum of the plain bytes. A reader fetches the table, the index, and the frames it needs.

Plain bytes of a data frame: one byte with the width of its ids (2 or 4), then the ids of its
documents, little-endian. Documents are never divided between frames.

Files are written under a temporary name and then moved, so a task that is lost or tried again
leaves whole files of the same content. Folders are opened with ``pyarrow.fs``, which takes paths,
``file://``, ``hdfs://``, ``s3://`` and ``gs://``.

Defined cases: a null text counts as empty and still gets the end id; null document ids come first;
rows that repeat an id are documents of their own, next to each other; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetmill.llm.common import stored
from packetmill.llm.pieces import SPECIAL_MARK, PieceIds, Splitter, byte_letters, encode_column, slices
from packetmill.session import scratch_dir

FRAME_IDS = 1 << 15
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 1 << 7
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")

_INDEX = pa.schema([("id", pa.int64()), ("n", pa.uint32())])


def _checksum(plain: bytes) -> int:
    return xxhash.xxh64(plain).intdigest() & 0xFFFFFFFF


class FrameWriter:
    """Writes one file: documents in the order given."""

    def __init__(self, out):
        self.out, self.compress = out, zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries: list[bytes] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self._held: list[np.ndarray] = []
        self._n = 0

    def _frame(self, plain: bytes) -> None:
        packed = self.compress(plain)
        self.out.write(packed)
        self.entries.append(_ENTRY.pack(len(packed), len(plain), _checksum(plain)))

    def _flush(self) -> None:
        if self._held:
            ids = np.concatenate(self._held)
            width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
            self._frame(bytes([width]) + ids.astype(f"<u{width}").tobytes())
        self._held, self._n = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self._n and self._n + len(ids) > FRAME_IDS:
            self._flush()
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self._held.append(ids)
        self._n += len(ids)

    def close(self) -> None:
        self._flush()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _INDEX) as stream:
            stream.write_table(pa.table([self.doc_ids, self.counts], schema=_INDEX))
        self._frame(sink.getvalue().to_pybytes())
        footer = _FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        size = sum(map(len, self.entries)) + len(footer)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, size) + b"".join(self.entries) + footer)


class FrameReader:
    """Reads one file; only the frames that are asked for are fetched and decompressed."""

    def __init__(self, file):
        self.file, self.decompress = file, zstandard.ZstdDecompressor().decompress
        size = file.size()
        n, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("not a file of seekable frames with checksums")
        table = self._at(size - _FOOTER.size - n * _ENTRY.size, n * _ENTRY.size)
        self.entries = [_ENTRY.unpack_from(table, i * _ENTRY.size) for i in range(n)]
        self.starts = np.r_[0, np.cumsum([e[0] for e in self.entries])]
        index = pa.ipc.open_stream(self.frame(n - 1)).read_all()
        self.doc_ids, self.counts = index.column("id").to_pylist(), index.column("n").to_numpy().astype(np.int64)

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, i: int) -> bytes:
        packed, plain_size, checksum = self.entries[i]
        plain = self.decompress(self._at(int(self.starts[i]), packed), max_output_size=plain_size)
        if len(plain) != plain_size or _checksum(plain) != checksum:
            raise ValueError(f"frame {i} is damaged")
        return plain

    def _frame_ids(self, i: int) -> np.ndarray:
        plain = self.frame(i)
        return np.frombuffer(plain, f"<u{plain[0]}", offset=1)

    def documents(self, wanted: set | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """Document ids and token ids in file order, of all documents or the wanted ones."""
        at, frame, ids, held = 0, -1, None, 0
        # Frames are cut exactly where the writer cut them: before the document that would overfill one.
        for doc_id, n in zip(self.doc_ids, self.counts):
            if frame < 0 or (held and held + n > FRAME_IDS):
                frame, ids, held, at = frame + 1, None, 0, 0
            if wanted is None or doc_id in wanted:
                if ids is None:
                    ids = self._frame_ids(frame)
                yield doc_id, ids[at:at + n].astype("<u4")
            at, held = at + n, held + n


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class LibraryEncoder:
    """Whole columns of text encoded by the tokenizers library, every distinct piece once.

    Pieces are normalised and cut already, so they go to the library's BPE model itself, spelled in
    the letters that it writes bytes with.
    """

    def __init__(self, tokenizer_json: str):
        self.splitter = Splitter(tokenizer_json)
        self.model = self.splitter.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.pieces = PieceIds(lambda words: list(map(self._piece, words)))

    def _piece(self, word: str) -> list[int]:
        if word.startswith(SPECIAL_MARK) and word[1:] in self.splitter.special:
            return [self.splitter.special[word[1:]]]
        return [token.id for token in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return encode_column(self.splitter, self.pieces.ragged, texts)


@cache
def _library_encoder(tokenizer_json: str) -> LibraryEncoder:
    return LibraryEncoder(tokenizer_json)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of document ids.

    Returns one stored row per file: ``file_no, path, n_docs, n_ids, start`` where ``start`` counts
    the ids in all files before it. Texts are dealt out by ranges of ids; rows that share an id (or
    have none) are told apart by a hash of their text, so even those spread over files.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    opened, root = open_folder(folder)
    opened.create_dir(root, recursive=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = _library_encoder(shared.value), TaskContext.get()
        file_no, name = context.partitionId(), f"tokens-{context.partitionId():06d}.zst"
        files, root = open_folder(folder)
        n_ids, writer, part = 0, None, f"{root}/{name}.{context.taskAttemptId()}.tmp"
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts):
                if writer is None:
                    out = files.open_output_stream(part)
                    writer = FrameWriter(out)
                offsets, ids = encoder.encode(texts.slice(a, b - a))
                for i in range(b - a):
                    writer.add(doc_ids[a + i], np.append(ids[offsets[i]:offsets[i + 1]], np.uint32(end_id)))
                n_ids += int(offsets[-1]) + b - a
        if writer is not None:
            writer.close()
            out.close()
            files.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_pylist([{"file_no": file_no, "name": name, "n_docs": len(writer.counts), "n_ids": n_ids}])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    written = stored(rows.select("id", "text").mapInArrow(run, "file_no long, name string, n_docs long, n_ids long"), "files")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return stored(written.select(
        "*", F.lit(folder).alias("folder"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents of the files, checksums verified.

    Every file is a task of its own.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, root = open_folder(row["folder"])
                with files.open_input_file(f"{root}/{row['name']}") as file:
                    reader, start, held, size = FrameReader(file), row["start"], [], 0
                    for doc_id, ids in reader.documents():
                        held.append((doc_id, start, len(ids), ids.tobytes()))
                        start, size = start + len(ids), size + len(ids)
                        if size > 1 << 20:
                            yield _document_rows(held)
                            held, size = [], 0
                    yield _document_rows(held)

    # A stated number of ranges is not merged again, and neighbouring numbers never meet by their hash.
    dealt = manifest.repartitionByRange(max(1, manifest.count()), "file_no").select("folder", "name", "start")
    return dealt.mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def _document_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids"])


def read_documents(path: str, doc_ids: set[int]) -> dict[int, np.ndarray]:
    """Token ids of the given documents of one file; other frames are not fetched."""
    files, name = open_folder(path)
    with files.open_input_file(name) as file:
        return dict(FrameReader(file).documents(doc_ids))


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """All documents of the files just written."""
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer_path, end_id))
