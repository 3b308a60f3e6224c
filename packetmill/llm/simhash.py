"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits: bit b is set if it is set in over half of the hashes of the
document's word shingles, repeats included. Fingerprints that differ in at most ``distance`` bits
are linked; the components of these links are found without comparing all pairs.

1. *Anchors.* The binary Golay code of length 23 has 4096 codewords, and every 23-bit word lies
   within 3 bits of exactly one: it covers perfectly. Two such codes cover the first 46 bits of the
   fingerprints with 2^24 anchors of covering radius 3 + 3.
2. *Replication.* If x and y differ in at most t bits, some z lies between them, at most
   ceil(t / 2) bits from either. The anchor that covers z is within the covering radius plus that
   share of the threshold of both, so every distinct fingerprint goes to all anchors within radius
   3 + p of one half and 3 + q of the other, for all p + q <= ceil(t / 2): 9.6 on average for t = 2.
   (Sending one side the whole way and the other to its own anchor finds the same pairs with 61.)
3. *Comparison.* The fingerprints of an anchor are compared with each other by XOR and bit count,
   and what leaves is a forest of links, never all pairs. Crowded anchors are cut into chunks, and
   pairs of chunks are separate groups that may run in separate tasks.

Equal fingerprints are one node throughout, however many documents have them.

Defined cases: a null text counts as empty; a text without words has the fingerprint zero, which is
linked like any other; with fewer words than a shingle the whole sequence is one shingle; rows that
repeat an id keep rows of their own; a component without any id has a null ``component_id``; an
empty table gives an empty result; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from packetmill.llm.common import pack, stored, unpack
from packetmill.llm.components import connected
from packetmill.operators.joins import join_summary

WORDS = 5
DISTANCE = 2
SEED = 42
# The Golay code's length, its generator polynomial, and the radius that covers all words.
LENGTH, GENERATOR, RADIUS = 23, 0xC75, 3
CHECK_BITS = 11
CHUNK = 2048           # fingerprints of an anchor that are compared with as many others at once
PAIRS = 1 << 20        # comparisons held in memory at once
BATCH = 20_000         # fingerprints that are replicated together
HASHES = 1 << 16       # of one document whose bits are counted together


def fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of one text."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    # A run of blanks becomes one blank; those at the ends go.
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    data = np.where(blank, np.uint8(32), data)[kept].tobytes().strip(b" ")
    if not data:
        return 0
    cuts = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = np.r_[0, cuts + 1], np.r_[cuts, len(data)]
    n = max(1, len(starts) - words + 1)
    starts, ends = starts[:n], ends[-n:]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        spans = zip(starts[at:at + HASHES].tolist(), ends[at:at + HASHES].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in spans), "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def syndromes(words: np.ndarray) -> np.ndarray:
    """What is left of each 23-bit word after division by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


@cache
def error_patterns(excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the patterns that lead to a codeword ``excess`` bits beyond the covering radius.

    Offsets by syndrome, then the patterns; for excess 0 all within the radius, which is one each.
    """
    weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
    patterns = np.array([sum(1 << b for b in bits) for w in weights for bits in combinations(range(LENGTH), w)], np.int64)
    kind = syndromes(patterns)
    order = np.argsort(kind, kind="stable")
    return np.searchsorted(kind[order], np.arange((1 << CHECK_BITS) + 1)), patterns[order]


def anchors(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of ``prints``, and the anchors that each goes to."""
    halves = [(prints >> np.uint64(LENGTH * i)).astype(np.int64) & ((1 << LENGTH) - 1) for i in range(2)]
    kinds = [syndromes(h) for h in halves]
    share = -(-distance // 2)
    rows, out = [], []
    for p in range(share + 1):
        for q in range(share + 1 - p):
            (offsets_p, patterns_p), (offsets_q, patterns_q) = error_patterns(p), error_patterns(q)
            many_q = np.diff(offsets_q)[kinds[1]]
            many = np.diff(offsets_p)[kinds[0]] * many_q
            row = np.repeat(np.arange(len(prints)), many)
            k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            first = halves[0][row] ^ patterns_p[offsets_p[kinds[0][row]] + k // many_q[row]]
            second = halves[1][row] ^ patterns_q[offsets_q[kinds[1][row]] + k % many_q[row]]
            rows.append(row)
            # A codeword's upper bits tell it from all others.
            out.append((first >> CHECK_BITS) << (LENGTH - CHECK_BITS) | second >> CHECK_BITS)
    return np.concatenate(rows), np.concatenate(out)


def _replicate(distance: int):
    """``anchor, print`` for every anchor of every fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().astype(np.int64)
            for at in range(0, len(prints), BATCH):
                some = prints[at:at + BATCH]
                row, anchor = anchors(some.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(some[row])], ["anchor", "print"])

    return run


def joined(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The least node that each of n nodes reaches by the edges u-v, and by ``root`` so far."""
    root = np.arange(n) if root is None else root
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(root, up := root[root]):
            root = up


def linked(prints: np.ndarray, n_left: int, distance: int) -> np.ndarray:
    """Roots of the fingerprints, the first ``n_left`` of which are compared with all."""
    root = np.arange(len(prints))
    step = max(1, PAIRS // max(1, len(prints)))
    for at in range(0, n_left, step):
        near = np.bitwise_count(prints[at:at + step, None] ^ prints[None, :]) <= distance
        u, v = np.nonzero(near)
        root = joined(len(prints), u + at, v, root)
    return root


def _link_groups(distance: int):
    """A forest of the links of each group: ``a, b`` as hexadecimal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for left, right in zip(batch.column(0), batch.column(1)):
                left, right = (x.values.to_numpy().view(np.uint64) for x in (left, right))
                prints = np.concatenate([left, right])
                root = linked(prints, len(left), distance)
                tied = np.flatnonzero(root != np.arange(len(prints)))
                a.append(prints[tied])
                b.append(prints[root[tied]])
            a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{x:016x}" for x in y.tolist()], pa.string()) for y in (a, b)], ["a", "b"])

    return run


def groups(prints: DataFrame, distance: int, chunk: int) -> DataFrame:
    """``lefts, rights``: what is compared, the lefts with each other and with all rights.

    An anchor with more than ``chunk`` fingerprints is dealt into chunks by hash, and every pair of
    chunks, and every chunk with itself, is a group of its own.
    """
    rows = prints.select("print").mapInArrow(_replicate(distance), "anchor int, print long")
    crowded = rows.groupBy("anchor").count().filter(F.col("count") > chunk).select(
        # A rewritten key gives this small side an exchange of its own, so a crowded anchor can be split.
        F.shiftleft(F.col("anchor").cast("long"), 1).alias("twice"), F.ceil(F.col("count") / chunk).cast("int").alias("cuts"))
    placed = rows.join(crowded, F.col("anchor").cast("long") == F.shiftright("twice", 1), "left")
    own = F.coalesce(F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int"), F.lit(0))
    others = F.sequence(F.lit(0), F.coalesce(F.col("cuts"), F.lit(1)) - 1)
    places = F.transform(others, lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), (own <= o).alias("left")))
    dealt = placed.select("anchor", "print", F.inline(places)).repartition("anchor", "i", "j")
    grouped = dealt.groupBy("anchor", "i", "j").agg(
        F.collect_list(F.when(F.col("left"), F.col("print"))).alias("lefts"),
        F.collect_list(F.when(~F.col("left"), F.col("print"))).alias("rights"))
    return grouped.filter(F.size("lefts") + F.size("rights") > 1).select("lefts", "rights")


def links(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links that connect whatever links connect, of a table of distinct ``print``."""
    return groups(prints, distance, chunk).mapInArrow(_link_groups(distance), "a string, b string")


def add_fingerprint(packed: DataFrame, words: int) -> DataFrame:
    """``id, row, fingerprint`` of packed rows; the text goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f"{fingerprint(t.as_py(), words):016x}" for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string())], ["id", "row", "fingerprint"])

    others = packed.select("id", "row")
    schema = StructType(others.schema.fields).add("fingerprint", "string")
    return packed.select("text", "id", "row").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text", chunk: int = CHUNK, keep_text: bool = True) -> DataFrame:
    """Every row with its ``fingerprint`` and ``component_id``, the least id reachable by links."""
    packed = pack(docs, id_col, text_col)
    if not keep_text:
        packed = packed.withColumn("row", F.col("row").dropFields(f"`{text_col}`"))
    rows = stored(add_fingerprint(packed, words), "fingerprints")
    least = rows.groupBy("fingerprint").agg(F.min("id").alias("least"))
    nodes = stored(least.withColumn("print", F.conv("fingerprint", 16, -10).cast("long")), "nodes")
    roots = connected(links(nodes, distance, chunk)).withColumnRenamed("node", "fingerprint")
    named = nodes.select("fingerprint", "least").join(roots, "fingerprint", "left")
    named = named.withColumn("root", F.coalesce("root", "fingerprint"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component"))
    components = join_summary(named.select("root", "fingerprint"), of_root, ["root"]).select("fingerprint", "component")
    placed = join_summary(rows, components, ["fingerprint"])
    return unpack(placed, F.col("fingerprint"), F.col("component").alias("component_id"))
