"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; each of its documents should be taken ``target / source_size``
times. The whole part of that is taken by all of them. The fractional part is a probability, and
pivotal rounding settles it: two undecided documents trade expected words, one gains what the other
loses, until one of them is taken or not; the other goes on against the next. The expected words of
a source never change on the way, so its total ends within one document of the target.

The documents of a source are dealt by hash into leaves of about LEAF units, every leaf leaves one
undecided unit, and a reduction tree joins FAN leaves a level until one unit of the source remains,
which goes to the nearer side. All chances are hashes of ids, so a rerun decides alike, however the
rows are partitioned. No text moves.

Defined cases: a null or blank text has size 0 and is never taken; rows that agree in id, source
and size are one unit, taken equally often; a null source is one source, last in code point order;
sources without words have target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetmill.llm.common import WORD, pack, stored, unpack
from packetmill.operators.joins import join_summary

WEIGHTS = (5, 2, 1)
MOST = 3.0
LEAF = 256
FAN = 64

_UNIT = "key string, leaf long, id long, size long, unit long, words double, p double"


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as the sources do by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def size_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id``, ``key`` of the source, ``size`` in words, and the input's columns as ``row``."""
    return pack(docs, id_col, text_col).select(
        "id", source_key(F.col("row").getField(source_col)).alias("key"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), "row")


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """Add ``target`` to rows of ``key``, ``source_size``, ``n``, one per source.

    Weights repeat in the order of the keys. The rank is counted in sorted ranges, so no task sees
    all sources; resharing is one aggregate a round, of which only sums reach the driver.
    """
    dealt = stored(sources.repartitionByRange(F.col("key")).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("part").count().select(  # one row per range
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    at = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    place = F.pmod(F.col("at") + F.col("offset") - 1, F.lit(len(weights))).cast("int") + 1
    ranked = dealt.withColumn("at", at).join(offsets, "part").select(
        "key", "source_size", "n", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight"))
    ranked = stored(ranked.filter("source_size > 0"), "weights")

    limit, level, full = F.col("source_size") * most, -1.0, -1  # level: words per unit of weight
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        capped = limit <= F.col("weight") * F.lit(level)
        n, held, free = ranked.agg(
            F.count(F.when(capped, 1)), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))).first()
        if n == full or not free:
            break
        full, level = n, (total - (held or 0.0)) / free
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def _chance(units: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on the unit and the level only."""
    x = units.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % 2**64)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivot(words, p, luck, last: bool) -> np.ndarray:
    """Settle all of the probabilities ``p`` but one, at the last level that one too.

    ``words @ p`` stays as it was, but for the very last settlement.
    """
    p = np.array(p, np.float64)
    j = -1  # the undecided unit that goes on
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if j < 0:
            j = i
            continue
        room_j, room_i = (1 - p[j]) * words[j], (1 - p[i]) * words[i]
        mass_j, mass_i = p[j] * words[j], p[i] * words[i]
        up, down = min(room_j, mass_i), min(mass_j, room_i)  # what j may gain from i, or lose to it
        if luck[i] * (up + down) < down:  # in proportion, so that no probability drifts
            new_j = 1.0 if room_j <= mass_i else p[j] + up / words[j]
            new_i = 0.0 if mass_i <= room_j else p[i] - up / words[i]
        else:
            new_j = 0.0 if mass_j <= room_i else p[j] - down / words[j]
            new_i = 1.0 if room_i <= mass_j else p[i] + down / words[i]
        p[j], p[i] = new_j, new_i
        j = j if 0.0 < new_j < 1.0 else (i if 0.0 < new_i < 1.0 else -1)
    if last and j >= 0:
        p[j] = float(p[j] >= 0.5)
    return p


def _pivot_group(level: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        # Long documents first: what is left over at the end is then likely short.
        group = group.sort_by([("words", "descending"), ("unit", "ascending"), ("id", "ascending")])
        words, unit = group.column("words").to_numpy(), group.column("unit").to_numpy()
        p = pivot(words, group.column("p").to_numpy(), _chance(unit, level), last)
        return group.set_column(group.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


def _settle(units: DataFrame, leaves: int) -> DataFrame:
    """``(key, id, size, p)`` with p 0 or 1 of undecided units, through a tree over their leaves."""
    settled, level, done = None, 0, False
    while not done:
        done = leaves <= 1
        out = stored(units.groupBy("key", "leaf").applyInArrow(_pivot_group(level, done), _UNIT), "pivot")
        whole = out.filter((F.col("p") <= 0) | (F.col("p") >= 1)).select("key", "id", "size", "p")
        settled = whole if settled is None else settled.unionByName(whole)
        units = out.filter((F.col("p") > 0) & (F.col("p") < 1)).withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("long"))
        leaves, level = math.ceil(leaves / FAN), level + 1
    return settled


def copies(sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """From rows ``id``, ``key``, ``size``: the sources' facts, and the settled units.

    Facts: ``key``, ``source_size``, ``target``, ``whole`` (times that all documents are taken).
    Units: ``key``, ``id``, ``size``, ``p`` (1: taken once more).
    """
    per_source = stored(sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sizes")
    rate = F.least(F.col("target") / F.col("source_size"), F.lit(most))
    facts = stored(source_targets(per_source, weights, most).select(
        "key", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p"),
        F.ceil(F.col("n") / leaf).alias("leaves")), "facts")
    units = sized.filter("size > 0").groupBy("key", "id", "size").agg(F.count(F.lit(1)).alias("m"))
    units = join_summary(units, facts.filter("p > 0").select("key", "p", "leaves"), ["key"], "inner")
    units = units.withColumn("unit", F.xxhash64("key", "id", "size")).select(
        "key", F.pmod("unit", "leaves").alias("leaf"), "id", "size", "unit",
        (F.col("size") * F.col("m")).cast("double").alias("words"), "p")
    leaves = facts.agg(F.max("leaves")).first()[0] or 1
    return facts.select("key", "source_size", "target", "whole"), _settle(units, leaves)


def with_copies(rows: DataFrame, facts: DataFrame, units: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows of ``id``, ``key``, ``size``."""
    once_more = units.filter("p >= 1").select(
        F.col("key").alias("u_key"), F.col("id").alias("u_id"), F.col("size").alias("u_size"), F.lit(1).alias("more"))
    same = (F.col("key") == F.col("u_key")) & F.col("id").eqNullSafe(F.col("u_id")) & (F.col("size") == F.col("u_size"))
    rows = rows.join(once_more, same, "left").drop("u_key", "u_id", "u_size")
    rows = join_summary(rows, facts, ["key"], "left")
    taken = F.when(F.col("size") > 0, F.coalesce("whole", F.lit(0)) + F.coalesce("more", F.lit(0))).otherwise(0)
    return rows.withColumns({
        "source_size": F.coalesce("source_size", F.lit(0)).cast("long"), "target": F.coalesce("target", F.lit(0.0)),
        "copies": taken.cast("long")}).drop("whole", "more")


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row its id, ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes."""
    sized = stored(size_rows(docs, id_col, text_col, source_col).drop("row"), "sized")
    return with_copies(sized, *copies(sized)).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every input row as often as it is taken, at most three times."""
    rows = size_rows(docs, id_col, text_col, source_col)
    taken = with_copies(rows, *copies(stored(rows.drop("row"), "sized")))
    again = taken.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies")))).filter("copy > 0")
    return unpack(again)
