"""Connected components of a graph given as a table of edges, by alternating large and small stars."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetmill.llm.common import stored
from packetmill.operators.joins import join_summary

CHUNK = 500_000


def _toward_least(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return join_summary(both, least, ["a"], "inner").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _flatten(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = join_summary(down, least, ["a"], "inner").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars: each of its nodes and the least node it is connected to."""
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up] = root.get(root[up], root[up])
            x = up
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = [x for x in root if find(x) != x]
    for at in range(0, len(nodes), 1 << 16):
        part = nodes[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([find(x) for x in part], pa.string())], ["a", "b"])


def _all_stars(edges: DataFrame) -> bool:
    """Whether no centre of a star hangs on another star, and no node on two."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return seen.filter("leaf > 1 or (leaf > 0 and centre > 0)").isEmpty()


def connected(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``node, root`` of every node of an edge table with string columns ``a`` and ``b``.

    The root is the least node of the component. The edges are first contracted where they lie, in
    chunks of about ``chunk`` edges that fit a task's memory; if there is more than one chunk, star
    rounds follow until only stars are left. Each round is written out, so none is computed twice,
    and their number grows with the logarithm of the longest path.
    """
    edges = stored(edges.filter("a <> b").select("a", "b"), "edges")
    chunks = max(1, math.ceil(edges.count() / chunk))
    while True:
        edges = stored(edges.coalesce(chunks).mapInArrow(_contract, "a string, b string"), "stars")
        if chunks == 1 or _all_stars(edges):
            break
        edges = stored(_flatten(_toward_least(edges.distinct()).distinct()).filter("a <> b").distinct(), "stars")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
