"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors become whole numbers, floor(64 * x), and are dealt by hash into shards of about SHARD
vectors; every shard meets every block of about BLOCK queries once. There a ball tree is built over
the shard: a node's inner product with a query q is at most ``q . centre + |q| * radius``. All
queries of the block walk the tree together, always into the node with the highest bound; a query
leaves a node whose bound lies below its kth best score so far, and a node without queries is not
opened. The first shard is searched first, and the kth scores found there are what the other shards
start from, so most of these report little. The best of all shards are ranked in the end.

Defined cases: vectors that are null or hold a null, a NaN or an infinity take no part; vectors
meet only those of their own length; rows that repeat an id are rows of their own, as candidates and
as queries, but none is a candidate of a query with its own id; rows without an id are candidates, ranked after others of equal score;
scores beyond the range of long are cut to it.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetmill.llm.common import stored

SCALE = 64
SHARD = 4096
BLOCK = 2048
LEAF = 128
EXACT = float(1 << 53)


class BallTree:
    """Nodes as arrays; ``order[start:end]`` are a node's vectors, children of -1 mark leaves."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.start, self.end, self.left, self.right, self.centre, self.radius = [], [], [], [], [], []
        todo = [(0, len(vectors), -1, False)]
        while todo:
            a, b, parent, is_right = todo.pop()
            node = len(self.start)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            mine = vectors[self.order[a:b]]
            centre = mine.mean(0)
            away = np.sqrt(((mine - centre) ** 2).sum(1))
            for held, value in ((self.start, a), (self.end, b), (self.left, -1), (self.right, -1), (self.centre, centre), (self.radius, away.max())):
                held.append(value)
            if b - a > leaf and away.max() > 0:
                # Two far ends; half of the vectors go with each.
                one = mine[away.argmax()]
                other = mine[((mine - one) ** 2).sum(1).argmax()]
                self.order[a:b] = self.order[a:b][np.argsort(mine @ (other - one), kind="stable")]
                todo += [(a, (a + b) // 2, node, False), ((a + b) // 2, b, node, True)]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64."""
    largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if largest < EXACT:
        return (q @ x.T).astype(np.int64)
    exact = q.astype(object) @ x.T.astype(object)
    return np.clip(exact, -2**63, 2**63 - 1).astype(np.int64)


def search(tree: BallTree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int):
    """``query, id, score`` of the k best of each query that reach the score ``least``.

    ``ids`` and ``own`` are numbers, the smaller first among equal scores; a query's own is skipped.
    """
    best = np.tile(least[:, None].astype(np.float64), (1, k))  # the k best scores, in no order
    kth = best.min(1)
    norms = np.sqrt((queries ** 2).sum(1))
    found = []

    def bounds(node: int, some: np.ndarray) -> np.ndarray:
        centre, radius = tree.centre[node], tree.radius[node]
        slack = 1e-9 * norms[some] * (np.sqrt(centre @ centre) + radius) + 1e-6
        return queries[some] @ centre + norms[some] * radius + slack

    every = np.arange(len(queries))
    heap = [(-math.inf, 0, every, bounds(0, every))] if len(vectors) and len(queries) else []
    while heap:
        _, node, some, bound = heapq.heappop(heap)
        some = some[bound >= kth[some]]
        if not len(some):
            continue
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                bound = bounds(child, some)
                live = bound >= kth[some]
                if live.any():
                    heapq.heappush(heap, (-float(bound[live].max()), child, some[live], bound[live]))
            continue
        mine = tree.order[tree.start[node]:tree.end[node]]
        scores = products(queries[some], vectors[mine])
        good = (scores >= kth[some][:, None]) & (ids[mine][None, :] != own[some][:, None])
        rows, columns = np.nonzero(good)
        found.append((some[rows], ids[mine][columns], scores[rows, columns]))
        both = np.concatenate([best[some], np.where(good, scores, -np.inf)], axis=1)
        best[some] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        kth[some] = best[some].min(1)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    query, number, score = (np.concatenate(x) for x in zip(*found))
    keep = score >= kth[query]
    query, number, score = query[keep], number[keep], score[keep]
    order = np.lexsort((number, -score.astype(np.float64), query)) if np.abs(score).max(initial=0) < EXACT else np.array(
        sorted(range(len(score)), key=lambda i: (query[i], -int(score[i]), number[i])), np.int64)
    query, number, score = query[order], number[order], score[order]
    first = np.searchsorted(query, query)
    top = np.arange(len(query)) - first < k
    return query[top], number[top], score[top]


def _vectors(group: pa.Table, column: str) -> np.ndarray:
    flat = group.column(column).combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(group.num_rows, -1 if group.num_rows and len(flat) else 0)


def _search_group(k: int):
    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = {"query_no": [], "query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and block.num_rows:
            vectors, queries = _vectors(shard, "v"), _vectors(block, "q")
            ids, own = shard.column("id").to_pylist(), block.column("query_id").to_pylist()
            # Ids become their ranks, null last, so that plain numbers order and tell them apart.
            rank = {x: i for i, x in enumerate(sorted({*ids, *own} - {None}))} | {None: len(ids) + len(own)}
            name = {i: x for x, i in rank.items()}
            least = np.array([-math.inf if x is None else x for x in block.column("least").to_pylist()])
            found = search(
                BallTree(vectors), vectors, np.array([rank[x] for x in ids]), queries,
                np.array([rank[x] for x in own]), least, k)
            numbers = block.column("query_no").to_pylist()
            for q, i, s in zip(*(x.tolist() for x in found)):
                out["query_no"].append(numbers[q])
                out["query_id"].append(own[q])
                out["vec_id"].append(name[i])
                out["score"].append(s)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def _search_shards(vectors: DataFrame, queries: DataFrame, shards: list, n_blocks: int, k: int) -> DataFrame:
    """Search the given range of shards with all queries, from their ``least`` scores on."""
    first, last = shards
    blocks = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    left = vectors.filter(F.col("shard").between(first, last)).select("length", "shard", F.explode(blocks).alias("block"), "id", "v")
    right = queries.select(
        "length", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shard"), "block", "query_no", "query_id", "q", "least")
    keys = ["length", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _search_group(k), "query_no long, query_id long, vec_id long, score long")


def top_k(table: DataFrame, k: int, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
          shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` its k best others."""
    x = F.col(vector_col)
    plain = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf))
    rows = table.filter(x.isNotNull() & plain).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))
    rows = stored(rows.withColumn("row_no", F.monotonically_increasing_id()), "vectors")
    asked = rows.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("row_no").alias("query_no"))
    n, n_queries = rows.count(), asked.count()
    n_shards, n_blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(n_queries / block))
    shard_no = F.pmod(F.xxhash64("row_no"), F.lit(n_shards)).cast("int")
    vectors = rows.select(F.size("v").alias("length"), shard_no.alias("shard"), "id", "v")
    block_no = F.pmod(F.xxhash64("query_no", F.lit(1)), F.lit(n_blocks)).cast("int")
    queries = asked.select(F.size("q").alias("length"), block_no.alias("block"), "query_no", "query_id", "q")
    found = stored(_search_shards(vectors, queries.withColumn("least", F.lit(None).cast("long")), (0, 0), n_blocks, k), "first-shard")
    if n_shards > 1:
        reached = found.groupBy("query_no").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        reached = reached.filter(F.col("n") == k).select("query_no", "least")
        rest = _search_shards(vectors, queries.join(reached, "query_no", "left"), (1, n_shards - 1), n_blocks, k)
        found = found.union(rest)
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
