"""Hard-negative mining by L2AP-style threshold joins.

For every anchor: its positives, the best other rows of its label, and for every positive the best
rows of other labels whose score lies between a share of the positive's score and that score.

Both are threshold joins, "all pairs with a score of at least theta", made in groups of a shard of
vectors and a block of anchors:

1. *Index.* Dimensions are ordered by how much they carry. A vector is indexed up to the dimension
   from which the norms of what is left, its own times an anchor's, can no longer reach any theta
   of the group by themselves; the dimensions from there on are omitted.
2. *Accumulation.* Partial scores grow by blocks of indexed dimensions; now and then all pairs whose
   partial score plus the product of the remaining norms misses theta are dropped. Once few are
   left, those are finished one by one: this is the verification, on the omitted dimensions too.
3. *Lowering.* Theta starts high and is lowered until an anchor's windows are full or nothing lower
   could count. The first shard of a group is searched so; the others start from the scores at which
   the windows filled there, which no smaller score can undercut, so most of them report little.

Scores are exact: components are whole numbers, floor(256 * x), and sums stay below 2^53, or are
made of Python integers where they may not. Scores beyond the range of long are cut to it.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part;
vectors meet only those of their own length; rows that repeat an id are rows of their own, also as
positives of each other and as anchors; a row without an id is no anchor and comes after others of
equal score; an anchor without positives, or a positive with a score below zero, has no rows; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetmill.llm.common import stored
from packetmill.operators.joins import join_summary

SCALE = 256
SHARD = 4096   # vectors
BLOCK = 1024   # anchors
WIDTH = 8      # dimensions accumulated at once
SPARSE = 0.02  # share of pairs from which on they are finished one by one
PAIRS = 1 << 16
EXACT = float(1 << 53)
STEPS = (0.25, 0.5, 0.75, 1.0)  # of the way from the highest possible score down to the lowest wanted


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, where doubles would not hold them."""
    return np.clip(q.astype(object) @ x.astype(object).T, -2**63, 2**63 - 1).astype(np.int64)


class ShardIndex:
    """A shard's vectors with their dimensions in order of weight, and the norms of what is left of them."""

    def __init__(self, vectors: np.ndarray):
        self.plain = vectors
        self.order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(0), kind="stable")
        self.x = vectors[:, self.order].astype(np.float64)
        self.left = self.norms_left(self.x)

    @staticmethod
    def norms_left(x: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from the start of each block on; zero after the last."""
        starts = range(0, x.shape[1], WIDTH)
        blocks = [(x[:, a:a + WIDTH] ** 2).sum(1) for a in starts] + [np.zeros(len(x))]
        return np.sqrt(np.cumsum(np.stack(blocks[::-1], 1), 1)[:, ::-1])

    def pairs(self, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query, vector, score`` of all pairs whose score is at least the query's ``least``."""
        if not len(queries) or not len(self.x):
            return (np.zeros(0, np.int64),) * 3
        if np.abs(queries).max(initial=0) * np.abs(self.plain).max(initial=0) * max(1, self.x.shape[1]) >= EXACT:
            scores = exact_scores(queries, self.plain)
            row, column = np.nonzero(scores.astype(np.float64) >= least[:, None])
            return row, column, scores[row, column]
        q = queries[:, self.order]
        q_left = self.norms_left(q)
        n_blocks = q_left.shape[1] - 1
        # Rounding of norms must not drop a pair: the bounds get a little slack.
        slack = 1e-9 * q_left[:, :1] * self.left[:, 0].max() + 1e-6
        with np.errstate(divide="ignore"):
            reach = ((least[:, None] - slack) / q_left).min(0)  # below it, what is left of a vector reaches no theta
        omitted_from = np.where(self.left < reach, np.arange(n_blocks + 1), n_blocks).min(1)
        by_length = np.argsort(-omitted_from, kind="stable")
        x, x_left, end = self.x[by_length], self.left[by_length], omitted_from[by_length]
        scores = np.zeros((len(q), len(x)))
        checks = {max(1, n_blocks * k // 4) for k in (1, 2, 3)} | {n_blocks}
        row = column = done = None
        for b in range(n_blocks):
            indexed = int(np.searchsorted(-end, -b, side="left"))  # those whose end lies beyond b
            dims = slice(b * WIDTH, (b + 1) * WIDTH)
            scores[:, :indexed] += q[:, dims] @ x[:indexed, dims].T
            if b + 1 in checks:
                done = np.minimum(end, b + 1)
                bound = q_left[:, done] * x_left[np.arange(len(x)), done][None, :]
                live = scores + bound >= least[:, None] - slack
                if b + 1 == n_blocks or np.count_nonzero(live) <= SPARSE * live.size:
                    row, column = np.nonzero(live)
                    break
        if row is None:  # vectors of no dimension: all scores are zero
            row, column = np.nonzero(scores >= least[:, None])
            return row, by_length[column], np.zeros(len(row), np.int64)
        found = scores[row, column]
        for at in np.unique(done[column]):
            mine = np.flatnonzero(done[column] == at)
            for a in range(0, len(mine), PAIRS):
                some = mine[a:a + PAIRS]
                found[some] += np.einsum("ij,ij->i", q[row[some], at * WIDTH:], x[column[some], at * WIDTH:])
        good = found >= least[row]
        return row[good], by_length[column[good]], found[good].astype(np.int64)

    def highest(self, queries: np.ndarray) -> np.ndarray:
        """What no score of a query exceeds."""
        return np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * self.left[:, 0].max(initial=0) * (1 + 1e-9) + 1


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    lists = table.column(column).combine_chunks()
    flat = lists.flatten() if isinstance(lists, pa.Array) else pa.concat_arrays([c.flatten() for c in lists.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, len(flat) // max(1, table.num_rows))


def _numbers(table: pa.Table, column: str, null) -> np.ndarray:
    return np.array([null if x is None else x for x in table.column(column).to_pylist()])


def best(query: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: highest scores, then least ``order``."""
    place = np.lexsort((order, -score, query))
    sorted_query = query[place]
    return place[np.arange(len(place)) - np.searchsorted(sorted_query, sorted_query) < k]


def _by_id(ids: list) -> np.ndarray:
    """Ranks of ids, null last."""
    rank = {x: i for i, x in enumerate(sorted(set(ids) - {None}))}
    return np.array([rank.get(x, len(rank)) for x in ids], np.int64)


def _positives_of(k: int):
    """The k best rows of a shard for each anchor of a block, other than itself."""

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        names, out = ["anchor_no", "row_no", "id", "score"], []
        if shard.num_rows and block.num_rows:
            index, queries = ShardIndex(_matrix(shard, "v")), _matrix(block, "q_v")
            row_no, own = shard.column("row_no").to_numpy(), block.column("q_row_no").to_numpy()
            order, ids = _by_id(shard.column("id").to_pylist()), shard.column("id").combine_chunks()
            known = _numbers(block, "q_least", -math.inf).astype(np.float64)
            high = index.highest(queries)
            lowest = np.where(np.isfinite(known), known, -high)
            todo = np.arange(len(queries))
            for step in STEPS:
                # A score that other shards have reached is the lowest of use, and is tried at once.
                theta = np.where(np.isfinite(known), known, high - (high - lowest) * step)[todo]
                q, x, score = index.pairs(queries[todo], theta)
                others = row_no[x] != own[todo[q]]
                q, x, score = todo[q[others]], x[others], score[others]
                full = np.isfinite(known[todo]) | (np.bincount(q, minlength=len(queries))[todo] >= k) | (step == 1.0)
                q_full = np.isin(q, todo[full])
                q, x, score = q[q_full], x[q_full], score[q_full]
                top = best(q, score, order[x], k)
                out.append(pa.table([pa.array(own[q[top]]), pa.array(row_no[x[top]]), ids.take(pa.array(x[top])), pa.array(score[top])], names))
                todo = todo[~full]
        empty = pa.table([pa.array([], pa.int64())] * 4, names)
        return pa.concat_tables(out) if out else empty

    return run


def _negatives_of(k: int):
    """Per anchor and window the k best rows of a shard that have another label."""

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        names, out = ["anchor_no", "window", "id", "score"], []
        if shard.num_rows and block.num_rows:
            index, queries = ShardIndex(_matrix(shard, "v")), _matrix(block, "q_v")
            own, label = block.column("q_row_no").to_numpy(), shard.column("label").to_numpy()
            own_label = block.column("q_label").to_numpy()
            order, ids = _by_id(shard.column("id").to_pylist()), shard.column("id").combine_chunks()
            windows = block.column("q_windows").to_pylist()
            lowest = np.array([min(w["least"] for w in ws) for ws in windows], np.float64)
            high = np.minimum(np.array([max(w["high"] for w in ws) for ws in windows], np.float64), index.highest(queries))
            todo = np.flatnonzero(lowest <= high)
            tried = [[not w["first"] for w in ws] for ws in windows]  # windows that other shards have filled start low
            for step in STEPS:
                start = np.array([all(t) for t in tried])[todo]
                theta = np.where(start, lowest[todo], np.floor(high[todo] - (high[todo] - lowest[todo]) * step))
                q, x, score = index.pairs(queries[todo], theta)
                other = label[x] != own_label[todo[q]]
                q, x, score = q[other], x[other], score[other]
                bounds = np.searchsorted(q, np.arange(len(todo) + 1))
                waiting = []
                for n, i in enumerate(todo):
                    mine = slice(bounds[n], bounds[n + 1])
                    s, found, full = score[mine], [], True
                    for w in windows[i]:
                        inside = np.flatnonzero((s <= w["high"]) & (s >= w["least"]))
                        full &= len(inside) >= k or theta[n] <= w["least"]
                        found.append(inside)
                    if not full and step < 1.0:
                        waiting.append(i)
                        continue
                    for w, inside in zip(windows[i], found):
                        at = x[mine][inside]
                        top = best(np.zeros(len(at), np.int64), s[inside], order[at], k)
                        out.append(pa.table([
                            pa.array(np.full(len(top), own[i])), pa.array(np.full(len(top), w["window"], np.int64)),
                            ids.take(pa.array(at[top])), pa.array(s[inside][top])], names))
                todo = np.array(waiting, np.int64)
        empty = pa.table([pa.array([], pa.int64())] * 4, names)
        return pa.concat_tables(out) if out else empty

    return run


def _dealt(rows: DataFrame, key: Column, shard: int, block: int) -> DataFrame:
    """Rows with the ``key`` of those that may meet, and their ``shard`` and ``block`` among them."""
    keyed = rows.withColumn("key", key)
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("a"))
    sizes = sizes.select(
        "key", F.ceil(F.col("n") / shard).cast("int").alias("shards"),
        F.greatest(F.ceil(F.col("a") / block), F.lit(1)).cast("int").alias("blocks"))
    h = F.xxhash64("row_no")
    return join_summary(keyed, sizes, ["key"], "inner").withColumn("shard", F.pmod(h, F.col("shards")).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64(h, F.lit(1)), F.col("blocks")).cast("int"))


def _meet(rows: DataFrame, asked: DataFrame, first: bool, search, schema: str) -> DataFrame:
    """Search the first shard of every key, or all others, for the anchors in ``asked``."""
    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    here = (F.col("shard") == 0) if first else (F.col("shard") > 0)
    left = rows.filter(here).withColumn("block", F.explode(blocks)).select("key", "shard", "block", "row_no", "id", "label", "v")
    where = F.array(F.lit(0)) if first else F.sequence(F.lit(1), F.col("shards") - 1)
    right = asked if first else asked.filter("shards > 1")
    right = right.withColumn("shard", F.explode(where)).drop("shards", "blocks")
    right = right.select(*[F.col(c).alias(f"q_{c}") for c in right.columns])  # both sides stem from one table
    keys = ["key", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"q_{k}" for k in keys])).applyInArrow(search, schema)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(table: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, low_percent: int = 80, scale: int = SCALE,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` tells anchors from their id; ``label`` is the column to go by, ``label`` unless given.
    A negative's score is at most its positive's, and at least ``low_percent`` percent of it.
    """
    x = F.col(f"`{vector_col}`")
    label = F.col("label") if label is None else label
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf))
    rows = table.filter(usable & label.isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    rows = stored(rows.withColumn("row_no", F.monotonically_increasing_id()).withColumn(
        "anchor", F.coalesce(is_anchor(F.col("id")), F.lit(False))), "labelled-vectors")

    # Positives: anchors meet the rows of their own label.
    dealt = stored(_dealt(rows, F.concat_ws(":", F.size("v"), F.col("label")), shard, block), "by-label")
    asked = dealt.filter("anchor").select("key", "shards", "blocks", "block", "row_no", "v")
    schema = "anchor_no long, row_no long, id long, score long"
    found = stored(_meet(dealt, asked.withColumn("least", F.lit(None).cast("long")), True, _positives_of(positives), schema), "near-1")
    reached = found.groupBy(F.col("anchor_no").alias("row_no")).agg(F.min("score").alias("least"), F.count("*").alias("n"))
    asked = asked.join(reached.filter(F.col("n") >= positives).drop("n"), "row_no", "left")
    found = found.union(_meet(dealt, asked, False, _positives_of(positives), schema))
    pairs = stored(_ranked(found, ["anchor_no"], positives).select(
        "anchor_no", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Negatives: anchors meet all rows, and look into one window per positive.
    low = F.ceil(F.col("positive_score").cast("decimal(38,0)") * low_percent / 100).cast("long")
    open_windows = pairs.filter("positive_score >= 0").select("anchor_no", "window", F.col("positive_score").alias("high"), low.alias("low"))
    dealt = stored(_dealt(rows, F.size("v").cast("string"), shard, block), "by-length")
    anchors = dealt.filter("anchor").select("key", "shards", "blocks", "block", "row_no", "label", "v")

    def asking(windows: DataFrame) -> DataFrame:
        each = F.struct("window", "high", "least", "first")
        listed = windows.groupBy(F.col("anchor_no").alias("row_no")).agg(F.sort_array(F.collect_list(each)).alias("windows"))
        return anchors.join(listed, "row_no")

    schema = "anchor_no long, window long, id long, score long"
    first = open_windows.withColumn("least", F.col("low")).withColumn("first", F.lit(True))
    found = stored(_meet(dealt, asking(first), True, _negatives_of(negatives), schema), "negatives-1")
    reached = found.groupBy("anchor_no", "window").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    later = open_windows.join(reached.filter(F.col("n") >= negatives).drop("n"), ["anchor_no", "window"], "left")
    later = later.withColumn("least", F.coalesce("worst", "low")).withColumn("first", F.col("worst").isNull())
    found = found.union(_meet(dealt, asking(later), False, _negatives_of(negatives), schema))
    top = _ranked(found, ["anchor_no", "window"], negatives)
    ids = rows.filter("anchor").select(F.col("row_no").alias("anchor_no"), F.col("id").alias("anchor_id"))
    return top.join(pairs, ["anchor_no", "window"]).join(ids, "anchor_no").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
