"""Exact top-k inner-product search with ball trees.

The vectors are dealt by a hash of their stored row number into shards of about
``SHARD_ROWS`` rows, so rows that repeat a vec_id spread over all shards; the
queries are dealt by a hash of id and vector into blocks of about
``BLOCK_QUERIES``.  (shard, block) pairs meet by an equi-join key and are
searched independently.  In each shard a ball tree (centre, radius, smallest
id of every node) is built; a node's best possible score for a query is
``q . centre + |q| * radius``.  Search is branch and bound: nodes are opened
from the top while their bound beats the query's current k-th score, leaves are
visited in order of their bounds, and each visit can raise the k-th score.

The k-th score is shared between shards: every query first searches the shard
that holds itself, and carries that k-th (score, id) as the starting bound to
all other shards, where only better candidates are kept.  A small window over
the survivors makes the final ranks.

Scores are exact integers: products are summed in float32, float64 or Python
integers, whichever holds the largest possible sum exactly; a score beyond 64
bits is saturated.

Cases: vectors that are null, or hold a null or non-finite component, and rows
without vec_id take no part; vectors of unequal length are padded with zeros;
rows that repeat a query's vec_id are its own and no candidates for it (a query
id with several vectors asks with each), other repeats are candidates each; equal scores rank by smaller vec_id; fewer than k
candidates give fewer rows; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, store

TOP_K, SCALE = 20, 64
SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 65536, 16384, 128  # dealt by hash: expected sizes, see _ID_BITS
SMALL_SHARD = 4096  # shards are not cut smaller than this for parallelism
RESULT = "query_id long, vec_id long, score long"
_LOWEST = np.iinfo(np.int64).min
_ID_BITS = 17  # holds a shard's row number; twice SHARD_ROWS, a larger shard is an error


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the components as floor(scale * x)."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    col = column.combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) and col.num_chunks else col
    n = len(column)
    if not n:
        return np.zeros((0, width), np.int64)
    sizes = np.asarray(col.value_lengths())
    flat = np.asarray(col.flatten())
    if (sizes == width).all():
        return flat.reshape(n, width)
    out = np.zeros((n, width), np.int64)
    row = np.repeat(np.arange(n), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class BallTree:
    """Nodes of a binary tree over rows sorted by id; children of node i are
    2i+1 and 2i+2, all leaves on the last level."""

    def __init__(self, x: np.ndarray) -> None:
        n = len(x)
        depth = max(0, math.ceil(math.log2(max(1, n / LEAF_ROWS))))
        self.depth, size = depth, (2 << depth) - 1
        self.order = np.arange(n)
        self.start, self.end = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.end[0] = n
        for i in range((1 << depth) - 1):
            a, b = self.start[i], self.end[i]
            rows = self.order[a:b]
            mid = (a + b) // 2
            if b - a > 1:  # along the line between two far-apart points, half to each side
                p = x[rows]
                far = p[((p - p.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                other = p[((p - far) ** 2).sum(axis=1).argmax()]
                self.order[a:b] = rows[np.argsort(p @ (other - far), kind="stable")]
            self.start[2 * i + 1], self.end[2 * i + 1] = a, mid
            self.start[2 * i + 2], self.end[2 * i + 2] = mid, b
        self.centre, self.radius = np.zeros((size, x.shape[1])), np.zeros(size)
        self.first_id = np.full(size, n, np.int64)
        for i in range(size):
            rows = self.order[self.start[i]:self.end[i]]
            if len(rows):
                p = x[rows]
                self.centre[i] = p.mean(axis=0)
                self.radius[i] = np.sqrt(((p - self.centre[i]) ** 2).sum(axis=1).max())
                self.first_id[i] = rows.min()


def _exact_kind(x: np.ndarray, q: np.ndarray):
    """The narrowest number type in which every partial sum is exact."""
    # Python integers: the absolute value of the smallest long is no long
    sizes = [max(int(a.max(initial=0)), -int(a.min(initial=0))) for a in (x, q)]
    top = max(1, x.shape[1]) * sizes[0] * sizes[1]
    if top < 1 << 24:
        return np.float32
    return np.float64 if top < 1 << 45 else object


def search(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bound_score: np.ndarray,
           bound_id: np.ndarray, k: int = TOP_K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of each query's best k rows that beat its bound
    (higher score, or equal score and smaller id)."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    kind = _exact_kind(x, q)
    if kind is object:
        return _search_wide(ids, x, q_ids, q, bound_score, bound_id, k)
    if len(ids) > 1 << _ID_BITS:
        raise ValueError(f"a shard of {len(ids)} rows: a key holds row numbers below {1 << _ID_BITS}")
    n, tie = len(ids), (1 << _ID_BITS) - 1 - np.arange(len(ids))
    tree = BallTree(x.astype(np.float64))
    sorted_x, sorted_id, sorted_tie = x[tree.order].astype(kind), ids[tree.order], tie[tree.order]
    node_tie = (1 << _ID_BITS) - 1 - np.minimum(tree.first_id, n - 1)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    free = bound_score == _LOWEST
    place = np.searchsorted(ids, bound_id)  # beat the bound: key above (score, place - 1)
    floor = np.where(free, _LOWEST, (np.where(free, 0, bound_score) << _ID_BITS) + (1 << _ID_BITS) - 1 - place)

    def best_possible(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        s = q[rows].astype(np.float64) @ tree.centre[nodes].T + norm[rows, None] * tree.radius[nodes]
        s = np.floor(s + 1e-6 * (1 + np.abs(s))).astype(np.int64)
        return np.where(tree.end[nodes] > tree.start[nodes], (s << _ID_BITS) + node_tie[nodes], _LOWEST)

    leaves = np.arange((1 << tree.depth) - 1, (2 << tree.depth) - 1)
    near = np.empty(len(q), np.int64)
    for at in range(0, len(q), 1024):
        near[at:at + 1024] = best_possible(np.arange(at, min(at + 1024, len(q))), leaves).argmax(axis=1)
    top = np.full((len(q), k), _LOWEST)
    alike = np.argsort(near, kind="stable")  # queries of one block prefer the same leaves
    for at in range(0, len(q), 256):
        rows = alike[at:at + 256]
        low = floor[rows].copy()
        held = top[rows]
        alive = np.ones((len(rows), 1), bool)
        for level in range(1, tree.depth + 1):  # open nodes from the top
            nodes = np.arange((1 << level) - 1, (2 << level) - 1)
            alive = np.repeat(alive, 2, axis=1)
            some = np.flatnonzero(alive.any(axis=0))
            ahead = best_possible(rows, nodes[some])
            alive[:, some] &= ahead > low[:, None]
        possible = np.full(alive.shape, _LOWEST)
        some = np.flatnonzero(alive.any(axis=0))
        possible[:, some] = np.where(alive[:, some], best_possible(rows, leaves[some]), _LOWEST)
        first = possible.argmax(axis=1)

        def visit(leaf: int, who: np.ndarray) -> None:
            a, b = tree.start[leaves[leaf]], tree.end[leaves[leaf]]
            s = (q[rows[who]].astype(kind) @ sorted_x[a:b].T).astype(np.int64)
            key = (s << _ID_BITS) + sorted_tie[a:b]
            key = np.where((key > low[who, None]) & (sorted_id[a:b] != q_ids[rows[who], None]), key, _LOWEST)
            hit = np.flatnonzero((key > _LOWEST).any(axis=1))
            if len(hit):
                w = who[hit]
                both = np.concatenate([held[w], key[hit]], axis=1)
                held[w] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                low[w] = np.maximum(low[w], held[w].min(axis=1))

        for leaf in np.unique(first[possible.max(axis=1) > _LOWEST]):  # each query's most promising leaf
            visit(int(leaf), np.flatnonzero((first == leaf) & (possible[:, leaf] > _LOWEST)))
        for leaf in some[np.argsort(-possible[:, some].max(axis=0), kind="stable")]:
            who = np.flatnonzero((possible[:, leaf] > low) & (first != leaf))
            if len(who):
                visit(int(leaf), who)
        top[rows] = held
    row, col = np.nonzero(top > _LOWEST)
    key = top[row, col]
    return row, ids[(1 << _ID_BITS) - 1 - (key & ((1 << _ID_BITS) - 1))], key >> _ID_BITS


def _search_wide(ids, x, q_ids, q, bound_score, bound_id, k):
    """The same answer for components too large for float sums: Python integers."""
    out = ([], [], [])
    wide = x.astype(object)
    for i in range(len(q)):
        s = wide @ q[i].astype(object)
        mine = [(-min(max(int(v), _LOWEST + 1), (1 << 63) - 1), int(d)) for v, d in zip(s, ids) if d != q_ids[i]]
        limit = (-int(bound_score[i]), int(bound_id[i])) if bound_score[i] != _LOWEST else None
        for neg, d in sorted(m for m in mine if limit is None or m < limit)[:k]:
            out[0].append(i)
            out[1].append(d)
            out[2].append(-neg)
    return tuple(np.array(o, np.int64) for o in out)


def _searcher(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not vectors.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        width = max(max(np.asarray(t.column("v").combine_chunks().value_lengths()).max(initial=0) for t in (vectors, queries)), 1)
        q_ids = queries.column("query_id").to_numpy()
        row, vec, score = search(
            vectors.column("vec_id").to_numpy(), _matrix(vectors.column("v"), width), q_ids,
            _matrix(queries.column("v"), width), queries.column("low").fill_null(_LOWEST).to_numpy(),
            queries.column("low_id").fill_null(0).to_numpy(), k)
        return pa.table([pa.array(q_ids[row], pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.int64())], names=names)

    return run


def top_k(vectors: DataFrame, is_query, k: int = TOP_K) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of every row
    of ``vectors`` (vec_id, embedding) for which ``is_query`` (a Column) holds."""
    spark = vectors.sparkSession
    ship(spark)
    ready = store(quantised(vectors).withColumn("n", F.monotonically_increasing_id()), "topk-vectors")
    count = ready.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, math.ceil(count[0] / SHARD_ROWS), min(math.ceil(count[0] / SMALL_SHARD), tasks))
    blocks = max(1, math.ceil(count[1] / BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("n"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", "v", F.lit(1)), F.lit(blocks)).cast("int")
    rows = ready.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    none = F.lit(None).cast("long")
    ask = ready.filter(is_query).groupBy("vec_id", "v").agg(F.min("n").alias("n")).select(
        shard.alias("home"), F.col("vec_id").alias("query_id"), "v", none.alias("low"), none.alias("low_id")).withColumn("block", block)
    keys = ["shard", "block"]

    def search_in(asked: DataFrame) -> DataFrame:
        asked = asked.select(*[F.col(c).alias(c) for c in (*keys, "query_id", "v", "low", "low_id")])  # columns of its own
        return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_searcher(k), RESULT)

    home = store(search_in(ask.withColumn("shard", F.col("home"))), "topk-home")
    if shards == 1:
        found = home
    else:
        order = [F.desc("score"), F.asc("vec_id")]
        last = home.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("r") == k)
        known = ask.drop("low", "low_id").join(
            last.select("query_id", F.col("score").alias("low"), F.col("vec_id").alias("low_id")), "query_id", "left")
        other = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
        found = home.unionByName(search_in(known.withColumn("shard", F.explode(other))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
