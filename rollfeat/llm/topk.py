"""Exact top-k search by integer inner product, with a ball tree per shard.

Each component ``x`` becomes ``floor(64 * x)``. Candidates are dealt to shards of about ``SHARD`` vectors, queries to blocks of about
``BLOCK``; every block meets every shard, as a stated query set against all rows does. In a shard, vectors are halved along
the direction between two far points until ``LEAF`` are left; a ball around each node bounds the inner product of a
query with anything in it by ``q . centre + |q| * radius``. Leaves are visited in the order of that bound and a node is skipped if its bound
is below the query's kth score so far.

The kth score is shared between shards: each block first meets one shard, and what it finds there bounds it in all
others.

Vectors that are null, or hold a null or non-finite component, take no part. Vectors of different length do not meet. Rows
without ``vec_id`` take no part; rows that repeat one are candidates of their own, and a query meets none of its own id.
Scores are exact: doubles where they are surely so, whole numbers of any size otherwise; a score beyond 64 bits is the nearest
that fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD = 1024
BLOCK = 512
LEAF = 64
SCALE = 64

_EXACT = float(1 << 52)
_LONG = (1 << 63) - 1


def scaled(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, dim, vector)`` of the rows that take part; vectors hold whole numbers, as doubles."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
    # FLOOR of a double is a long in Spark; the decimal places are dropped by hand, so that large ones stay doubles.
    whole = F.transform(x, lambda v: F.rint(v * SCALE - 0.5 + F.when(F.rint(v * SCALE) == v * SCALE, 0.5).otherwise(0.0)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.size(x).alias("dim"), whole.alias("vector"))


class BallTree:
    """Nodes in depth-first order over rows that are put in the order of the leaves."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._split(points, 0, len(points))
        self.points = points[self.order]
        centres = [self.points[a:b].mean(0) for a, b in self.spans]
        self.centres = np.array(centres).reshape(len(centres), points.shape[1])
        self.radii = np.array([np.sqrt(((self.points[a:b] - c) ** 2).sum(1).max()) for (a, b), c in zip(self.spans, centres)])

    def _split(self, points: np.ndarray, a: int, b: int) -> int:
        node = len(self.spans)
        self.spans.append((a, b))
        self.children.append(None)
        if b - a > LEAF:
            own = points[self.order[a:b]]
            far = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            along = np.argsort(own @ (other - far), kind="stable")
            self.order[a:b] = self.order[a:b][along]
            middle = (a + b) // 2
            self.children[node] = (self._split(points, a, middle), self._split(points, middle, b))
        return node

    def leaves(self, queries: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf nodes, and their bound for each query; minus infinity where a node above is below the floor."""
        norms = np.sqrt((queries**2).sum(1))
        bounds = queries @ self.centres.T + norms[:, None] * self.radii[None, :]
        bounds += 1.0 + 1e-9 * np.abs(bounds) + 1e-9 * norms[:, None] * (np.sqrt((self.centres**2).sum(1)) + self.radii)[None, :]
        for node, below in enumerate(self.children):
            if below is not None:
                cut = bounds[:, node] < floor
                for child in below:
                    bounds[:, child] = np.where(cut, -np.inf, np.minimum(bounds[:, child], bounds[:, node]))
        leaves = np.array([i for i, c in enumerate(self.children) if c is None])
        return leaves, bounds[:, leaves]


def search(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, ids and scores that can be among its k best: none below ``floor``, and ties complete as far as they matter."""
    most = max(np.abs(points).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1) * max(points.shape[1], 1)
    if most >= _EXACT:
        return _search_whole(ids, points, query_ids, queries, floor, k)
    tree = BallTree(points)
    ids = ids[tree.order]
    leaves, bounds = tree.leaves(queries, floor)
    visit = np.argsort(-bounds, axis=1, kind="stable")
    floor = floor.copy()
    best = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
    for turn in range(len(leaves)):
        chosen = visit[:, turn]
        alive = np.flatnonzero(bounds[np.arange(len(queries)), chosen] >= floor)
        if not len(alive):
            break
        for leaf in np.unique(chosen[alive]):
            asking = alive[chosen[alive] == leaf]
            a, b = tree.spans[leaves[leaf]]
            scores = queries[asking] @ tree.points[a:b].T
            for q, row in zip(asking.tolist(), scores):
                good = (row >= floor[q]) & (ids[a:b] != query_ids[q])
                if good.any():
                    found, score = np.concatenate((best[q][0], ids[a:b][good])), np.concatenate((best[q][1], row[good]))
                    first = np.lexsort((found, -score))[:k]
                    best[q] = found[first], score[first]
                    if len(first) == k:
                        floor[q] = max(floor[q], score[first[-1]])
    return best


def _search_whole(ids, points, query_ids, queries, floor, k):
    """The same without a tree, in whole numbers of any size."""
    columns = [[int(v) for v in p] for p in points]
    out = []
    for q, query, least in zip(query_ids, queries, floor):
        own = [int(v) for v in query]
        scored = [(max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(own, p)))), int(i)) for p, i in zip(columns, ids) if i != q]
        scored = sorted((-s, i) for s, i in scored)[:k]
        out.append((np.array([i for _, i in scored], np.int64), np.array([-s for s, _ in scored], object)))
    return out


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    lists = table.column(name).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _meet(candidates: pa.Table, queries: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    if not candidates.num_rows or not queries.num_rows:
        return
    query_ids = queries.column("vec_id").to_numpy()
    floor = queries.column("floor").to_numpy().astype(float)
    found = search(candidates.column("vec_id").to_numpy(), _matrix(candidates, "vector"), query_ids, _matrix(queries, "vector"), floor, k)
    for place, (ids, scores) in enumerate(found):
        yield place, ids, scores


def top_k(embeddings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all rows of ``embeddings`` for each row of ``queries``.

    Both have ``vec_id`` and ``embedding``. Ties go to the smaller ``vec_id``; a query that repeats is answered once.
    """
    rows = scaled(embeddings)
    asked = scaled(queries).dropDuplicates(["vec_id"])
    n_rows, n_queries = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // SHARD)), max(1, -(-n_queries // BLOCK))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.hash("vector")), F.lit(shards)).cast("int"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))

    def first(candidates: pa.Table, own: pa.Table) -> pa.Table:
        """The kth score a query finds in one shard."""
        ids, floors = [], []
        asking = own.column("vec_id").to_pylist() if own.num_rows else []
        for place, _, scores in _meet(candidates, own, k):
            if len(scores) == k:
                ids.append(asking[place])
                floors.append(float(scores[-1]) if abs(scores[-1]) < _EXACT else float("-inf"))
        return pa.table([pa.array(ids, pa.int64()), pa.array(floors, pa.float64())], ["vec_id", "floor"])

    def rest(candidates: pa.Table, own: pa.Table) -> pa.Table:
        asking = own.column("vec_id").to_pylist() if own.num_rows else []
        query_ids, ids, scores = [], [], []
        for place, found, score in _meet(candidates, own, k):
            query_ids += [asking[place]] * len(found)
            ids += found.tolist()
            scores += [int(s) for s in score]
        return pa.table([pa.array(query_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["query_id", "vec_id", "score"])

    lowest = F.lit(float("-inf"))
    home = asked.withColumn("shard", F.pmod("block", F.lit(shards)).cast("int")).withColumn("floor", lowest)
    floors = dealt.groupBy("dim", "shard").cogroup(home.groupBy("dim", "shard")).applyInArrow(first, "vec_id long, floor double")
    everywhere = (
        asked.join(floors, "vec_id", "left")
        .withColumn("floor", F.coalesce("floor", lowest))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    copies = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = copies.groupBy("dim", "shard", "block").cogroup(everywhere.groupBy("dim", "shard", "block"))
    found = met.applyInArrow(rest, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
