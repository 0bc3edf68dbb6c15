"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are dealt into blocks and shards of bounded size; each pair of a query block
and a data shard is one task. The task indexes both sides in cover trees: a node has a centre
and the radius that covers its vectors, and its children cover it with smaller radii. For a
pair of nodes, no product of their vectors exceeds

    centre . centre + |centre_q| radius_d + |centre_d| radius_q + radius_q radius_d

so the pair is left when this is below the worst k-th score of the query node so far. A query
leaf first meets the data leaves with the largest bound of each query; later, the leaves that are
left are bounded for each query by itself, and those that some query needs are compared in large
products. What remains of each task is its best k per query, of which the best k are kept per
query. Vectors without clusters prune little: then all pairs of a block and a shard are compared.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a query block and of a data shard.
BLOCK_ROWS = 8192
#: Least number of data shards, so that small inputs use several executors too.
LEAST_SHARDS = 12

#: Vectors of a leaf, about: leaves are compared as wholes, so they must not be few vectors.
LEAF_ROWS = 512
_FANOUT = 32
_SHRINK = 0.6
# Vectors of a block that are compared at once.
_AT_ONCE = 1 << 13
# Scores that doubles hold exactly, and the largest that a long does.
_EXACT, _LONG = 2.0**53, 2.0**63
_NOTHING = np.iinfo(np.int64).min


@dataclass
class CoverNode:
    rows: np.ndarray
    centre: np.ndarray
    radius: float
    length: float
    children: list[CoverNode] = field(default_factory=list)

    def leaves(self) -> list[CoverNode]:
        return [leaf for child in self.children for leaf in child.leaves()] or [self]


def cover_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> CoverNode:
    """Centres are the vector next to the mean, then each time the vector farthest from all
    centres, until they cover the node with a smaller radius. A node has no more children than
    would be leaves of the wanted size; vectors of centres with few go to the nearest other."""
    root = _node(vectors, np.arange(len(vectors)))
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.rows) <= leaf_rows or node.radius == 0:
            continue
        own = vectors[node.rows]
        centres = [node.centre]
        distance = ((own - node.centre) ** 2).sum(axis=1)
        nearest = np.zeros(len(own), np.int64)
        goal = (node.radius * _SHRINK) ** 2
        for _ in range(min(_FANOUT, len(own) // leaf_rows + 1) - 1):
            far = int(distance.argmax())
            if distance[far] <= goal:
                break
            other = ((own - own[far]) ** 2).sum(axis=1)
            closer = other < distance
            nearest[closer], distance[closer] = len(centres), other[closer]
            centres.append(own[far])
        counts = np.bincount(nearest, minlength=len(centres))
        kept = np.flatnonzero(counts >= min(leaf_rows // 2, counts.max()))
        moved = np.flatnonzero(~np.isin(nearest, kept))
        if len(moved):
            apart = [((own[moved] - centres[i]) ** 2).sum(axis=1) for i in kept]
            nearest[moved] = kept[np.argmin(apart, axis=0)]
        parts = [node.rows[nearest == centre] for centre in kept]
        if len(parts) == 1:
            continue
        node.children = [_node(vectors, part) for part in parts]
        todo.extend(node.children)
    return root


def _node(vectors: np.ndarray, rows: np.ndarray) -> CoverNode:
    own = vectors[rows]
    mean = own.mean(axis=0)
    centre = own[int(((own - mean) ** 2).sum(axis=1).argmin())]
    radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
    return CoverNode(rows, centre, radius, float(np.sqrt((centre**2).sum())))


def _above(bounds: np.ndarray) -> np.ndarray:
    """Bounds, raised by the rounding of the products and radii."""
    return bounds + 1e-6 * np.abs(bounds) + 1e-6


class DualSearch:
    """The ``k`` best vectors of each query; ``compared`` counts pairs whose score was taken.

    Vectors are whole numbers. Scores are exact up to 2^63; a larger one raises an error.
    """

    def __init__(self, queries, query_ids, data, data_ids, k: int, leaf_rows: int = LEAF_ROWS):
        self.whole = queries, data
        self.queries, self.data = queries.astype(np.float64), data.astype(np.float64)
        self.query_ids, self.data_ids, self.k = query_ids, data_ids, k
        self.lengths = np.sqrt((self.queries**2).sum(axis=1))
        self.largest = self.lengths.max() * np.sqrt((self.data**2).sum(axis=1).max())
        self.repeated = len(np.unique(data_ids)) < len(data_ids)
        self.scores = np.full((len(queries), k), _NOTHING)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.leaf_rows, self.compared = leaf_rows, 0

    def run(self) -> None:
        query_tree = cover_tree(self.queries, self.leaf_rows)
        data_tree = cover_tree(self.data, self.leaf_rows)
        leaves = data_tree.leaves()
        # A query leaf first meets the leaf with the largest bound of each query, for k-th scores.
        met = {}
        for query in query_tree.leaves():
            best = np.unique(self._own_bounds(query, leaves).argmax(axis=1))
            met[id(query)] = {id(leaves[i]) for i in best}
            self._compare(query.rows, np.concatenate([leaves[i].rows for i in best]))
        todo = [(query_tree, [data_tree])]
        while todo:
            query, nodes = todo.pop()
            nodes = self._kept(query, nodes)
            if query.children:
                below = [part for node in nodes for part in (node.children or [node])]
                todo.extend((child, below) for child in query.children)
                continue
            while any(node.children for node in nodes):
                nodes = [part for node in nodes for part in (node.children or [node])]
                nodes = self._kept(query, nodes)
            nodes = [node for node in nodes if id(node) not in met[id(query)]]
            self._compare_all(query, nodes)

    def _bounds(self, query: CoverNode, nodes: list[CoverNode]) -> np.ndarray:
        """No product of a vector of the query node with one of a node is larger."""
        centres = np.array([node.centre for node in nodes])
        radii = np.array([node.radius for node in nodes])
        lengths = np.array([node.length for node in nodes])
        return _above(centres @ query.centre + query.length * radii + (lengths + radii) * query.radius)

    def _own_bounds(self, query: CoverNode, nodes: list[CoverNode]) -> np.ndarray:
        """The same for each query of the node by itself."""
        centres = np.array([node.centre for node in nodes])
        radii = np.array([node.radius for node in nodes])
        near = self.queries[query.rows] @ centres.T
        return _above(near + self.lengths[query.rows][:, None] * radii)

    def _kept(self, query: CoverNode, nodes: list[CoverNode]) -> list[CoverNode]:
        if not nodes:
            return []
        bounds = self._bounds(query, nodes)
        worst = float(self.scores[query.rows, -1].min())
        return [node for node, bound in zip(nodes, bounds) if bound >= worst]

    def _compare_all(self, query: CoverNode, nodes: list[CoverNode]) -> None:
        """Compare with the leaves that some query of the leaf needs, by its own bound; those
        with the largest bounds first, many leaves in one product."""
        if not nodes:
            return
        bounds = self._own_bounds(query, nodes)
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        begin = 0
        while begin < len(order):
            needed = bounds >= self.scores[query.rows, -1].astype(np.float64)[:, None]
            chosen, size = [], 0
            while begin < len(order) and size < _AT_ONCE:
                if needed[:, order[begin]].any():
                    chosen.append(order[begin])
                    size += len(nodes[order[begin]].rows)
                begin += 1
            if chosen:
                asking = query.rows[needed[:, chosen].any(axis=1)]
                self._compare(asking, np.concatenate([nodes[i].rows for i in chosen]))

    def _products(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        near = self.queries[queries] @ self.data[rows].T
        if self.largest < _EXACT:
            return near.astype(np.int64)
        if self.largest >= _LONG and (np.abs(near) >= _LONG * (1 - 1e-9)).any():
            raise ValueError("a score is beyond 64 bits")
        # Sums of longs that overflow on the way come out right if the result fits.
        return self.whole[0][queries] @ self.whole[1][rows].T

    def _compare(self, queries: np.ndarray, rows: np.ndarray) -> None:
        self.compared += len(queries) * len(rows)
        scores, ids = self._products(queries, rows), self.data_ids[rows]
        if self.repeated:
            # An id has the score of its best vector.
            order = np.argsort(ids, kind="stable")
            ids, first = np.unique(ids[order], return_index=True)
            scores = np.maximum.reduceat(scores[:, order], first, axis=1)
        scores[self.query_ids[queries][:, None] == ids] = _NOTHING
        better = scores.max(axis=1) >= self.scores[queries, -1]
        queries, scores = queries[better], scores[better]
        if not len(queries):
            return
        # Columns that reach the k-th score of no query are left out before sorting.
        some = (scores >= self.scores[queries, -1][:, None]).any(axis=0)
        scores, ids = scores[:, some], ids[some]
        scores = np.concatenate([self.scores[queries], scores], axis=1)
        places = np.concatenate(
            [self.found[queries], np.broadcast_to(ids, (len(queries), len(ids)))], axis=1
        )
        if scores.shape[1] > 4 * self.k:
            # No score below the k-th largest of its row is needed; a row with more ties keeps them.
            least = np.partition(scores, -2 * self.k, axis=1)[:, -2 * self.k]
            width = int((scores >= least[:, None]).sum(axis=1).max())
            chosen = np.argpartition(~scores, width - 1, axis=1)[:, :width]
            scores, places = np.take_along_axis(scores, chosen, 1), np.take_along_axis(places, chosen, 1)
        order = np.lexsort((places, ~scores), axis=-1)
        if self.repeated:
            order = order[:, : 2 * self.k]
            sorted_ids = np.take_along_axis(places, order, 1)
            # An id is there twice at most: as found before, and anew.
            again = (sorted_ids[:, :, None] == sorted_ids[:, None, :]) & np.tri(order.shape[1], k=-1, dtype=bool)
            real = np.take_along_axis(scores, order, 1) > _NOTHING
            drop = again.any(axis=2) & real
            order = np.take_along_axis(order, np.argsort(drop, axis=1, kind="stable"), 1)
        order = order[:, : self.k]
        self.scores[queries] = np.take_along_axis(scores, order, 1)
        self.found[queries] = np.take_along_axis(places, order, 1)


def _search(queries: pd.DataFrame, data: pd.DataFrame, k: int, leaf_rows: int) -> pd.DataFrame:
    if not len(queries) or not len(data):
        return pd.DataFrame(columns=["query_id", "vec_id", "score"]).astype("int64")
    query_ids = queries["query_id"].to_numpy()
    search = DualSearch(
        np.stack(queries["vector"].to_list()).astype(np.int64), query_ids,
        np.stack(data["vector"].to_list()).astype(np.int64), data["vec_id"].to_numpy(), k, leaf_rows,
    )
    search.run()
    real = search.scores > _NOTHING
    return pd.DataFrame(
        {
            "query_id": np.broadcast_to(query_ids[:, None], real.shape)[real],
            "vec_id": search.found[real],
            "score": search.scores[real],
        }
    )


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    block_rows: int = BLOCK_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` largest inner products
    of each query with the vectors of other ids, ties to the smaller id.

    ``vectors`` has ``vec_id`` and ``vector`` (whole numbers), ``queries`` ``query_id`` and
    ``vector``. Rows without id or vector take no part; equal rows count once, an id with
    several vectors has the score of the best. Vectors of different length are not compared.
    Scores are exact; one beyond 64 bits raises an error.
    """
    kinds = {"vec_id": vectors, "query_id": queries}
    sides = {}
    for name, rows in kinds.items():
        rows = rows.select(F.col(name).cast("bigint").alias(name), "vector")
        rows = rows.where(F.col(name).isNotNull() & F.col("vector").isNotNull())
        sides[name] = rows.dropDuplicates().withColumn("size", F.size("vector"))
    blocks = max(-(-sides["query_id"].count() // block_rows), 1)
    shards = max(-(-sides["vec_id"].count() // block_rows), LEAST_SHARDS)

    def deal(rows: DataFrame, name: str, own: str, parts: int, other: str, copies: int):
        return rows.withColumn(own, F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )

    left = deal(sides["query_id"], "query_id", "block", blocks, "shard", shards)
    right = deal(sides["vec_id"], "vec_id", "shard", shards, "block", blocks)
    keys = ("size", "block", "shard")
    best = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(
            lambda one, other: _search(one, other, k, leaf_rows), "query_id bigint, vec_id bigint, score bigint"
        )
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def scaled(embedding: str, factor: int = 64):
    """Components times ``factor``, rounded down; null if the vector or a component is null or
    not finite."""
    vector = F.transform(embedding, lambda x: x.cast("double"))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x * factor)))
